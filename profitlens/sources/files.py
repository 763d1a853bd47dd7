"""Extract readers and report writers (IO-01..IO-16).

Extracts arrive as CSV (UTF-8, or GBK from the "ANSI" exports) with the
business headers. They are read with every column as text (no inference, so a
code such as ``001`` keeps its zeros), the headers are mapped to canonical
names, and each column is conformed to the fact's declared type.
"""

from __future__ import annotations

import re
import uuid
from collections.abc import Mapping
from contextlib import contextmanager

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profitlens.functions.expr import MONEY, conform_code
from profitlens.sources.headers import catalogue_headers

# Reference column headers and the canonical name each maps to.
HEADER_ALIASES: dict[str, str] = {
    "大类编码": "category_id",
    "大类名称": "category_name",
    "模块编码": "module_id",
    "模块名称": "module_name",
    "门店DC编码": "store_id",
    "门店编码": "store_id",
    "发生机构": "store_id",
    "门店DC名称": "store_name",
    "业态": "store_format",
    "渠道": "channel",
    "渠道名称": "channel",
    "商品编码": "sku_id",
    "商品名称": "sku_name",
    "供应商业务码": "supplier_id",
    "供应商编码": "supplier_id",
    "供应商名称": "supplier_name",
    "销售净额": "net_sales",
    "月-销售净额": "net_sales",
    "销售成本": "cost",
    "销售数量": "qty",
    "毛利额": "gross_margin",
    "销售毛利额": "gross_margin",
    "月-销售毛利": "gross_margin",
    "销售毛利": "gross_margin",
    "折扣净额": "discount_net",
    "补差": "price_comp",
    "生鲜损耗": "shrink",
    "客流量": "footfall",
    "销售净额折前": "net_sales_pre_discount",
    "系统毛利额": "system_margin",
    "日期": "biz_date",
    "部门名称": "department",
    "万家承担金额（去税）": "coupon_cost",
    "万家承担金额（元）": "coupon_cost",
    "万家承担金额": "coupon_cost",
    "总用券金额": "coupon_total",
    "供应商承担金额": "coupon_supplier_borne",
    "平台承担金额": "coupon_platform_borne",
    "券类型": "coupon_type_id",
    "券类型编码": "coupon_type_id",
    "券名称": "coupon_type_name",
    "券类型名称": "coupon_type_name",
    "销售净额_发券": "net_sales_issued",
    "毛利净额_发券": "margin_issued",
    "销售净额_用券": "net_sales_redeemed",
    "毛利净额_用券": "margin_redeemed",
    "分摊中门补差净额": "comp_net_alloc",
    "分摊的促销毛利补差": "promo_comp_alloc",
    "扣项类型": "deduction_type",
    "金额": "oi_amount",
    "自营-销售成本": "own_cost",
    "库存数量": "stock_qty",
    "库存金额": "stock_value",
}

_CODES = ["category_id", "store_id", "channel", "sku_id", "supplier_id"]
_NAMES = ["sku_name", "supplier_name"]


def _fields(codes, names, money, dates=()):
    return ([T.StructField(c, T.StringType()) for c in codes + names]
            + [T.StructField(d, T.DateType()) for d in dates]
            + [T.StructField(m, MONEY) for m in money])


# Declared schema of each logical table (FIXTURES §1): codes and names are
# strings, money is DECIMAL(18,4), dates are DATE.
SCHEMAS: dict[str, T.StructType] = {
    "sales": T.StructType(_fields(_CODES, _NAMES, [
        "net_sales", "cost", "qty", "gross_margin", "discount_net", "price_comp", "shrink", "footfall",
        "net_sales_pre_discount", "system_margin"], ["biz_date"])),
    "coupon": T.StructType(_fields(_CODES + ["coupon_type_id"], _NAMES + ["department", "coupon_type_name"], [
        "coupon_cost", "coupon_total", "coupon_supplier_borne", "coupon_platform_borne"], ["biz_date"])),
    "coupon_type": T.StructType(_fields(["store_id", "coupon_type_id"], ["coupon_type_name"], [
        "net_sales_issued", "margin_issued", "net_sales_redeemed", "margin_redeemed", "comp_net_alloc",
        "promo_comp_alloc"])),
    "oi": T.StructType(_fields(["supplier_id", "category_id", "store_id"], ["supplier_name", "deduction_type"],
                               ["oi_amount"])),
    "stock": T.StructType(_fields(["category_id", "store_id", "sku_id"], ["sku_name"],
                                  ["own_cost", "stock_qty", "stock_value"])),
    "category": T.StructType(_fields(["module_id", "category_id"], ["module_name", "category_name"], [])),
    "store": T.StructType(_fields(["store_id"], ["store_format", "store_name"], [])),
}

CODE_COLUMNS = {"category_id", "store_id", "channel", "sku_id", "supplier_id", "coupon_type_id", "module_id"}


_LEGACY_CHARSETS = "spark.sql.legacy.javaCharsets"


def _needs_legacy(encoding: str) -> bool:
    return encoding.upper().replace("-", "") not in ("UTF8", "USASCII", "ISO88591", "UTF16", "UTF16BE", "UTF16LE",
                                                     "UTF32")


def _charset_conf(spark: SparkSession, encoding: str) -> None:
    """Spark 4 accepts only a short list of CSV charsets unless the legacy Java
    charset lookup is enabled; GBK needs it (S17). Frames are lazy and the setting
    must hold when they run, so a reader leaves it on."""
    if _needs_legacy(encoding):
        spark.conf.set(_LEGACY_CHARSETS, "true")


@contextmanager
def _charset(spark: SparkSession, encoding: str):
    """The same for a sink, which runs at once: the setting is put back."""
    before = spark.conf.get(_LEGACY_CHARSETS, None)
    _charset_conf(spark, encoding)
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_LEGACY_CHARSETS)
        else:
            spark.conf.set(_LEGACY_CHARSETS, before)


def canonical_columns(df: DataFrame, headers: Mapping[str, str] | None = None,
                      aliases: Mapping[str, str] = HEADER_ALIASES) -> DataFrame:
    """Rename business headers to canonical names (PRJ-02). ``headers`` gives the
    header of each column where it is not the column's name. Headers are
    whitespace-stripped first; when two headers map to one name the first wins."""
    seen: set[str] = set()
    cols = []
    for c in df.columns:
        header = (headers or {}).get(c, c).strip()
        name = aliases.get(header, header)
        if name in seen or not name:
            continue
        seen.add(name)
        cols.append(F.col(f"`{c}`").alias(name))
    return df.select(*cols)


def _parsed(c: str, t: T.DataType) -> F.Column:
    """Text to its declared type; what does not parse is NULL (money straight to
    DECIMAL, so no digit is lost to a double)."""
    text = F.btrim(F.col(f"`{c}`").cast("string"))
    if isinstance(t, T.DecimalType):
        return F.when(F.lower(text).rlike("^[+-]?nan$"), F.lit(None)).otherwise(text).try_cast(t)
    return text.try_cast("date")


def conform(df: DataFrame, table: str) -> DataFrame:
    """Cast canonical text columns to the declared schema of ``table``:
    codes -> trimmed strings (missing -> ``__NA__``), money -> DECIMAL via a
    tolerant cast (NaN and text -> NULL, see ``reject_report``), dates -> DATE.
    Unknown columns are kept."""
    schema = {f.name: f.dataType for f in SCHEMAS[table].fields}
    out = []
    for c in df.columns:
        t = schema.get(c)
        if t is None:
            out.append(F.col(f"`{c}`"))
        elif c in CODE_COLUMNS:
            out.append(conform_code(c).alias(c))
        elif isinstance(t, (T.DecimalType, T.DateType)):
            out.append(_parsed(c, t).alias(c))
        else:
            out.append(F.btrim(F.col(c).cast("string")).alias(c))
    return df.select(*out)


def reject_report(raw: DataFrame, table: str) -> DataFrame:
    """For every money and date column of a raw extract (``read_raw``): values that
    are there but do not parse, and so are NULL after ``conform``. One pass."""
    own = [(f.name, f.dataType) for f in SCHEMAS[table].fields
           if f.name in raw.columns and isinstance(f.dataType, (T.DecimalType, T.DateType))]
    given = lambda c: (F.length(F.btrim(F.col(c))) > 0) & ~F.lower(F.btrim(F.col(c))).rlike("^[+-]?nan$")
    counts = raw.agg(*[F.count(F.when(given(c) & _parsed(c, t).isNull(), 1)).alias(c) for c, t in own],
                     F.count(F.lit(1)).alias("_rows"))
    return counts.select(F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).alias("rejected"),
                                                      F.col("_rows").alias("rows")) for c, _ in own])).alias("r")
                         ).select("r.*")


def with_schema(df: DataFrame, table: str) -> DataFrame:
    """The declared columns of ``table`` in order; those an extract lacks are NULL."""
    return df.select(*[F.col(f.name) if f.name in df.columns else F.lit(None).cast(f.dataType).alias(f.name)
                       for f in SCHEMAS[table].fields])


def _lines(spark: SparkSession, paths, encoding: str) -> DataFrame:
    """Lines of the files with their file and block, in reading order."""
    lines = (spark.read.schema("line string").option("sep", "\u0001").option("quote", "")
             .option("encoding", encoding).csv(paths))
    return lines.select("line", F.col("_metadata.file_path").alias("file"),
                        F.col("_metadata.file_block_start").alias("block"))


def _headers(spark: SparkSession, paths, encoding: str, skip_rows: int, catalogue: str | None
             ) -> dict[tuple[str, ...], list[str]]:
    """Files by header, from the files' heads or the stored catalogue."""
    out: dict[tuple[str, ...], list[str]] = {}
    for r in catalogue_headers(spark, paths, encoding, skip_rows, catalogue).select("file", "header").collect():
        if r.header:
            out.setdefault(tuple(r.header), []).append(r.file)
    return {h: sorted(files) for h, files in sorted(out.items(), key=lambda x: min(x[1]))}


def _after_head(head_rows: int):
    """Rows (line, file, block) in reading order without the first ``head_rows`` of every file. A partition reads a
    block of a file at a time, so the rows of a file's first block are counted from where it starts."""
    def run(batches):
        import numpy as np
        import pyarrow as pa

        last, seen = None, 0
        for batch in batches:
            place = batch.column(1).dictionary_encode()
            names, codes, block = place.dictionary.to_pylist(), place.indices.to_numpy(), batch.column(2).to_numpy()
            keep = np.ones(batch.num_rows, bool)
            starts = np.flatnonzero(np.r_[True, (codes[1:] != codes[:-1]) | (block[1:] != block[:-1])]) if len(codes) else []
            for start, end in zip(starts, np.r_[starts[1:], len(codes)] if len(codes) else []):
                here = (names[codes[start]], int(block[start]))
                before = seen if here == last else 0
                if here[1] == 0:
                    keep[start:start + max(0, head_rows - before)][:end - start] = False
                last, seen = here, before + int(end - start)
            yield pa.RecordBatch.from_arrays([batch.column(0).filter(pa.array(keep))], ["line"])
    return run


def read_raw(spark: SparkSession, path: str | list[str], encoding: str = "UTF-8", skip_rows: int = 0,
             catalogue: str | None = None) -> DataFrame:
    """CSV file(s) as text under canonical column names. Every file's own header
    names its columns: files are grouped by header, each group is read at once and
    the groups are put together by name (a column that a file lacks is NULL).
    ``skip_rows`` lines before the header are left out. Only the heads of the files
    are read for their headers, or, with a stored ``catalogue``, only those of new and
    changed files."""
    _charset_conf(spark, encoding)
    out = None
    for header, files in _headers(spark, path, encoding, skip_rows, catalogue).items():
        schema = T.StructType([T.StructField(f"c{i}", T.StringType()) for i in range(len(header))])
        if skip_rows:
            ddl = ", ".join(f"{c} string" for c in schema.names)
            rows = (_lines(spark, files, encoding).mapInArrow(_after_head(skip_rows + 1), "line string")
                    .select(F.from_csv("line", ddl).alias("r")).select("r.*"))
        else:
            rows = spark.read.schema(schema).option("header", True).option("encoding", encoding).csv(files)
        part = canonical_columns(rows, dict(zip(schema.names, header)))
        out = part if out is None else out.unionByName(part, allowMissingColumns=True)
    if out is None:
        raise ValueError(f"no header line in {path}")
    return out


def read_extract(spark: SparkSession, path: str | list[str], table: str, encoding: str = "UTF-8",
                 skip_rows: int = 0, catalogue: str | None = None) -> DataFrame:
    """IO-01/02/03/15: CSV extract(s) -> conformed fact. ``encoding='GBK'`` reads
    the "ANSI" exports. ``path`` may be a folder, a glob or a list of period files
    whose columns come in any order."""
    return conform(read_raw(spark, path, encoding, skip_rows, catalogue), table)


def write_csv(df: DataFrame, path: str, encoding: str = "UTF-8") -> None:
    """IO-05/06/07: CSV sink with header (UTF-8 or GBK)."""
    with _charset(df.sparkSession, encoding):
        df.write.mode("overwrite").option("header", True).option("encoding", encoding).csv(path)


def write_report(df: DataFrame, out_dir: str, report: str, partition_by: tuple[str, ...] = (),
                 fmt: str = "parquet") -> str:
    """IO-08/IO-14: one report directory, partitioned by e.g. company / period.
    Only the partitions that df holds are replaced; other periods stay."""
    path = f"{out_dir.rstrip('/')}/{report}"
    w = df.write.mode("overwrite").format(fmt)
    if fmt == "csv":
        w = w.option("header", True)
    if partition_by:
        w = w.partitionBy(*partition_by).option("partitionOverwriteMode", "dynamic")
    w.save(path)
    return path


def write_sheets(sheets: Mapping[str, DataFrame], out_dir: str, report: str, fmt: str = "parquet") -> dict:
    """IO-09: multi-sheet report = one sub-directory per sheet, each written once."""
    return {name: write_report(df, f"{out_dir.rstrip('/')}/{report}", name, fmt=fmt)
            for name, df in sheets.items()}


_IDENT = re.compile(r"^[A-Za-z_][A-Za-z0-9_]*(\.[A-Za-z_][A-Za-z0-9_]*)?$")


def publish_values(df: DataFrame) -> DataFrame:
    """Publishing rule (S8): undefined ratios (NULL doubles) become 0 in a
    published table, as the reference does before storing."""
    fills = {f.name: 0.0 for f in df.schema.fields if isinstance(f.dataType, T.DoubleType)}
    return df.na.fill(fills) if fills else df


def _checked(table: str) -> str:
    if not _IDENT.match(table):
        raise ValueError(f"invalid table name {table!r}")
    return table


def write_version(df: DataFrame, table: str, zero_undefined: bool = True) -> str:
    """Write ``df`` as a new version of a catalog table, not yet seen by its readers."""
    version = f"{_checked(table)}__v{uuid.uuid4().hex[:12]}"
    (publish_values(df) if zero_undefined else df).write.saveAsTable(version)
    return version


def swap_version(spark: SparkSession, table: str, version: str) -> None:
    """Make a written version the present one: ``table`` is a view, and one catalog
    operation points it at the version. The version before stays for readers that
    have started; older ones, and those of writes that died before, are dropped."""
    base = _checked(table).split(".")[-1]
    db = table.split(".")[0] if "." in table else spark.catalog.currentDatabase()
    names = {t.name: t.tableType for t in spark.catalog.listTables(db)}
    if names.get(base, "VIEW") != "VIEW":  # a plain table becomes the version before
        before = f"{table}__v0"
        spark.sql(f"ALTER TABLE {table} RENAME TO {before}")
    elif base in names:
        before = spark.sql(f"SHOW TBLPROPERTIES {table} ('profitlens.version')").first().value
    else:
        before = None
    spark.sql(f"CREATE OR REPLACE VIEW {table} TBLPROPERTIES ('profitlens.version' = '{_checked(version)}') "
              f"AS SELECT * FROM {version}")
    kept = {v.split(".")[-1] for v in (version, before) if v}
    for name in names:
        if re.match(rf"{re.escape(base)}__v([0-9a-f]{{12}}|0)$", name) and name not in kept:
            spark.sql(f"DROP TABLE IF EXISTS {db}.{_checked(name)}")


def replace_table(df: DataFrame, table: str, zero_undefined: bool = True) -> None:
    """IO-10/11/12: replace a catalog table with ``df``. The new rows are written as a
    table of their own first and swapped in last, so a write that dies leaves the old
    table as it was (identifiers are validated)."""
    swap_version(df.sparkSession, table, write_version(df, table, zero_undefined))


def replace_jdbc_table(df: DataFrame, url: str, table: str, properties: Mapping[str, str],
                       zero_undefined: bool = True) -> None:
    """IO-10 against an external database over JDBC; credentials come from the caller."""
    _checked(table)
    (publish_values(df) if zero_undefined else df).write.jdbc(url, table, mode="overwrite",
                                                              properties=dict(properties))


def read_query(spark: SparkSession, query: str) -> DataFrame:
    """IO-13: a SQL query over catalog tables as a source."""
    return spark.sql(query)
