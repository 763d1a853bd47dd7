"""Binding of the driver's TPC-H-like test tables to the retail facts.

The reference reads sales / coupon / purchase-income (OI) / stock extracts and
category / store masters. The test tables carry none of those, so each fact is
*derived by Spark* from the whole ``lineitem ⋈ orders ⋈ customer ⋈ part``
relation (plus supplier / nation / region for names). Every derived fact
therefore grows with the input tables.

Binding (fixed rules, mirrored by the oracle SQL in ``profitlens/oracle.py``):

  category_id = p_brand, module_id = (number after '#' in p_brand) mod 5
  sku_id, sku_name = l_partkey, p_name;  supplier_id, supplier_name = l_suppkey, s_name
  store_id, store_name, store_format = c_nationkey, n_name, r_name
  channel = o_orderpriority;  coupon_type_id = c_mktsegment
  sales  = lines with l_returnflag <> 'A', p_brand <> 'Brand#25', l_suppkey % 10 <> 3
  coupon = lines with l_linestatus = 'F' and l_returnflag in ('N', 'A'), and those with
           l_returnflag = 'R' that are no sales
  oi     = lines with l_returnflag = 'A'
  stock  = lines with l_linestatus = 'O'
  coupon_type = lines with l_returnflag = 'R' and c_mktsegment <> 'BUILDING'

Sales leave out a category and some suppliers so that pools without sales occur;
every line is in at least one of sales, coupon, oi and stock (``fact_coverage``
shows the rows and money inside and outside each fact).

Money is exact: price and discount/tax have at most two decimals, so every
money column is an exact DECIMAL(18,4).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from profitlens.functions.expr import MONEY, dec
from profitlens.session import drop_staged, stage
from profitlens.sources.facts import Facts

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events")

# Fixed values of the binding.
# Module names; modules 0 and 1 are the fresh-food modules (their names match
# the reference's fresh pattern, see plans/fresh.py).
MODULE_NAMES = {"0": "新鲜食材", "1": "美食", "2": "粮油", "3": "日化", "4": "百货"}
# Category whose master row is marked disabled.
DISABLED_CATEGORY = "Brand#24"
# Category whose master name is the marker itself (FLT-10 excludes it by name).
MARKER_CATEGORY = "Brand#13"
# Disabled marker in category names (reference value).
DISABLED_MARK = "删除禁用"
# Deduction types by line number: 1 handling fee, 2 porterage fee, else rebate.
DEDUCTION_HANDLING = "装卸费"
DEDUCTION_PORTERAGE = "搬运费"
DEDUCTION_REBATE = "返利"


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def line_base(spark: SparkSession, sf_dir: str, partitions: int | None = None) -> DataFrame:
    """Line relation with all attributes the facts need (inner joins on the
    foreign keys; supplier names by left join). Orders meet their customers before
    the lines do, so the lines are shuffled for orders and parts only, and a join
    key that no fact needs goes no further than its join. ``partitions`` deals the
    lines out anew, for a table that comes as one unsplittable file."""
    li = read_table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity",
        "l_extendedprice", "l_discount", "l_tax", "l_returnflag", "l_linestatus", "l_shipdate")
    if partitions:
        li = li.repartition(partitions)
    o = read_table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderpriority")
    c = read_table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey", "c_mktsegment")
    p = read_table(spark, sf_dir, "part").select("p_partkey", "p_name", "p_brand", "p_retailprice", "p_size")
    s = read_table(spark, sf_dir, "supplier").select("s_suppkey", "s_name")
    oc = o.join(c, o.o_custkey == c.c_custkey).drop("o_custkey", "c_custkey")
    return (li.join(oc, li.l_orderkey == oc.o_orderkey).drop("l_orderkey", "o_orderkey")
            .join(p, li.l_partkey == p.p_partkey).drop("p_partkey")
            .join(s, li.l_suppkey == s.s_suppkey, "left").drop("s_suppkey"))


# Intermediate products are kept at precision <= 18 so Spark computes them on
# the compact 64-bit decimal path (no BigDecimal per row).
def _price() -> F.Column:
    return F.col("l_extendedprice").cast("decimal(12,2)")


def _rate(c: str) -> F.Column:
    return F.col(c).cast("decimal(3,2)")


def _codes() -> list:
    return [
        F.col("p_brand").alias("category_id"),
        F.col("c_nationkey").cast("string").alias("store_id"),
        F.col("o_orderpriority").alias("channel"),
        F.col("l_partkey").cast("string").alias("sku_id"),
        F.col("p_name").alias("sku_name"),
        F.col("l_suppkey").cast("string").alias("supplier_id"),
        F.col("s_name").alias("supplier_name"),
    ]


def _net_sales() -> F.Column:
    return (_price() * (dec("1.00") - _rate("l_discount"))).cast(MONEY)


def _module_id(brand: F.Column) -> F.Column:
    return (F.substring_index(brand, "#", -1).try_cast("int") % 5).cast("string")


def _in_sales() -> F.Column:
    return (F.col("l_returnflag") != "A") & (F.col("p_brand") != "Brand#25") & (F.col("l_suppkey") % 10 != 3)


def _in_coupon() -> F.Column:
    return (((F.col("l_linestatus") == "F") & F.col("l_returnflag").isin("N", "A"))
            | ((F.col("l_returnflag") == "R") & ~_in_sales()))


def sales(lines: DataFrame) -> DataFrame:
    price = _price()
    ns = _net_sales()
    cost = (price * dec("0.97")).cast(MONEY)
    margin = (price * (dec("1.00") - _rate("l_discount")) - price * dec("0.97")).cast(MONEY)
    return (lines.where(_in_sales())
            .select(*_codes(),
                    F.to_date("l_shipdate").alias("biz_date"),
                    ns.alias("net_sales"),
                    cost.alias("cost"),
                    F.col("l_quantity").cast(MONEY).alias("qty"),
                    margin.alias("gross_margin"),
                    (price * _rate("l_discount")).cast(MONEY).alias("discount_net"),
                    (price * dec("0.01")).cast(MONEY).alias("price_comp"),
                    (F.col("l_quantity").cast("decimal(12,2)") * dec("0.10")).cast(MONEY).alias("shrink"),
                    F.lit(1).cast(MONEY).alias("footfall"),
                    price.cast(MONEY).alias("net_sales_pre_discount"),
                    margin.alias("system_margin")))


def coupon(lines: DataFrame) -> DataFrame:
    price = _price()
    cc = (price * _rate("l_tax")).cast(MONEY)
    sup = (price * dec("0.01")).cast(MONEY)
    plat = (price * dec("0.02")).cast(MONEY)
    dept = F.element_at(F.create_map(*[x for kv in MODULE_NAMES.items() for x in map(F.lit, kv)]),
                        _module_id(F.col("p_brand")))
    return (lines.where(_in_coupon())
            .select(*_codes(),
                    F.to_date("l_shipdate").alias("biz_date"),
                    dept.alias("department"),
                    F.col("c_mktsegment").alias("coupon_type_id"),
                    F.concat(F.lit("coupon "), F.lower("c_mktsegment")).alias("coupon_type_name"),
                    cc.alias("coupon_cost"),
                    (cc + sup + plat).cast(MONEY).alias("coupon_total"),
                    sup.alias("coupon_supplier_borne"),
                    plat.alias("coupon_platform_borne")))


def oi(lines: DataFrame) -> DataFrame:
    """Purchase income lines, *before* the handling/porterage exclusion."""
    ded = (F.when(F.col("l_linenumber") == 1, F.lit(DEDUCTION_HANDLING))
           .when(F.col("l_linenumber") == 2, F.lit(DEDUCTION_PORTERAGE))
           .otherwise(F.lit(DEDUCTION_REBATE)))
    return (lines.where(F.col("l_returnflag") == "A")
            .select(F.col("l_suppkey").cast("string").alias("supplier_id"),
                    F.col("s_name").alias("supplier_name"),
                    F.col("p_brand").alias("category_id"),
                    F.col("c_nationkey").cast("string").alias("store_id"),
                    ded.alias("deduction_type"),
                    (_price() * dec("0.02")).cast(MONEY).alias("oi_amount")))


def stock(lines: DataFrame) -> DataFrame:
    return (lines.where(F.col("l_linestatus") == "O")
            .select(F.col("p_brand").alias("category_id"),
                    F.col("c_nationkey").cast("string").alias("store_id"),
                    F.col("l_partkey").cast("string").alias("sku_id"),
                    F.col("p_name").alias("sku_name"),
                    (_price() * dec("0.6")).cast(MONEY).alias("own_cost"),
                    F.col("p_size").cast(MONEY).alias("stock_qty"),
                    (F.col("p_retailprice").cast("decimal(12,2)") * F.col("p_size").cast("decimal(5,0)")).cast(MONEY)
                    .alias("stock_value")))


def coupon_type(lines: DataFrame) -> DataFrame:
    """Store x coupon-type extract with issued / redeemed measures (PIPE-02)."""
    price = _price()
    ns = _net_sales()
    gm = (price * (dec("1.00") - _rate("l_discount")) - price * dec("0.97")).cast(MONEY)
    odd = (F.col("l_linenumber") % 2) == 1
    zero = F.lit(0).cast(MONEY)
    return (lines.where((F.col("l_returnflag") == "R") & (F.col("c_mktsegment") != "BUILDING"))
            .select(F.col("c_nationkey").cast("string").alias("store_id"),
                    F.col("c_mktsegment").alias("coupon_type_id"),
                    F.lower("c_mktsegment").alias("coupon_type_name"),
                    ns.alias("net_sales_issued"),
                    gm.alias("margin_issued"),
                    F.when(odd, ns).otherwise(zero).alias("net_sales_redeemed"),
                    F.when(odd, gm).otherwise(zero).alias("margin_redeemed"),
                    (price * dec("0.01")).cast(MONEY).alias("comp_net_alloc"),
                    (price * dec("0.02")).cast(MONEY).alias("promo_comp_alloc")))


def category_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per brand: module id/name, category id/name (one category disabled)."""
    brands = read_table(spark, sf_dir, "part").select(F.col("p_brand").alias("category_id")).distinct()
    mid = _module_id(F.col("category_id"))
    names = F.create_map(*[x for kv in MODULE_NAMES.items() for x in map(F.lit, kv)])
    cname = (F.when(F.col("category_id") == DISABLED_CATEGORY,
                    F.concat(F.col("category_id"), F.lit(DISABLED_MARK)))
             .when(F.col("category_id") == MARKER_CATEGORY, F.lit(DISABLED_MARK))
             .otherwise(F.col("category_id")))
    return brands.select(mid.alias("module_id"), F.element_at(names, mid).alias("module_name"),
                         "category_id", cname.alias("category_name"))


def store_master(spark: SparkSession, sf_dir: str) -> DataFrame:
    n = read_table(spark, sf_dir, "nation")
    r = read_table(spark, sf_dir, "region")
    return (n.join(r, n.n_regionkey == r.r_regionkey, "left")
            .select(F.col("n_nationkey").cast("string").alias("store_id"),
                    F.col("r_name").alias("store_format"),
                    F.col("n_name").alias("store_name")))


def fact_coverage(lines: DataFrame) -> DataFrame:
    """Rows and list price of the lines inside and outside each fact, and of those
    in none of sales, coupon, oi and stock (AGG-13). One pass over the lines."""
    facts = {"sales": _in_sales(), "coupon": _in_coupon(), "oi": F.col("l_returnflag") == "A",
             "stock": F.col("l_linestatus") == "O",
             "coupon_type": (F.col("l_returnflag") == "R") & (F.col("c_mktsegment") != "BUILDING")}
    facts["any"] = facts["sales"] | facts["coupon"] | facts["oi"] | facts["stock"]
    one = lines.agg(*[F.struct(
        F.lit(name).alias("fact"),
        F.coalesce(F.sum(F.when(cond, 1).otherwise(0)), F.lit(0)).alias("rows_inside"),
        F.coalesce(F.sum(F.when(cond, 0).otherwise(1)), F.lit(0)).alias("rows_outside"),
        F.coalesce(F.sum(F.when(cond, _price()).otherwise(0)), F.lit(0)).alias("price_inside"),
        F.coalesce(F.sum(F.when(cond, 0).otherwise(_price())), F.lit(0)).alias("price_outside")).alias(name)
        for name, cond in ((n, F.coalesce(c, F.lit(False))) for n, c in facts.items())])
    return one.select(F.explode(F.array(*facts)).alias("f")).select("f.*")


def facts_of(lines: DataFrame, spark: SparkSession, sf_dir: str) -> Facts:
    """The facts, lazily defined over a line relation."""
    return Facts(lines=lines, sales=sales(lines), coupon=coupon(lines), oi=oi(lines),
                 stock=stock(lines), coupon_type=coupon_type(lines),
                 category=category_master(spark, sf_dir), store=store_master(spark, sf_dir))


_CACHE: dict[tuple[str, str], Facts] = {}


def cached_facts(spark: SparkSession, sf_dir: str) -> Facts:
    """Facts over the conformed lines, which are joined once per session and input
    folder and staged as one Parquet table in the shared checkpoint folder (IO-15).

    Every report reads only the columns and rows it needs of that table, nothing
    is held in executor storage, and a lost executor costs no more than its tasks.
    The session conf ``profitlens.scan_partitions`` deals out a line table that
    comes as one unsplittable file.
    """
    key = (spark.sparkContext.applicationId, sf_dir)  # unique per SparkContext, never reused
    if key not in _CACHE:
        parts = spark.conf.get("profitlens.scan_partitions", None)
        _CACHE[key] = facts_of(stage(line_base(spark, sf_dir, int(parts) if parts else None), "facts"), spark, sf_dir)
    return _CACHE[key]


def clear_cache() -> None:
    """Delete the staged line tables of the running session."""
    for f in _CACHE.values():
        if f.lines.sparkSession.sparkContext._jsc is not None:
            drop_staged(f.lines)
    _CACHE.clear()
