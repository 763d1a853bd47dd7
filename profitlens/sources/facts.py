"""The facts and masters that every report reads, and their loader from extracts."""

from __future__ import annotations

from collections.abc import Mapping
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from profitlens.sources.files import SCHEMAS, read_extract, with_schema


@dataclass
class Facts:
    """``lines`` is the relation the facts are derived from, if they are."""

    sales: DataFrame
    coupon: DataFrame
    oi: DataFrame
    stock: DataFrame
    coupon_type: DataFrame
    category: DataFrame
    store: DataFrame
    lines: DataFrame | None = None


def load_extracts(spark: SparkSession, paths: Mapping[str, str | list[str]], encoding: str = "UTF-8",
                  encodings: Mapping[str, str] | None = None, skip_rows: int = 0) -> Facts:
    """IO-15/16: a company's extracts -> facts, ready for every report.

    ``paths`` names the files of each table (file, folder, glob or list);
    ``encodings`` those that differ from ``encoding``. Columns are found by header,
    conformed to the declared types, and those a table lacks are NULL; a table
    without a path is empty. Reports leave handling and porterage deductions out of
    OI themselves (``supplier_income``) and build the SKU master (``sku_master``)."""
    unknown = set(paths) - set(SCHEMAS)
    if unknown:
        raise ValueError(f"unknown tables {sorted(unknown)}")
    made = {}
    for table, schema in SCHEMAS.items():
        if table in paths:
            made[table] = with_schema(read_extract(
                spark, paths[table], table, (encodings or {}).get(table, encoding), skip_rows), table)
        else:
            made[table] = spark.createDataFrame([], schema)
    return Facts(**made)
