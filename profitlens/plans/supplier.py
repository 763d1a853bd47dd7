"""Supplier reports (PIPE-06, PIPE-07 = ALC-04, PIPE-08, PIPE-03)."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profitlens.functions.expr import WIDE_MONEY, round_half_even
from profitlens.operators.allocate import allocate_with_fallback
from profitlens.operators.dims import enrich, first_wins
from profitlens.operators.rollup import combine, rollup
from profitlens.plans.margin import supplier_income

KEYS = ("category_id", "supplier_id")


def supplier_coupon_direct(coupon: DataFrame) -> DataFrame:
    """PIPE-06: coupon cost by category x the supplier recorded on the coupon rows."""
    return rollup(coupon, KEYS, ["coupon_cost"])


def supplier_coupon_by_sales(sales: DataFrame, coupon: DataFrame) -> DataFrame:
    """PIPE-07 / ALC-04: a category's coupon cost spread over its suppliers by
    their positive category x supplier sales (FLT-02 after the rollup);
    categories without such sales keep the supplier on the coupon rows."""
    base = rollup(sales, KEYS, ["net_sales"]).where(F.col("net_sales") > 0)
    out = allocate_with_fallback(base, coupon.select(*KEYS, "coupon_cost"), ["category_id"],
                                 "net_sales", "coupon_cost", ["supplier_id"])
    return out.select(*KEYS, F.col("alloc_amount").alias("coupon_cost"))


def supplier_master(sales: DataFrame, oi: DataFrame, coupon: DataFrame) -> DataFrame:
    """PIPE-03: supplier names, first source wins (sales, then OI, then coupon)."""
    return first_wins([d.select("supplier_id", "supplier_name") for d in (sales, oi, coupon)],
                      "supplier_id", ["supplier_name"])


def supplier_net_margin(sales: DataFrame, oi: DataFrame, coupon: DataFrame) -> DataFrame:
    """PIPE-08: net supplier margin = gross margin - coupon cost + OI, by
    category x supplier, five money columns rounded half-even to cents."""
    inc = supplier_income(oi)
    coup = supplier_coupon_by_sales(sales, coupon)
    m = combine({"sales": rollup(sales, KEYS, ["net_sales", "gross_margin"]),
                 "oi": rollup(inc, KEYS, ["oi_amount"]),
                 "coupon": coup},
                KEYS, {"sales": ["net_sales", "gross_margin"], "oi": ["oi_amount"],
                       "coupon": ["coupon_cost"]})
    m = m.withColumn("net_margin", (F.col("gross_margin") - F.col("coupon_cost") + F.col("oi_amount")).cast(WIDE_MONEY))
    m = enrich(m, supplier_master(sales, inc, coupon), "supplier_id")
    return m.select("category_id", "supplier_id", "supplier_name",
                    *[round_half_even(c, 2).alias(c)
                      for c in ("net_sales", "gross_margin", "oi_amount", "coupon_cost", "net_margin")])
