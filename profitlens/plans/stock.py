"""Stock turnover and the annual category scorecard (PIPE-15, PIPE-16, PIPE-17)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profitlens.functions.expr import WIDE_MONEY, ratio
from profitlens.operators.dims import enrich
from profitlens.operators.rollup import combine, rollup
from profitlens.plans.margin import (
    SALES_MEASURES, SKU_KEYS, category_names, chain_sku_margin, company_margin, oi_store_sku, sold_coupon, supplier_income,
)

STOCK_MEASURES = ("own_cost", "stock_qty", "stock_value")
MARGIN_MEASURES = ("net_sales", "cost", "qty", "gross_margin", "discount_net", "price_comp", "shrink",
                   "coupon_cost", "post_coupon_margin", "alloc_amount")


def stock_rollup(stock: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AGG-10: stock measures at a grain."""
    return rollup(stock, keys, list(STOCK_MEASURES))


def store_turnover(sales: DataFrame, coupon: DataFrame, oi: DataFrame, stock: DataFrame,
                   category: DataFrame, modules: Sequence[str], days: int) -> DataFrame:
    """PIPE-15: store x SKU margin (channel dropped, AGG-12) ⟗ stock; daily stock
    value = stock value / days; turnover days = stock value / own cost (NULL
    when own cost is 0).

    The margin's measures are sums, so its facts (sales, the coupon cost of sold keys,
    ALC-05) are summed once, with the stock, at the report's grain. Rows without one of
    the margin's keys are no part of it."""
    alloc, _ = oi_store_sku(sales, oi, category, modules)
    keys = ["store_id", "category_id", "sku_id"]
    kept = lambda df: df.where(" and ".join(f"`{k}` is not null" for k in SKU_KEYS))
    facts = {"sales": (kept(sales), SALES_MEASURES), "coupon": (sold_coupon(sales, coupon, SKU_KEYS), ["coupon_cost"]),
             "oi": (kept(alloc), ["alloc_amount"]), "s": (stock, STOCK_MEASURES)}
    out = combine({t: df.select(*keys, *ms) for t, (df, ms) in facts.items()}, keys,
                  {t: list(ms) for t, (_, ms) in facts.items()})
    out = out.withColumn("post_coupon_margin", (F.col("gross_margin") - F.col("coupon_cost")).cast(WIDE_MONEY))
    wide = [F.col(c).cast("decimal(38,4)").alias(c) for c in MARGIN_MEASURES]
    return _with_turnover(out.select(*keys, *wide, *STOCK_MEASURES), days)


def category_turnover(sales: DataFrame, coupon: DataFrame, oi: DataFrame, stock: DataFrame,
                      category: DataFrame, days: int) -> DataFrame:
    """PIPE-15 (category): company margin by store x category (channel dropped) ⟗
    stock at the same grain."""
    m = company_margin(sales, coupon, oi, category)
    return _turnover(m, stock, ["store_id", "category_id"], days)


def _turnover(margin: DataFrame, stock: DataFrame, keys: list[str], days: int) -> DataFrame:
    out = combine({"m": margin.select(*keys, *MARGIN_MEASURES), "s": stock.select(*keys, *STOCK_MEASURES)},
                  keys, {"m": list(MARGIN_MEASURES), "s": list(STOCK_MEASURES)})
    return _with_turnover(out, days)


def _with_turnover(out: DataFrame, days: int) -> DataFrame:
    return (out.withColumn("daily_stock_value", ratio("stock_value", F.lit(days), zero_den="null"))
            .withColumn("turnover_days", ratio("stock_value", "own_cost", zero_den="null")))


def sku_turnover(sales: DataFrame, coupon: DataFrame, oi: DataFrame, stock: DataFrame,
                 days: int) -> DataFrame:
    """PIPE-16: chain SKU margin (channel dropped) ⋈ stock (inner); total margin
    rate = (post-coupon margin + OI) / net sales; annual turns =
    own cost / (stock value / days) * 12."""
    keys = ["category_id", "sku_id"]
    m = chain_sku_margin(sales, coupon, oi)
    ms = rollup(m, keys, list(MARGIN_MEASURES))
    st = stock_rollup(stock, keys)
    out = ms.join(st, keys, "inner")
    total = (F.col("post_coupon_margin") + F.col("alloc_amount")).cast(WIDE_MONEY)
    return (out.withColumn("total_margin_rate", ratio(total, "net_sales", zero_den="null"))
            .withColumn("annual_turns",
                        ratio(F.col("own_cost") * F.lit(days * 12), "stock_value", zero_den="null")))


SCORECARD_SALES = ("qty", "net_sales_pre_discount", "net_sales", "cost", "discount_net", "shrink",
                   "price_comp", "gross_margin", "system_margin", "footfall")
SCORECARD_COUPON = ("coupon_total", "coupon_supplier_borne", "coupon_platform_borne", "coupon_cost")


def category_scorecard(sales: DataFrame, coupon: DataFrame, oi: DataFrame, stock: DataFrame) -> DataFrame:
    """PIPE-17: annual category scorecard — sales ⟗ coupon ⟗ OI ⟗ stock in one
    tagged union and one group-by (JN-08); margin rates, turnover days and
    turns per year = 365 * own cost / stock value (NULL when undefined, S8/S9)."""
    keys = ["category_id"]
    out = combine({"s": sales.select(*keys, *SCORECARD_SALES),
                   "c": coupon.select(*keys, *SCORECARD_COUPON),
                   "o": supplier_income(oi).select(*keys, "oi_amount"),
                   "k": stock.select(*keys, "own_cost", "stock_value")},
                  keys, {"s": list(SCORECARD_SALES), "c": list(SCORECARD_COUPON), "o": ["oi_amount"],
                         "k": ["own_cost", "stock_value"]})
    pcm = (F.col("gross_margin") - F.col("coupon_cost")).cast(WIDE_MONEY)
    return (out.withColumn("margin_rate", ratio("gross_margin", "net_sales", fill=0))
            .withColumn("coupon_rate", ratio("coupon_cost", "net_sales", fill=0))
            .withColumn("post_coupon_margin", pcm)
            .withColumn("post_coupon_margin_rate", ratio(pcm, "net_sales"))
            .withColumn("turnover_days", ratio("stock_value", "own_cost", zero_den="null"))
            .withColumn("turns_per_year", ratio(F.col("own_cost") * F.lit(365), "stock_value",
                                                zero_den="null")))


def enriched_scorecard(sales: DataFrame, coupon: DataFrame, oi: DataFrame, stock: DataFrame,
                       category: DataFrame) -> DataFrame:
    """PIPE-14 (scorecard): the annual scorecard with category names."""
    return enrich(category_scorecard(sales, coupon, oi, stock), category_names(category), "category_id")
