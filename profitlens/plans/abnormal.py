"""Abnormal-margin detection and drill-down (STA-05, PIPE-05 abnormal grain, PIPE-12)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profitlens.functions.expr import WIDE_MONEY, ratio, round_half_even
from profitlens.operators.dims import enrich
from profitlens.operators.rollup import combine
from profitlens.operators.skew import skew_join
from profitlens.operators.stats import outside_band
from profitlens.plans.margin import sales_coupon_margin, store_names

ABN_KEYS = ("category_id", "store_id", "sku_id", "sku_name")
# Category names excluded by exact match (reference: the
# disabled marker) and modules excluded from the negative-margin list (fresh).
EXCLUDED_CATEGORY_NAMES = ("删除禁用",)
EXCLUDED_MODULES = ("0", "1")


def working_data(sales: DataFrame, coupon: DataFrame) -> DataFrame:
    """PIPE-05 (abnormal grain): sales ⟗ coupon at category x store x SKU x name."""
    return sales_coupon_margin(sales, coupon, ABN_KEYS,
                               measures=("net_sales", "gross_margin", "discount_net", "price_comp", "shrink"),
                               how="full")


def two_metric_outliers(work: DataFrame, k: float = 6.0) -> DataFrame:
    """STA-05: rows whose post-coupon margin is a k-sigma outlier in its category;
    the post-coupon rate is reported only where the rate is an outlier too.

    Both metrics' moments come from one aggregate joined back once (the input is
    unique per category x store x SKU x name, so this equals joining the two
    outlier lists on those keys; the original joins without the category and
    can fan out a SKU listed in two categories)."""
    keys = ["category_id", "store_id", "sku_id", "sku_name"]
    amt, rate = "post_coupon_margin", "post_coupon_margin_rate"

    def clean(c):
        v = F.col(c).cast("double")
        return F.when(F.isnan(v), F.lit(None)).otherwise(v)

    moments = work.groupBy("category_id").agg(
        F.avg(clean(amt)).alias("_am"), F.stddev_samp(clean(amt)).alias("_as"),
        F.avg(clean(rate)).alias("_rm"), F.stddev_samp(clean(rate)).alias("_rs"))
    joined = skew_join(work.select(*keys, amt, rate), moments, ["category_id"])
    return (joined.where(outside_band(amt, "_am", "_as", k))
            .select(*keys, amt, F.when(outside_band(rate, "_rm", "_rs", k), F.col(rate)).alias(rate)))


def abnormal_categories(category: DataFrame, excluded_names: Sequence[str] = EXCLUDED_CATEGORY_NAMES,
                        excluded_modules: Sequence[str] = EXCLUDED_MODULES) -> DataFrame:
    """FLT-10: ``SELECT DISTINCT ... WHERE name NOT IN (...) AND module NOT IN (...)``
    (a NULL operand drops the row, as in SQL)."""
    return (category.where(~F.col("category_name").isin(*excluded_names)
                           & ~F.col("module_id").isin(*excluded_modules))
            .select("category_id").distinct())


def abnormal_summary(sales: DataFrame, coupon: DataFrame, category: DataFrame, store: DataFrame,
                     k: float = 6.0) -> DataFrame:
    """PIPE-12 sheet 2: negative post-coupon-margin outliers in analysed categories."""
    out = two_metric_outliers(working_data(sales, coupon), k)
    out = (out.join(abnormal_categories(category), "category_id", "left_semi")
           .where(F.col("post_coupon_margin") < 0))
    out = enrich(out, store_names(store), "store_id")
    return out.select("store_format", "store_id", "store_name", "category_id", "sku_id", "sku_name",
                      round_half_even("post_coupon_margin", 2).alias("post_coupon_margin"))


def channel_drill(sales: DataFrame, coupon: DataFrame) -> DataFrame:
    """PIPE-12 detail measures by store x SKU x channel (full outer, unit price and cost)."""
    keys = ["store_id", "sku_id", "channel"]
    sm = ["net_sales", "gross_margin", "discount_net", "price_comp", "qty", "cost"]
    m = combine({"s": sales.select(*keys, *sm), "c": coupon.select(*keys, "coupon_cost")}, keys,
                {"s": sm, "c": ["coupon_cost"]})
    return (m.withColumn("post_coupon_margin", (F.col("gross_margin") - F.col("coupon_cost")).cast(WIDE_MONEY))
            .withColumn("unit_price", ratio("net_sales", "qty"))
            .withColumn("unit_cost", ratio("cost", "qty")))


def abnormal_list(sales: DataFrame, coupon: DataFrame, store: DataFrame, k: float = 6.0) -> DataFrame:
    """PIPE-12 sheet 1: every two-metric outlier with its store's names."""
    return enrich(two_metric_outliers(working_data(sales, coupon), k), store_names(store), "store_id", durable=False)


def abnormal_drill(sales: DataFrame, coupon: DataFrame, category: DataFrame, store: DataFrame,
                   k: float = 6.0) -> DataFrame:
    """PIPE-12 sheet 3: channel drill-down of the abnormal store x SKU list, with
    store and SKU names."""
    out = two_metric_outliers(working_data(sales, coupon), k)
    flagged = (out.join(abnormal_categories(category), "category_id", "left_semi")
               .where(F.col("post_coupon_margin") < 0)
               .groupBy("store_id", "sku_id").agg(F.min("sku_name").alias("sku_name")))
    d = channel_drill(sales, coupon).join(flagged, ["store_id", "sku_id"], "inner")
    d = enrich(d, store_names(store), "store_id", ["store_name"])
    money = ["net_sales", "cost", "price_comp", "gross_margin", "coupon_cost", "post_coupon_margin"]
    return d.select("store_id", "store_name", "sku_id", "sku_name", "channel",
                    *[round_half_even(c, 2).alias(c) for c in money],
                    F.col("qty").cast("double").alias("qty"),
                    round_half_even("unit_price", 2).alias("unit_price"),
                    round_half_even("unit_cost", 2).alias("unit_cost"))
