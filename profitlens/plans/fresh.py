"""Fresh-food margin (PIPE-09, PIPE-10 = ALC-07, PIPE-11).

The reference runs two steps of this report as database stored procedures
whose bodies are not published; PIPE-09 and PIPE-11 below are *inferred* from
the surrounding code (store x SKU margin on fresh rows, then margin ⟗ OI).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profitlens.functions.expr import WIDE_MONEY, matches_any, ratio
from profitlens.operators.allocate import Level, reallocate_single, waterfall
from profitlens.operators.rollup import combine, rollup
from profitlens.plans.margin import active_categories, sales_coupon_margin, supplier_income

# Fixed value (reference): module / department names of the fresh-food modules
# ("fresh ingredients" | "gourmet").
FRESH_PATTERN = "新鲜食材|美食"
STORE_SKU = ("store_id", "sku_id")


def fresh_sales(sales: DataFrame, category: DataFrame) -> DataFrame:
    """Sales lines of fresh categories (the fresh sales extract)."""
    fresh = category.where(matches_any("module_name", FRESH_PATTERN)).select("category_id").distinct()
    return sales.join(fresh, "category_id", "left_semi")


def fresh_coupon(coupon: DataFrame) -> DataFrame:
    """PIPE-09 step 1 / FLT-04: coupon lines of fresh departments."""
    return coupon.where(matches_any("department", FRESH_PATTERN))


def fresh_margin(sales: DataFrame, coupon: DataFrame, category: DataFrame) -> DataFrame:
    """PIPE-09 (inferred): fresh sales ⟗ fresh coupon at store x SKU."""
    return sales_coupon_margin(fresh_sales(sales, category), fresh_coupon(coupon), STORE_SKU,
                               measures=("net_sales", "cost", "qty", "gross_margin"), how="full")


def fresh_oi_hop1(sales: DataFrame, oi: DataFrame, category: DataFrame) -> tuple[DataFrame, DataFrame]:
    """ALC-07 hop 1: positive fresh sales (FLT-01); OI by supplier x category,
    then unmatched fresh OI by category, then kept whole on the sentinel SKU."""
    lines = (fresh_sales(sales, category).where(F.col("net_sales") > 0)
             .select("supplier_id", "category_id", "sku_id", "net_sales"))
    levels = [Level(("supplier_id", "category_id"), ("sku_id",)),
              Level(("category_id",), ("sku_id",))]
    return waterfall(lines, supplier_income(oi).select("supplier_id", "category_id", "oi_amount"),
                     levels, weight="net_sales", amount="oi_amount",
                     scope=active_categories(category, module_name_pattern=FRESH_PATTERN))


def fresh_oi(sales: DataFrame, oi: DataFrame, category: DataFrame, hop1: DataFrame | None = None) -> DataFrame:
    """PIPE-10 / ALC-07 hop 2: SKU totals of hop 1 spread over stores by the
    SKU's positive store sales; a SKU without store sales keeps its whole amount
    on the sentinel store with share 1. Columns: store, SKU, share, SKU amount,
    store x SKU amount."""
    if hop1 is None:
        hop1, _ = fresh_oi_hop1(sales, oi, category)
    # SKU totals of hop 1 (AGG-11) are the pool of hop 2
    sku_amount = rollup(hop1, ["sku_id"], ["alloc_amount"]).select("sku_id", F.col("alloc_amount").alias("sku_amount"))
    lines = (fresh_sales(sales, category).where(F.col("net_sales") > 0)
             .select("store_id", "sku_id", "net_sales"))
    out = reallocate_single(lines, sku_amount, ["sku_id"], "net_sales", "sku_amount", ("store_id",),
                            residual_share=1.0, pool_is_rolled_up=True)
    return out.select("store_id", "sku_id", "alloc_share", F.col("pool_amount").alias("sku_amount"),
                      "alloc_amount")


def fresh_total(sales: DataFrame, coupon: DataFrame, oi: DataFrame, category: DataFrame) -> DataFrame:
    """PIPE-11 (inferred): fresh margin ⟗ fresh OI on store x SKU, with the
    total margin after coupon and OI."""
    m = fresh_margin(sales, coupon, category)
    o = fresh_oi(sales, oi, category)
    keys = list(STORE_SKU)
    out = combine({"m": m.select(*keys, "net_sales", "gross_margin", "coupon_cost"),
                   "oi": o.select(*keys, F.col("alloc_amount").alias("oi_amount"))},
                  keys, {"m": ["net_sales", "gross_margin", "coupon_cost"], "oi": ["oi_amount"]})
    total = (F.col("gross_margin") - F.col("coupon_cost") + F.col("oi_amount")).cast(WIDE_MONEY)
    return (out.withColumn("total_margin", total)
            .withColumn("total_margin_rate", ratio(total, "net_sales")))
