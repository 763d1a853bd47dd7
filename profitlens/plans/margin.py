"""Margin reports: sales ⟕/⟗ coupon, OI waterfalls, company and SKU margin
(PIPE-04, PIPE-05, PIPE-13, PIPE-14; ALC-05, ALC-06, ALC-08, ALC-09)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from profitlens.functions.expr import WIDE_MONEY, matches_any, not_matching, ratio
from profitlens.operators.allocate import Level, pool_rollup, reallocate_single, waterfall
from profitlens.operators.dims import enrich_all, first_wins
from profitlens.operators.rollup import combine, rollup
from profitlens.session import materialize, release_materialized, staged_inside
from profitlens.sources.layout import combine_stored, store_by_keys

# Fixed values (reference): OI deduction types that are not supplier income
# ("handling" | "porterage"), and the disabled-category marker.
OI_EXCLUDE_PATTERN = "装卸|搬运"
DISABLED_PATTERN = "删除禁用"

SALES_MEASURES = ("net_sales", "cost", "qty", "gross_margin", "discount_net", "price_comp", "shrink")
DERIVED = ("margin_rate", "coupon_rate", "post_coupon_margin", "post_coupon_margin_rate")
SKU_KEYS = ("category_id", "store_id", "channel", "sku_id")
STORE_CHANNEL_KEYS = ("category_id", "store_id", "channel")
CHAIN_KEYS = ("category_id", "channel", "sku_id")
# ALC-05: supplier x category x store, then category
STORE_SKU_LEVELS = (Level(("supplier_id", "category_id", "store_id"), ("channel", "sku_id")),
                    Level(("category_id",), ("sku_id",)))


def supplier_income(oi: DataFrame, exclude: str = OI_EXCLUDE_PATTERN) -> DataFrame:
    """OI lines without handling/porterage deductions (FLT-05); a NULL type is kept (S12)."""
    return oi.where(not_matching("deduction_type", exclude))


def active_categories(category: DataFrame, modules: Sequence[str] | None = None,
                      module_name_pattern: str | None = None) -> DataFrame:
    """Categories in scope: optional module list (FLT-06) or module-name pattern
    (FLT-04), never a disabled one (FLT-05). Returns ``category_id``."""
    cond = not_matching("category_name", DISABLED_PATTERN)
    if modules is not None:
        cond = cond & F.col("module_id").isin(*modules)
    if module_name_pattern is not None:
        cond = cond & matches_any("module_name", module_name_pattern)
    return category.where(cond).select("category_id").distinct()


def scope_range(sales: DataFrame, categories: DataFrame, keys: Sequence[str]) -> DataFrame:
    """FLT-12: the distinct keys that the chosen categories sell under, marked in
    scope (PRJ-07); other facts are cut to it by a semi join."""
    return (sales.join(categories, "category_id", "left_semi").select(*keys).distinct()
            .withColumn("in_scope", F.lit(1)))


def with_margin_measures(df: DataFrame) -> DataFrame:
    """Derived measures (§2.10): rates taken before the NULL fill become 0 when
    undefined; the post-coupon rate is taken after it, so 0/0 stays NULL."""
    pcm = (F.col("gross_margin") - F.col("coupon_cost")).cast(WIDE_MONEY)
    return (df.withColumn("margin_rate", ratio("gross_margin", "net_sales", fill=0))
            .withColumn("coupon_rate", ratio("coupon_cost", "net_sales", fill=0))
            .withColumn("post_coupon_margin", pcm)
            .withColumn("post_coupon_margin_rate", ratio(pcm, "net_sales")))


def _sold():
    """Marks a line, and so its key, as sales."""
    return F.lit(1).cast("long")


def sales_coupon_margin(sales: DataFrame, coupon: DataFrame, keys: Sequence[str],
                        measures: Sequence[str] = SALES_MEASURES, how: str = "left",
                        extra: dict[str, tuple[DataFrame, Sequence[str]]] | None = None,
                        keep_extra: bool = True) -> DataFrame:
    """Sales and coupon cost at one grain (PIPE-04 with ``how='left'``: sales is
    the standard; PIPE-05 with ``how='full'``). ``extra`` adds more facts, e.g.
    allocated OI (PIPE-13); their keys are kept when ``keep_extra``. Each fact's rows are
    summed to the grain by the group-by that combines them (AGG-11): they need no rollup before."""
    keys = list(keys)
    frames = {"sales": sales.select(*keys, *measures, _sold().alias("_sold")),
              "coupon": coupon.select(*keys, "coupon_cost")}
    ms = {"sales": [*measures, "_sold"], "coupon": ["coupon_cost"]}
    for tag, (df, cols) in (extra or {}).items():
        frames[tag] = df.select(*keys, *cols)
        ms[tag] = list(cols)
    if how == "full":
        keep = "any"
    else:
        keep = ["sales"] + ([t for t in (extra or {})] if keep_extra else [])
    return _margin_of(combine(frames, keys, ms, keep=keep), how)


def sold_coupon(sales: DataFrame, coupon: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Coupon cost of the keys that have sales, as PIPE-04 counts it: the key columns and ``coupon_cost``. A report at a
    coarser grain sums this and the other facts once, without summing every measure at ``keys`` before. It is staged, so
    its own shuffle is gone before the report's."""
    keys = list(keys)
    out = combine({"sales": sales.select(*keys, _sold().alias("_sold")), "coupon": coupon.select(*keys, "coupon_cost")},
                  keys, {"sales": ["_sold"], "coupon": ["coupon_cost"]}, keep="sales")
    return materialize(out.drop("_sold"), durable=True)


def _margin_of(out: DataFrame, how: str) -> DataFrame:
    if how != "full":  # coupon cost without sales is not part of the report, though another fact keeps its key
        out = out.withColumn("coupon_cost", F.when(F.col("_sold") > 0, F.col("coupon_cost")).otherwise(F.lit(0)))
    return with_margin_measures(out.drop("_sold"))


def store_margin_facts(sales: DataFrame, coupon: DataFrame, root: str, keys: Sequence[str] = STORE_CHANNEL_KEYS,
                       buckets: int | None = None, partition: dict[str, str] | None = None) -> int:
    """Store the lines of sales and coupon by the keys that PIPE-04 and PIPE-05 share; returns the version."""
    return store_by_keys({"sales": sales.withColumn("_sold", _sold()), "coupon": coupon}, keys, root, "margin_facts",
                         buckets, partition)


def stored_margin(spark: SparkSession, root: str, keys: Sequence[str], measures: Sequence[str] = SALES_MEASURES,
                  how: str = "left") -> DataFrame:
    """PIPE-04 / PIPE-05 from the stored lines, which aren't shuffled again; the same rows as ``sales_coupon_margin``."""
    out = combine_stored(spark, root, "margin_facts", keys, {"sales": [*measures, "_sold"], "coupon": ["coupon_cost"]},
                         keep="any" if how == "full" else "sales")
    return _margin_of(out, how)


# ---------------------------------------------------------------- OI waterfalls

def oi_store_sku(sales: DataFrame, oi: DataFrame, category: DataFrame,
                 modules: Sequence[str]) -> tuple[DataFrame, DataFrame]:
    """ALC-05: OI to store x SKU. L1 supplier x category x store; unmatched OI of
    the chosen modules by category (L2, lines carry category and SKU only); the
    rest kept whole on the sentinel SKU. Out-of-scope OI is returned separately."""
    lines = sales.select("supplier_id", "category_id", "store_id", "channel", "sku_id", "net_sales")
    return waterfall(lines, supplier_income(oi).select("supplier_id", "category_id", "store_id", "oi_amount"),
                     STORE_SKU_LEVELS, weight="net_sales", amount="oi_amount",
                     scope=active_categories(category, modules=modules))


def oi_store_category(sales: DataFrame, oi: DataFrame, category: DataFrame) -> tuple[DataFrame, DataFrame]:
    """ALC-06: OI to category x store x channel. L2 spreads over the category's
    real stores, suppliers and channels; scope = categories not disabled."""
    lines = sales.select("supplier_id", "category_id", "store_id", "channel", "net_sales")
    levels = [Level(("supplier_id", "category_id", "store_id"), ("channel",)),
              Level(("category_id",), ("store_id", "supplier_id", "channel"))]
    return waterfall(lines, supplier_income(oi).select("supplier_id", "category_id", "store_id", "oi_amount"),
                     levels, weight="net_sales", amount="oi_amount",
                     scope=active_categories(category))


def oi_chain_sku(sales: DataFrame, oi: DataFrame) -> DataFrame:
    """ALC-09: chain-wide OI to channel x SKU by supplier x category; unmatched
    OI kept whole on the sentinel channel and SKU."""
    lines = sales.select("supplier_id", "category_id", "channel", "sku_id", "net_sales")
    alloc, _ = waterfall(lines, supplier_income(oi).select("supplier_id", "category_id", "oi_amount"),
                         [Level(("supplier_id", "category_id"), ("channel", "sku_id"))],
                         weight="net_sales", amount="oi_amount")
    return alloc


def realloc_to_sku(sales: DataFrame, allocated: DataFrame) -> DataFrame:
    """ALC-08: re-allocate an allocated result at category x store x channel down
    to SKU over positive sales lines; unmatched amounts go to the sentinel SKU."""
    lines = sales.where(F.col("net_sales") > 0).select(*STORE_CHANNEL_KEYS, "sku_id", "net_sales")
    pool = pool_rollup(allocated.select(*STORE_CHANNEL_KEYS, "alloc_amount"), STORE_CHANNEL_KEYS, "alloc_amount")
    return reallocate_single(lines, pool, STORE_CHANNEL_KEYS, "net_sales", "alloc_amount", ("sku_id",),
                             pool_is_rolled_up=True)


def oi_rerolled(allocated: DataFrame, keys: Sequence[str]) -> DataFrame:
    """AGG-11: allocated OI summed to the report grain (drops the supplier)."""
    return rollup(allocated, keys, ["alloc_share", "alloc_amount"])


# ---------------------------------------------------------------- reports

def sku_margin_with_oi(sales: DataFrame, coupon: DataFrame, oi: DataFrame, category: DataFrame,
                       modules: Sequence[str]) -> DataFrame:
    """PIPE-13 (store x SKU): PIPE-04 ⟗ ALC-05 re-rolled to category x store x channel x SKU."""
    alloc, _ = oi_store_sku(sales, oi, category, modules)
    return sales_coupon_margin(sales, coupon, SKU_KEYS, how="left",
                               extra={"oi": (alloc, ["alloc_share", "alloc_amount"])})


def company_margin(sales: DataFrame, coupon: DataFrame, oi: DataFrame, category: DataFrame,
                   alloc: DataFrame | None = None) -> DataFrame:
    """PIPE-13 (company): PIPE-05 at category x store x channel ⟗ ALC-06 re-rolled.
    ``alloc`` reuses an ALC-06 result computed by the caller."""
    if alloc is None:
        alloc, _ = oi_store_category(sales, oi, category)
    return sales_coupon_margin(sales, coupon, STORE_CHANNEL_KEYS, how="full",
                               measures=SALES_MEASURES + ("footfall",),
                               extra={"oi": (alloc, ["alloc_share", "alloc_amount"])})


def sku_master(sales: DataFrame, coupon: DataFrame, stock: DataFrame | None = None) -> DataFrame:
    """PIPE-03: SKU names, sales first, then coupon, then stock."""
    srcs = [sales, coupon] + ([stock] if stock is not None else [])
    return first_wins([s.select("sku_id", "sku_name") for s in srcs], "sku_id", ["sku_name"])


def category_names(category: DataFrame) -> DataFrame:
    """Category master for enrichment: module and category names, one row per category."""
    return first_wins([category], "category_id", ["module_id", "module_name", "category_name"])


def store_names(store: DataFrame) -> DataFrame:
    """Store master for enrichment: format and name, one row per store."""
    return first_wins([store], "store_id", ["store_format", "store_name"])


def partial_sku_margin(sales: DataFrame, coupon: DataFrame, oi: DataFrame, category: DataFrame) -> DataFrame:
    """PIPE-13 (partial): PIPE-04 ⟗ ALC-08, the company-level OI re-allocated to SKU."""
    alloc, _ = oi_store_category(sales, oi, category)
    return sales_coupon_margin(sales, coupon, SKU_KEYS, how="left",
                               extra={"oi": (realloc_to_sku(sales, alloc), ["alloc_share", "alloc_amount"])})


def chain_margin(sales: DataFrame, coupon: DataFrame) -> DataFrame:
    """PIPE-04 (chain): sales ⟕ coupon at category x channel x SKU."""
    return sales_coupon_margin(sales, coupon, CHAIN_KEYS, how="left")


def chain_sku_margin(sales: DataFrame, coupon: DataFrame, oi: DataFrame,
                     alloc: DataFrame | None = None) -> DataFrame:
    """PIPE-13 (chain): PIPE-04 at category x channel x SKU ⟗ ALC-09 OI (``alloc``,
    if the caller has it)."""
    if alloc is None:
        alloc = oi_chain_sku(sales, oi)
    return sales_coupon_margin(sales, coupon, CHAIN_KEYS, how="left",
                               extra={"oi": (alloc, ["alloc_share", "alloc_amount"])})


def _enriched_margin(margin: DataFrame, masters: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """A margin report with its masters' names. Derived measures are functions of the
    others and are taken after the joins, so no join writes or shuffles them. The masters
    are staged first: their own shuffles are gone by then, and Spark knows the bytes of a
    small one before it would shuffle the report for it."""
    masters = [(materialize(dim, durable=True), on) for dim, on in masters]
    out = with_margin_measures(enrich_all(margin.drop(*DERIVED), masters))
    keys = [on for _, on in reversed(masters)]
    names = [c for c in out.columns if c not in margin.columns]
    return out.select(*keys, *[c for c in margin.columns if c not in keys], *names)


def enriched_sku_margin(sales: DataFrame, coupon: DataFrame, oi: DataFrame, category: DataFrame,
                        store: DataFrame, modules: Sequence[str]) -> DataFrame:
    """PIPE-14: the store x SKU margin with category, SKU and store names. The tables of its waterfall go once the
    report is staged."""
    with staged_inside() as own:
        m = sku_margin_with_oi(sales, coupon, oi, category, modules)
    out = _enriched_margin(m, [(category_names(category), "category_id"), (store_names(store), "store_id"),
                               (sku_master(sales, coupon), "sku_id")])
    release_materialized(own)
    return out


def enriched_chain_margin(sales: DataFrame, coupon: DataFrame, oi: DataFrame, category: DataFrame) -> DataFrame:
    """PIPE-14 (chain): the chain margin with SKU and category names."""
    return _enriched_margin(chain_sku_margin(sales, coupon, oi), [(sku_master(sales, coupon), "sku_id"),
                                                                  (category_names(category), "category_id")])


def enriched_company_margin(sales: DataFrame, coupon: DataFrame, oi: DataFrame, category: DataFrame,
                            store: DataFrame) -> DataFrame:
    """PIPE-14 (company): the company margin with category and store names."""
    return _enriched_margin(company_margin(sales, coupon, oi, category),
                            [(category_names(category), "category_id"), (store_names(store), "store_id")])
