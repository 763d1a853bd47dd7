"""Registered queries: one per operator / report of the inventory.

Each entry takes ``(spark, sf_dir)`` and returns a DataFrame computed from the
whole input tables. Money leaves as DOUBLE (an exact cast of the DECIMAL sum);
ratios are DOUBLE quotients of those exact values.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profitlens.functions.expr import (
    UNALLOCATED, conform_code, conform_numeric_code, pattern_match, round_half_even,
)
from profitlens.operators.control import write_with_totals
from profitlens.operators.overlap import overlap_report, union_once
from profitlens.operators.realloc import StoredWaterfall, read_waterfall, update_waterfall
from profitlens.operators.rollup import date_completeness, null_key_report, reconcile, rollup
from profitlens.operators.states import StateSpec, finish_state, merge_states, period_state, state_outliers
from profitlens.operators.stats import quantile_filter, sigma_outliers
from profitlens.plans import abnormal, coupon as coupon_plans, fresh, margin, stock as stock_plans, supplier
from profitlens.session import checkpoint_dir, materialize
from profitlens.sources.facts import Facts
from profitlens.sources.testdata import cached_facts, fact_coverage, read_table

# Parameters of the registered queries.
MODULES = ("1", "2", "3")      # modules analysed by the store x SKU OI waterfall
DAYS = 31                      # days in the period (stock turnover)
SIGMA_K = 6.0                  # outlier cut-off
INLIER_K = 1.5                 # inlier cut-off
CHAIN_K = 3.0                  # outlier cut-off among the few SKUs x channels of a category
TOP_Q = 0.8                    # top-quantile filter


def finish(df: DataFrame) -> DataFrame:
    """Report types: DECIMAL -> DOUBLE (exact values of the fixed-point sums)."""
    cols = []
    for f in df.schema.fields:
        if isinstance(f.dataType, T.DecimalType):
            cols.append(F.col(f.name).cast("double").alias(f.name))
        else:
            cols.append(F.col(f.name))
    return df.select(*cols)


def _facts(spark: SparkSession, sf_dir: str) -> Facts:
    return cached_facts(spark, sf_dir)


def q_pipe04_margin_sku(spark, sf_dir):
    f = _facts(spark, sf_dir)
    return finish(margin.sales_coupon_margin(f.sales, f.coupon, margin.SKU_KEYS, how="left"))


def _stored_root(spark):
    return f"{checkpoint_dir(spark)}/stored/{uuid.uuid4().hex}"


def q_pipe04_margin_stored(spark, sf_dir):
    # PIPE-04 from lines stored by category, store and channel: no line is shuffled again
    f, root = _facts(spark, sf_dir), _stored_root(spark)
    margin.store_margin_facts(f.sales, f.coupon, root)
    return finish(margin.stored_margin(spark, root, margin.SKU_KEYS))


def q_pipe05_margin_stored(spark, sf_dir):
    # PIPE-05 from two stored extracts of each month: one row for each key and extract is shuffled
    f, root = _facts(spark, sf_dir), _stored_root(spark)
    for i, (sales, coupon) in enumerate(zip(_half_months(f.sales), _half_months(f.coupon))):
        margin.store_margin_facts(sales, coupon, root, partition={"extract": str(i)})
    return finish(margin.stored_margin(spark, root, margin.STORE_CHANNEL_KEYS,
                                       margin.SALES_MEASURES + ("footfall",), how="full"))


def q_pipe05_margin_category(spark, sf_dir):
    f = _facts(spark, sf_dir)
    return finish(margin.sales_coupon_margin(f.sales, f.coupon, margin.STORE_CHANNEL_KEYS,
                                             measures=margin.SALES_MEASURES + ("footfall",), how="full"))


def q_pipe05_margin_abnormal(spark, sf_dir):
    f = _facts(spark, sf_dir)
    return finish(abnormal.working_data(f.sales, f.coupon))


def q_prj05_conform_codes(spark, sf_dir):
    p = read_table(spark, sf_dir, "part")
    return p.select(conform_code("p_partkey").alias("sku_id"),
                    conform_code("p_name").alias("sku_name"),
                    conform_code("p_brand").alias("category_id"),
                    conform_numeric_code("p_retailprice").alias("price_code"))


def q_prj12_round(spark, sf_dir):
    f = _facts(spark, sf_dir)
    r = rollup(f.sales, ["category_id", "store_id"], ["net_sales", "gross_margin"])
    r = margin.with_margin_measures(r.withColumn("coupon_cost", F.lit(0).cast("decimal(18,4)")))
    return r.select("category_id", "store_id",
                    round_half_even("net_sales", 2).alias("net_sales"),
                    round_half_even("gross_margin", 2).alias("gross_margin"),
                    round_half_even(F.col("margin_rate") * 100, 2).alias("margin_rate_pct"))


def q_flt05_oi_scope(spark, sf_dir):
    f = _facts(spark, sf_dir)
    inc = margin.supplier_income(f.oi)
    return finish(rollup(inc, ["supplier_id", "category_id", "store_id", "deduction_type"], ["oi_amount"]))


def q_flt07_semi_category(spark, sf_dir):
    f = _facts(spark, sf_dir)
    s = f.sales.join(margin.active_categories(f.category, modules=MODULES), "category_id", "left_semi")
    return finish(rollup(s, ["category_id", "store_id"], ["net_sales", "gross_margin"]))


def q_flt11_pattern_match(spark, sf_dir):
    c = read_table(spark, sf_dir, "customer")
    key = F.concat(F.col("c_nationkey").cast("string"), F.lit("$"))
    return c.select("c_custkey", "c_name", key.alias("match_key"),
                    pattern_match("c_name", key).alias("matched"))


def q_flt12_scope_range(spark, sf_dir):
    f = _facts(spark, sf_dir)
    return margin.scope_range(f.sales, margin.active_categories(f.category, modules=("1",)), margin.STORE_CHANNEL_KEYS)


def q_jn06_unmatched_oi(spark, sf_dir):
    f = _facts(spark, sf_dir)
    keys = ["supplier_id", "category_id", "store_id"]
    pool = rollup(margin.supplier_income(f.oi), keys, ["oi_amount"])
    return finish(pool.join(f.sales.select(*keys).distinct(), keys, "left_anti"))


def q_alc04_coupon_to_supplier(spark, sf_dir):
    f = _facts(spark, sf_dir)
    return finish(supplier.supplier_coupon_by_sales(f.sales, f.coupon))


def q_alc05_oi_store_sku(spark, sf_dir):
    f = _facts(spark, sf_dir)
    alloc, _ = margin.oi_store_sku(f.sales, f.oi, f.category, MODULES)
    return finish(alloc)


def q_alc05_unallocated(spark, sf_dir):
    f = _facts(spark, sf_dir)
    _, unalloc = margin.oi_store_sku(f.sales, f.oi, f.category, MODULES)
    return finish(unalloc)


def q_alc06_oi_store_category(spark, sf_dir):
    f = _facts(spark, sf_dir)
    alloc, _ = margin.oi_store_category(f.sales, f.oi, f.category)
    return finish(alloc)


def q_alc07_fresh_two_hop(spark, sf_dir):
    f = _facts(spark, sf_dir)
    hop1, _ = fresh.fresh_oi_hop1(f.sales, f.oi, f.category)
    return finish(hop1)


def q_alc08_realloc_sku(spark, sf_dir):
    f = _facts(spark, sf_dir)
    alloc, _ = margin.oi_store_category(f.sales, f.oi, f.category)
    return finish(margin.realloc_to_sku(f.sales, alloc))


def q_alc09_oi_chain_sku(spark, sf_dir):
    f = _facts(spark, sf_dir)
    return finish(margin.oi_chain_sku(f.sales, f.oi))


def q_pipe02_coupon_type(spark, sf_dir):
    f = _facts(spark, sf_dir)
    return finish(coupon_plans.coupon_type_margin(f.coupon_type, f.coupon))


def q_pipe03_supplier_master(spark, sf_dir):
    f = _facts(spark, sf_dir)
    return supplier.supplier_master(f.sales, margin.supplier_income(f.oi), f.coupon)


def q_pipe06_supplier_coupon(spark, sf_dir):
    f = _facts(spark, sf_dir)
    return finish(supplier.supplier_coupon_direct(f.coupon))


def q_pipe08_supplier_net_margin(spark, sf_dir):
    f = _facts(spark, sf_dir)
    return finish(supplier.supplier_net_margin(f.sales, f.oi, f.coupon))


def q_pipe13_company_margin(spark, sf_dir):
    f = _facts(spark, sf_dir)
    return finish(margin.company_margin(f.sales, f.coupon, f.oi, f.category))


def q_pipe13_sku_margin(spark, sf_dir):
    f = _facts(spark, sf_dir)
    return finish(margin.sku_margin_with_oi(f.sales, f.coupon, f.oi, f.category, MODULES))


def q_pipe14_enriched_margin(spark, sf_dir):
    f = _facts(spark, sf_dir)
    return finish(margin.enriched_sku_margin(f.sales, f.coupon, f.oi, f.category, f.store, MODULES))


def q_pipe15_turnover_store(spark, sf_dir):
    f = _facts(spark, sf_dir)
    return finish(stock_plans.store_turnover(f.sales, f.coupon, f.oi, f.stock, f.category, MODULES, DAYS))


def q_pipe16_turnover_sku(spark, sf_dir):
    f = _facts(spark, sf_dir)
    return finish(stock_plans.sku_turnover(f.sales, f.coupon, f.oi, f.stock, DAYS))


def q_pipe17_category_scorecard(spark, sf_dir):
    f = _facts(spark, sf_dir)
    return finish(stock_plans.category_scorecard(f.sales, f.coupon, f.oi, f.stock))


def q_sta01_top_quantile(spark, sf_dir):
    f = _facts(spark, sf_dir)
    r = rollup(f.sales, ["category_id", "store_id", "sku_id"], ["net_sales"])
    return finish(quantile_filter(r, "category_id", "net_sales", TOP_Q))


def _events(spark, sf_dir):
    return read_table(spark, sf_dir, "events").select("event_id", "event_type", "user_id", "value")


def q_sta02_sigma_outliers(spark, sf_dir):
    return sigma_outliers(_events(spark, sf_dir), "event_type", "value", SIGMA_K, keep="outside")


def q_sta03_inliers(spark, sf_dir):
    return sigma_outliers(_events(spark, sf_dir), "event_type", "value", INLIER_K, keep="inside")


def q_sta04_number_outliers(spark, sf_dir):
    f = _facts(spark, sf_dir)
    r = rollup(f.sales, ["category_id", "store_id", "sku_id"], ["qty"])
    return finish(sigma_outliers(r, "category_id", "qty", SIGMA_K))


def q_sta05_two_metric_outliers(spark, sf_dir):
    f = _facts(spark, sf_dir)
    return finish(abnormal.two_metric_outliers(abnormal.working_data(f.sales, f.coupon), SIGMA_K))


def q_sta06_category_outliers(spark, sf_dir):
    f = _facts(spark, sf_dir)
    m = margin.chain_sku_margin(f.sales, f.coupon, f.oi)
    return finish(sigma_outliers(m.select("category_id", "channel", "sku_id", "post_coupon_margin"),
                                 "category_id", "post_coupon_margin", CHAIN_K))


def q_pipe12_abnormal_summary(spark, sf_dir):
    f = _facts(spark, sf_dir)
    return abnormal.abnormal_summary(f.sales, f.coupon, f.category, f.store, SIGMA_K)


def q_pipe12_abnormal_drill(spark, sf_dir):
    f = _facts(spark, sf_dir)
    return abnormal.abnormal_drill(f.sales, f.coupon, f.category, f.store, SIGMA_K)


def q_pipe09_fresh_margin(spark, sf_dir):
    f = _facts(spark, sf_dir)
    return finish(fresh.fresh_margin(f.sales, f.coupon, f.category))


def q_pipe10_fresh_oi(spark, sf_dir):
    f = _facts(spark, sf_dir)
    return finish(fresh.fresh_oi(f.sales, f.oi, f.category))


def q_pipe11_fresh_total(spark, sf_dir):
    f = _facts(spark, sf_dir)
    return finish(fresh.fresh_total(f.sales, f.coupon, f.oi, f.category))


def q_pipe01_union_complete(spark, sf_dir):
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    # the period extracts of a company: two halves of the days of a month, undated rows with the first
    late = F.coalesce(F.dayofmonth("ts") > 15, F.lit(False))
    return coupon_plans.union_with_completeness([ev.where(~late), ev.where(late)], "ts")


def q_agg13_reconcile(spark, sf_dir):
    f = _facts(spark, sf_dir)
    alloc, unalloc = margin.oi_store_category(f.sales, f.oi, f.category)
    alloc = materialize(alloc, durable=True)  # read by the margin report and by the OI control total
    cm = materialize(margin.company_margin(f.sales, f.coupon, f.oi, f.category, alloc=alloc), durable=True)
    return finish(reconcile({
        "net_sales": (f.sales, "net_sales", cm, "net_sales"),
        "coupon_cost": (f.coupon, "coupon_cost", cm, "coupon_cost"),
        "oi_amount": (margin.supplier_income(f.oi), "oi_amount", _oi_out(alloc, unalloc), "amount"),
    }))


def _oi_out(alloc, unalloc):
    """What became of an OI pool: allocated amounts and what is out of scope."""
    return alloc.select(F.col("alloc_amount").alias("amount")).unionByName(
        unalloc.select(F.col("oi_amount").alias("amount")))


def q_agg13_scorecard(spark, sf_dir):
    f = _facts(spark, sf_dir)
    card = materialize(stock_plans.category_scorecard(f.sales, f.coupon, f.oi, f.stock), durable=True)
    raw = {"net_sales": f.sales, "coupon_cost": f.coupon, "oi_amount": margin.supplier_income(f.oi),
           "stock_value": f.stock}
    return finish(reconcile({m: (d, m, card, m) for m, d in raw.items()}))


def q_agg13_fresh(spark, sf_dir):
    f = _facts(spark, sf_dir)
    inc = margin.supplier_income(f.oi)
    fresh_inc = inc.join(margin.active_categories(f.category, module_name_pattern=fresh.FRESH_PATTERN),
                         "category_id", "left_semi")
    hop1, unalloc = fresh.fresh_oi_hop1(f.sales, f.oi, f.category)
    hop1 = materialize(hop1, durable=True)  # read by hop 2 and by its own control total
    hop2 = fresh.fresh_oi(f.sales, f.oi, f.category, hop1)
    return finish(reconcile({
        "oi_amount": (inc, "oi_amount", _oi_out(hop1, unalloc), "amount"),
        "fresh_oi_amount": (fresh_inc, "oi_amount", hop2, "alloc_amount"),
    }))


def q_agg13_chain(spark, sf_dir):
    f = _facts(spark, sf_dir)
    alloc = materialize(margin.oi_chain_sku(f.sales, f.oi), durable=True)  # read by the report and two totals
    m = materialize(margin.chain_sku_margin(f.sales, f.coupon, f.oi, alloc), durable=True)
    return finish(reconcile({
        "oi_amount": (margin.supplier_income(f.oi), "oi_amount", alloc, "alloc_amount"),
        "oi_matched": (alloc.where("alloc_level = 1"), "alloc_amount", m.where(F.col("channel") != UNALLOCATED),
                       "alloc_amount"),
        "net_sales": (f.sales, "net_sales", m, "net_sales"),
    }))


def q_agg13_fact_coverage(spark, sf_dir):
    return finish(fact_coverage(_facts(spark, sf_dir).lines))


def q_agg13_null_keys(spark, sf_dir):
    f = _facts(spark, sf_dir)
    parts = [null_key_report(d, keys, [m]).select(F.lit(name).alias("fact"), "dropped_rows",
                                                  F.col(f"dropped_{m}").cast("decimal(28,4)").alias("dropped_amount"))
             for name, d, keys, m in (
                 ("sales", f.sales, margin.SKU_KEYS, "net_sales"), ("coupon", f.coupon, margin.SKU_KEYS, "coupon_cost"),
                 ("oi", f.oi, ("supplier_id", "category_id", "store_id"), "oi_amount"),
                 ("stock", f.stock, ("category_id", "store_id", "sku_id"), "stock_value"))]
    return finish(coupon_plans.union_extracts(parts))


def q_agg13_observed(spark, sf_dir):
    f = _facts(spark, sf_dir)
    keys = list(margin.STORE_CHANNEL_KEYS)
    _, totals = write_with_totals(
        {"sales": (f.sales, keys, ["net_sales", "cost", "gross_margin"]), "coupon": (f.coupon, keys, ["coupon_cost"])},
        lambda w: margin.sales_coupon_margin(w["sales"], w["coupon"], keys, how="full"),
        lambda report: materialize(report, durable=True))
    return finish(totals.drop("recomputed"))


def _half_months(df):
    """The two extracts of each month; undated rows come with the first."""
    late = F.coalesce(F.dayofmonth("biz_date") > 15, F.lit(False))
    return [df.where(~late), df.where(late)]


def q_alc05_late_extract(spark, sf_dir):
    # ALC-05 as a stored waterfall: the first extracts, then the late ones of both sides
    f = _facts(spark, sf_dir)
    scope = margin.active_categories(f.category, modules=MODULES)
    stored = StoredWaterfall(_stored_root(spark), "oi", margin.STORE_SKU_LEVELS,
                             "net_sales", "oi_amount")
    late = F.coalesce(F.col("supplier_id").endswith("7"), F.lit(False))
    inc = margin.supplier_income(f.oi)
    for sales, oi in zip(_half_months(f.sales), (inc.where(~late), inc.where(late))):
        update_waterfall(stored, sales, oi, scope)
    return finish(read_waterfall(spark, stored, scope)[0])


def q_agg01_margin_from_states(spark, sf_dir):
    # the report of PIPE-04, from the states of the extracts instead of their lines
    f = _facts(spark, sf_dir)
    merged = {}
    for name, df, sums in (("sales", f.sales, margin.SALES_MEASURES), ("coupon", f.coupon, ("coupon_cost",))):
        spec = StateSpec(margin.SKU_KEYS, sums)
        states = coupon_plans.union_extracts([period_state(e, spec) for e in _half_months(df)])
        merged[name] = merge_states(states, spec)
    return finish(margin.sales_coupon_margin(merged["sales"], merged["coupon"], margin.SKU_KEYS, how="left"))


def q_agg15_merged_moments(spark, sf_dir):
    # monthly states by store, merged to the category's whole history
    f = _facts(spark, sf_dir)
    spec = StateSpec(("month", "category_id", "store_id"), ("net_sales", "qty"), ("net_sales",))
    states = materialize(period_state(f.sales.withColumn("month", F.trunc("biz_date", "month")), spec), durable=True)
    out = finish_state(merge_states(states, spec, ["category_id"]), spec)
    return finish(out.withColumn("net_sales_std", F.round("net_sales_std", 2)))


def q_sta02_state_outliers(spark, sf_dir):
    # each event against its type's moments over all months, of which only the states are read
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    spec = StateSpec(("month", "event_type"), (), ("value",))
    monthly = ev.withColumn("month", F.coalesce(F.date_format("ts", "yyyy-MM"), F.lit("")))
    states = materialize(period_state(monthly, spec), durable=True)
    return state_outliers(ev.drop("ts"), states, spec, "value", CHAIN_K, ["event_type"])


def _overlapping(spark, sf_dir):
    """Extracts of the events' months that overlap: days 13 to 15 and the 5th come again, some others in part."""
    ev = read_table(spark, sf_dir, "events").select("event_id", "ts", "event_type", "value")
    day = F.dayofmonth("ts")
    return [ev.where((day <= 15) | day.isNull()), ev.where((day > 12) & (F.col("event_id") % 3 != 0)),
            ev.where((day > 25) & (F.col("event_id") % 2 == 0)), ev.where(day == 5)]


def q_pipe01_overlap_check(spark, sf_dir):
    return overlap_report(_overlapping(spark, sf_dir), "ts")


def q_pipe01_union_once(spark, sf_dir):
    return date_completeness(union_once(_overlapping(spark, sf_dir), "ts"), "ts")


def q_pipe04_margin_chain(spark, sf_dir):
    f = _facts(spark, sf_dir)
    return finish(margin.chain_margin(f.sales, f.coupon))


def q_pipe13_chain_margin(spark, sf_dir):
    f = _facts(spark, sf_dir)
    return finish(margin.chain_sku_margin(f.sales, f.coupon, f.oi))


def q_pipe13_partial_margin(spark, sf_dir):
    f = _facts(spark, sf_dir)
    return finish(margin.partial_sku_margin(f.sales, f.coupon, f.oi, f.category))


def q_pipe14_enriched_chain(spark, sf_dir):
    f = _facts(spark, sf_dir)
    return finish(margin.enriched_chain_margin(f.sales, f.coupon, f.oi, f.category))


def q_pipe14_enriched_company(spark, sf_dir):
    f = _facts(spark, sf_dir)
    return finish(margin.enriched_company_margin(f.sales, f.coupon, f.oi, f.category, f.store))


def q_pipe14_enriched_scorecard(spark, sf_dir):
    f = _facts(spark, sf_dir)
    return finish(stock_plans.enriched_scorecard(f.sales, f.coupon, f.oi, f.stock, f.category))


def q_pipe15_turnover_category(spark, sf_dir):
    f = _facts(spark, sf_dir)
    return finish(stock_plans.category_turnover(f.sales, f.coupon, f.oi, f.stock, f.category, DAYS))


def q_pipe12_abnormal_list(spark, sf_dir):
    f = _facts(spark, sf_dir)
    return finish(abnormal.abnormal_list(f.sales, f.coupon, f.store, SIGMA_K))


def q_pipe03_coupon_type_master(spark, sf_dir):
    f = _facts(spark, sf_dir)
    return coupon_plans.coupon_type_master(f.coupon_type, f.coupon)


def q_pipe03_sku_master(spark, sf_dir):
    f = _facts(spark, sf_dir)
    return margin.sku_master(f.sales, f.coupon, f.stock)


def _chain_scope(f):
    return margin.scope_range(f.sales, margin.active_categories(f.category, modules=("1",)), ("category_id", "channel"))


def q_flt12_scope_range_chain(spark, sf_dir):
    return _chain_scope(_facts(spark, sf_dir))


def q_flt12_scope_semi(spark, sf_dir):
    f = _facts(spark, sf_dir)
    keys = ["category_id", "channel"]
    return finish(rollup(f.coupon.join(_chain_scope(f), keys, "left_semi"), keys, ["coupon_cost"]))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    name[2:]: fn for name, fn in sorted(globals().items()) if name.startswith("q_") and callable(fn)
}
