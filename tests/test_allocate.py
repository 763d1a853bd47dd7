"""Allocation kernel and waterfall: FIXTURES §3 cases and conservation properties."""

from decimal import Decimal

from hypothesis import given, settings, strategies as st
from pyspark.sql import functions as F

from profitlens.functions.expr import UNALLOCATED
from profitlens.operators.allocate import Level, allocate, waterfall

LINES = "g string, line string, w decimal(18,4)"
POOL = "g string, amt decimal(18,4)"


def _d(x):
    return Decimal(str(x))


def test_matched(spark):
    lines = spark.createDataFrame([("a", "l1", _d(1)), ("a", "l2", _d(3))], LINES)
    pool = spark.createDataFrame([("a", _d(100))], POOL)
    alloc, resid = allocate(lines, pool, ["g"], "w", "amt", ["line"])
    got = {r.line: float(r.alloc_amount) for r in alloc.collect()}
    assert got == {"l1": 25.0, "l2": 75.0}
    assert resid.count() == 0


def test_negative_weight(spark):
    lines = spark.createDataFrame([("a", "l1", _d(4)), ("a", "l2", _d(-2))], LINES)
    pool = spark.createDataFrame([("a", _d(10))], POOL)
    alloc, _ = allocate(lines, pool, ["g"], "w", "amt", ["line"])
    assert {r.line: float(r.alloc_amount) for r in alloc.collect()} == {"l1": 20.0, "l2": -10.0}


def test_zero_base_goes_to_residual(spark):
    lines = spark.createDataFrame([("a", "l1", _d("0.004")), ("a", "l2", _d("0.005"))], LINES)
    pool = spark.createDataFrame([("a", _d(10))], POOL)
    alloc, resid = allocate(lines, pool, ["g"], "w", "amt", ["line"])
    assert alloc.count() == 0
    assert [float(r.amt) for r in resid.collect()] == [10.0]
    # reference behaviour: shares 0, pool counted as matched, money lost
    alloc, resid = allocate(lines, pool, ["g"], "w", "amt", ["line"], strict_reference=True)
    assert sorted(float(r.alloc_amount) for r in alloc.collect()) == [0.0, 0.0]
    assert resid.count() == 0


def test_waterfall_levels_and_conservation(spark):
    lines = spark.createDataFrame(
        [("s1", "c1", "k1", _d(10)), ("s1", "c1", "k2", _d(30)), ("s2", "c2", "k3", _d(5))],
        "sup string, cat string, sku string, w decimal(18,4)")
    pool = spark.createDataFrame(
        [("s1", "c1", _d(40)),      # matched at level 1
         ("s9", "c2", _d(12)),      # category only -> level 2
         ("s9", "c9", _d(7)),       # neither -> kept whole
         ("s8", "c8", _d(3))],      # out of scope -> unallocated
        "sup string, cat string, amt decimal(18,4)")
    scope = spark.createDataFrame([("c1",), ("c2",), ("c9",)], "cat string")
    out, unalloc = waterfall(lines, pool, [Level(("sup", "cat"), ("sku",)), Level(("cat",), ("sku",))],
                             "w", "amt", scope=scope)
    rows = out.collect()
    by_level = {}
    for r in rows:
        by_level.setdefault(r.alloc_level, []).append(r)
    assert sorted((r.sku, float(r.alloc_amount)) for r in by_level[1]) == [("k1", 10.0), ("k2", 30.0)]
    assert [(r.sku, r.sup, float(r.alloc_amount)) for r in by_level[2]] == [("k3", UNALLOCATED, 12.0)]
    assert [(r.cat, r.sku, float(r.alloc_amount)) for r in by_level[3]] == [("c9", UNALLOCATED, 7.0)]
    assert [float(r.amt) for r in unalloc.collect()] == [3.0]
    total = sum(float(r.alloc_amount) for r in rows) + 3.0
    assert abs(total - 62.0) < 1e-9


@settings(max_examples=8, deadline=None)
@given(st.lists(st.tuples(st.sampled_from(["a", "b", "c"]), st.integers(-50, 500)), min_size=1, max_size=12),
       st.lists(st.tuples(st.sampled_from(["a", "b", "d"]), st.integers(-1000, 100000)), min_size=1, max_size=6))
def test_conservation_property(spark, lines, pools):
    ldf = spark.createDataFrame([(g, f"l{i}", _d(w)) for i, (g, w) in enumerate(lines)], LINES)
    pdf = spark.createDataFrame([(g, _d(a) / 100) for g, a in pools], POOL)
    alloc, resid = allocate(ldf, pdf, ["g"], "w", "amt", ["line"])
    a = alloc.agg(F.coalesce(F.sum("alloc_amount"), F.lit(0))).collect()[0][0]
    r = resid.agg(F.coalesce(F.sum("amt"), F.lit(0))).collect()[0][0]
    total = sum(_d(x) for _, x in pools) / 100
    # the rounding remainder of each group is absorbed by its largest line: exact
    assert Decimal(a) + Decimal(r) == total
    shares = alloc.groupBy("g").agg(F.sum("alloc_share").alias("s")).collect()
    assert all(abs(float(x.s) - 1.0) < 1e-9 for x in shares)


def test_preaggregation_equivalence(spark):
    rows = [("a", "k1", _d(1)), ("a", "k1", _d(2)), ("a", "k2", _d(3)), ("b", "k3", _d(4))]
    lines = spark.createDataFrame(rows, "g string, line string, w decimal(18,4)")
    pool = spark.createDataFrame([("a", _d(60)), ("b", _d(8))], POOL)
    alloc, _ = allocate(lines, pool, ["g"], "w", "amt", ["line"])
    got = {r.line: float(r.alloc_amount) for r in alloc.collect()}
    assert got == {"k1": 30.0, "k2": 30.0, "k3": 8.0}


def test_groups_of_a_task_are_allocated_as_hot_ones_are(spark, monkeypatch):
    """Lines of groups that fit a task are shuffled once and staged as they are allocated; the result doesn't tell."""
    import sys

    kernel = sys.modules["profitlens.operators.allocate"]
    rows = [(f"g{i % 30}", None if i % 50 == 7 else f"l{i}", _d(i % 11 - 2)) for i in range(300)]
    rows += [("zero", "a", _d("0.004")), ("zero", "b", _d("0.005")), ("none", "a", None), (None, "a", _d(5)), ("even", "a", _d(2)), ("even", "b", _d(2))]
    lines = spark.createDataFrame(rows, LINES)
    pools = [(f"g{i}", _d(100 + i) / 7) for i in range(0, 34, 2)] + [("g0", _d(-3)), ("g2", None)]
    pools += [("zero", _d(4)), ("none", _d(3)), ("even", _d("0.0001")), (None, _d(9)), (None, _d(1))]
    pool = spark.createDataFrame([(g, a if a is None else a.quantize(_d("0.0001"))) for g, a in pools], POOL)
    kept, keep, before = [], kernel.materialize, spark.conf.get("spark.sql.shuffle.partitions")

    def run(parts, **how):
        spark.conf.set("spark.sql.shuffle.partitions", parts)
        try:
            kept.clear()
            alloc, rest = allocate(lines, pool, ["g"], "w", "amt", ["line"], **how)
            return sorted(map(str, alloc.collect())), sorted(map(str, rest.collect()))
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", before)

    monkeypatch.setattr(kernel, "materialize", lambda df, **kw: kept.append(keep(df, **kw)) or kept[-1])
    for how in ({}, {"strict_reference": True}, {"exact": False}):
        hot = run("400", **how)  # each group has more lines than a partition has on average
        assert kept[-1].where("line is not null").count() == 0
        cold = run("1", **how)  # none has
        assert len(cold[0]) > 100 and cold == hot
        assert kept[-1].where("line is not null").count() > 100  # allocated already, not to be shuffled again


def test_hot_key_holding_a_third_of_the_lines(spark):
    # one group carries a third of all lines; results must be exact and whole
    n = 3000
    rows = [("hot" if i % 3 == 0 else f"g{i % 50}", f"l{i}", _d(1 + i % 7)) for i in range(n)]
    lines = spark.createDataFrame(rows, LINES)
    pools = spark.createDataFrame([("hot", _d(1000)), ("g1", _d(50)), ("nope", _d(5))], POOL)
    alloc, resid = allocate(lines, pools, ["g"], "w", "amt", ["line"])
    got = {r.g: float(r.s) for r in alloc.groupBy("g").agg(F.sum("alloc_amount").alias("s")).collect()}
    assert got["hot"] == 1000.0 and got["g1"] == 50.0
    assert alloc.where("g = 'hot'").count() == n // 3          # no line dropped or capped
    assert [float(r.amt) for r in resid.collect()] == [5.0]


def test_materialize_modes_give_the_same_waterfall(spark):
    lines = spark.createDataFrame([("s1", "c1", "k1", _d(10)), ("s2", "c1", "k2", _d(30))],
                                  "sup string, cat string, sku string, w decimal(18,4)")
    pool = spark.createDataFrame([("s1", "c1", _d(40)), ("s9", "c1", _d(12))], "sup string, cat string, amt decimal(18,4)")
    levels = [Level(("sup", "cat"), ("sku",)), Level(("cat",), ("sku",))]
    results = []
    for mode in ("lazy", "parquet", "checkpoint"):
        spark.conf.set("profitlens.materialize", mode)
        try:
            out, _ = waterfall(lines, pool, levels, "w", "amt")
            results.append(sorted((r.sup, r.sku, r.alloc_level, float(r.alloc_amount)) for r in out.collect()))
        finally:
            spark.conf.unset("profitlens.materialize")
    assert results[0] == results[1] == results[2]
    assert results[0] == [("__UNALLOCATED__", "k1", 2, 3.0), ("__UNALLOCATED__", "k2", 2, 9.0), ("s1", "k1", 1, 40.0)]


def test_fallback_keeps_coupon_money_once(spark):
    from profitlens.operators.allocate import allocate_with_fallback
    base = spark.createDataFrame([("c1", "s1", _d(30)), ("c1", "s2", _d(10))],
                                 "cat string, sup string, w decimal(18,4)")
    # c2 has no supplier sales: its coupon rows keep their own supplier; two rows
    # of one supplier must not multiply the money
    rows = spark.createDataFrame([("c1", "sX", _d(8)), ("c2", "s7", _d(5)), ("c2", "s7", _d(1)), ("c2", "s8", _d(2))],
                                 "cat string, sup string, amt decimal(18,4)")
    out = {(r.cat, r.sup): float(r.alloc_amount)
           for r in allocate_with_fallback(base, rows, ["cat"], "w", "amt", ["sup"]).collect()}
    assert out == {("c1", "s1"): 6.0, ("c1", "s2"): 2.0, ("c2", "s7"): 6.0, ("c2", "s8"): 2.0}


def test_second_hop_without_store_keeps_share_one(spark):
    from profitlens.operators.allocate import reallocate_single
    lines = spark.createDataFrame([("st1", "k1", _d(3)), ("st2", "k1", _d(1))],
                                  "store string, sku string, w decimal(18,4)")
    pool = spark.createDataFrame([("k1", _d(8)), ("k9", _d(5))], "sku string, amt decimal(18,4)")
    out = {(r.store, r.sku): (float(r.alloc_share), float(r.alloc_amount))
           for r in reallocate_single(lines, pool, ["sku"], "w", "amt", ("store",), residual_share=1.0).collect()}
    assert out == {("st1", "k1"): (0.75, 6.0), ("st2", "k1"): (0.25, 2.0), (UNALLOCATED, "k9"): (1.0, 5.0)}


def test_legacy_labels(spark):
    from profitlens.operators.allocate import LEGACY_LABELS, with_legacy_labels
    df = spark.createDataFrame([(UNALLOCATED, UNALLOCATED, "k1"), ("7", "web", "k2")],
                               "store_id string, channel string, sku_id string")
    got = sorted(tuple(r) for r in with_legacy_labels(df, LEGACY_LABELS["store_category"]).collect())
    assert got == [("7", "web", "k2"), ("9999", "XXXX", "k1")]


def test_waterfall_strict_reference_loses_zero_base_pool(spark):
    lines = spark.createDataFrame([("s1", "c1", "k1", _d("0.004")), ("s2", "c1", "k2", _d(10))],
                                  "sup string, cat string, sku string, w decimal(18,4)")
    pool = spark.createDataFrame([("s1", "c1", _d(6))], "sup string, cat string, amt decimal(18,4)")
    levels = [Level(("sup", "cat"), ("sku",)), Level(("cat",), ("sku",))]
    fixed, _ = waterfall(lines, pool, levels, "w", "amt")
    assert sorted((r.sku, r.alloc_level, float(r.alloc_amount)) for r in fixed.collect()) == \
        [("k1", 2, 0.0024), ("k2", 2, 5.9976)]          # zero base at level 1 -> level 2 by category
    strict, _ = waterfall(lines, pool, levels, "w", "amt", strict_reference=True)
    assert sorted((r.sku, r.alloc_level, float(r.alloc_amount)) for r in strict.collect()) == \
        [("k1", 1, 0.0)]                                 # original behaviour: share 0, money lost


def test_lines_without_a_grain_value_keep_their_share(spark):
    lines = spark.createDataFrame([("a", "k1", _d(1)), ("a", None, _d(3))], LINES)
    pool = spark.createDataFrame([("a", _d(100))], POOL)
    alloc, resid = allocate(lines, pool, ["g"], "w", "amt", ["line"])
    assert {r.line: float(r.alloc_amount) for r in alloc.collect()} == {"k1": 25.0, None: 75.0}
    assert resid.count() == 0


def test_pools_without_a_key_stay_in_the_residual(spark):
    lines = spark.createDataFrame([("a", "k1", _d(1)), (None, "k2", _d(3))], LINES)
    pool = spark.createDataFrame([("a", _d(1)), (None, _d(7))], POOL)
    alloc, resid = allocate(lines, pool, ["g"], "w", "amt", ["line"])
    assert [(r.g, float(r.alloc_amount)) for r in alloc.collect()] == [("a", 1.0)]
    assert [(r.g, float(r.amt)) for r in resid.collect()] == [(None, 7.0)]


def test_weights_that_nearly_cancel(spark):
    lines = spark.createDataFrame([("a", "k1", _d("20000000000.01")), ("a", "k2", _d("-20000000000.00"))], LINES)
    pool = spark.createDataFrame([("a", _d(5))], POOL)
    alloc, _ = allocate(lines, pool, ["g"], "w", "amt", ["line"])
    assert sum(r.alloc_amount for r in alloc.collect()) == 5


def test_sums_beyond_a_line_amount(spark):
    from profitlens.plans.margin import sales_coupon_margin
    big = spark.createDataFrame([("c", _d("99999999999999.0001"), _d("99999999999999.0001"))] * 30,
                                "k string, net_sales decimal(18,4), gross_margin decimal(18,4)")
    coupon = spark.createDataFrame([("c", _d(1))], "k string, coupon_cost decimal(18,4)")
    r = sales_coupon_margin(big, coupon, ["k"], measures=("net_sales", "gross_margin")).first()
    assert r.post_coupon_margin == 30 * _d("99999999999999.0001") - 1


def test_a_hot_group_is_split(spark):
    """Whatever join runs, the lines of one group are dealt over several tasks."""
    n = 4000
    lines = spark.range(n).select(F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 50))
                                  .alias("g"), F.col("id").cast("string").alias("line"),
                                  (F.col("id") % 7 + 1).cast("decimal(18,4)").alias("w"))
    pool = spark.createDataFrame([("hot", _d(1000)), ("g1", _d(50))], POOL)
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.coalescePartitions.enabled": "false",
            "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1"}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        alloc, _ = allocate(lines, pool, ["g"], "w", "amt", ["line"], exact=False)
        parts = [r.n for r in alloc.where("g = 'hot'").groupBy(F.spark_partition_id()).agg(
            F.count("*").alias("n")).collect()]
    finally:
        for k, v in before.items():
            if v is None:
                spark.conf.unset(k)
            else:
                spark.conf.set(k, v)
    assert sum(parts) == (n + 2) // 3 and max(parts) <= 0.4 * sum(parts)


def test_coupon_cost_without_sales_is_left_out_beside_oi(spark):
    from profitlens.plans.margin import sales_coupon_margin
    schema = "k string, {} decimal(18,4)"
    sales = spark.createDataFrame([("a", _d(10), _d(2))], "k string, net_sales decimal(18,4), gross_margin decimal(18,4)")
    coupon = spark.createDataFrame([("a", _d(1)), ("b", _d(5))], schema.format("coupon_cost"))
    oi = spark.createDataFrame([("b", _d(3))], schema.format("alloc_amount"))
    out = sales_coupon_margin(sales, coupon, ["k"], measures=("net_sales", "gross_margin"),
                              extra={"oi": (oi, ["alloc_amount"])})
    assert {r.k: (float(r.coupon_cost), float(r.alloc_amount)) for r in out.collect()} == {"a": (1.0, 0.0), "b": (0.0, 3.0)}


def test_staged_intermediates_are_released(spark):
    import os

    from profitlens.session import materialize, release_materialized
    release_materialized()
    spark.conf.set("profitlens.materialize", "parquet")
    try:
        df = materialize(spark.range(5))
    finally:
        spark.conf.unset("profitlens.materialize")
    folder = os.path.dirname(df.inputFiles()[0].removeprefix("file://").removeprefix("file:"))
    assert df.count() == 5 and os.path.isdir(folder)
    assert release_materialized() == 1 and not os.path.isdir(folder)


def test_nothing_runs_while_a_report_is_built(spark):
    """Reports without an allocation; an allocation writes its lines and its pools, once per level."""
    from profitlens.catalog import QUERIES
    from profitlens.session import _STAGED
    sf = "/root/testdata/sf0.001"
    QUERIES["pipe04_margin_sku"](spark, sf)  # the conformed lines are staged once
    tracker = spark.sparkContext.statusTracker()
    spark.sparkContext.setJobGroup("building", "reports")
    try:
        for name in ("pipe05_margin_category", "pipe09_fresh_margin", "pipe12_abnormal_list", "pipe03_sku_master"):
            QUERIES[name](spark, sf)
        assert list(tracker.getJobIdsForGroup("building")) == []
        before = len(_STAGED)
        QUERIES["alc06_oi_store_category"](spark, sf)
        assert len(_STAGED) == before + 3  # lines, and the pools of two levels
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
