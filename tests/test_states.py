"""Period states merge to what a run over all lines gives."""

import random
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from profitlens.operators.rollup import rollup
from profitlens.operators.states import (
    StateSpec, finish_state, merge_states, period_state, read_states, state_outliers, store_extract,
)
from profitlens.sources.versions import manifest

SCHEMA = "period string, cat string, sku string, sales decimal(18,4), value double, tag string"
SPEC = StateSpec(("cat", "sku"), ("sales",), ("value", "sales"))


def _lines(spark, n=3000, seed=1):
    r = random.Random(seed)
    rows = [(f"2024-{r.randint(1, 4):02d}", r.choice(["a", "a", "b", None]), f"s{r.randint(0, 9)}",
             None if r.random() < .1 else Decimal(r.randint(-10**9, 10**9)) / 10000,
             r.choice([None, float("nan"), 1e9 + r.random()]), "x") for _ in range(n)]
    rows += [("2024-01", "one", "s", Decimal(1), 5.0, "x"), ("2024-02", "none", "s", None, None, "x")]
    return spark.createDataFrame(rows, SCHEMA)


def _by_key(df, *keys):
    return {tuple(r[k] for k in keys): r.asDict() for r in df.collect()}


def _states(df, spec=SPEC):
    out = None
    for p in sorted(r.period for r in df.select("period").distinct().collect()):
        s = period_state(df.where(F.col("period") == p), spec)
        out = s if out is None else out.unionByName(s)
    return out


@pytest.mark.parametrize("keys", [("cat", "sku"), ("cat",)])
def test_merged_equals_recomputed(spark, keys):
    df = _lines(spark)
    got = _by_key(finish_state(merge_states(_states(df), SPEC, keys), SPEC), *keys)
    money = _by_key(rollup(df.where("sku is not null"), list(keys), ["sales"]), *keys)
    v = F.when(~F.isnan("value"), F.col("value"))
    want = _by_key(df.where("cat is not null").groupBy(*keys).agg(
        F.count("*").alias("n"), F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"),
        F.stddev_samp(F.col("sales").cast("double")).alias("money_std")), *keys)
    assert set(got) == set(want)
    for k, w in want.items():
        assert got[k]["n_rows"] == w["n"] and got[k]["sales"] == money[k]["sales"]  # to the last digit
        for a, b in (("value_mean", "mean"), ("value_std", "std"), ("sales_std", "money_std")):
            # values about 1e9 that differ by less than 1: a difference of sums of squares would have no digit left
            assert got[k][a] == (None if w[b] is None else pytest.approx(w[b], rel=1e-6)), (k, a)


def test_merging_in_any_order(spark):
    df = _lines(spark, 800)
    p = [period_state(df.where(F.col("period") == f"2024-0{i}"), SPEC) for i in (1, 2, 3, 4)]
    pairs = merge_states(p[3].unionByName(p[0]), SPEC).unionByName(merge_states(p[2].unionByName(p[1]), SPEC))
    a = _by_key(merge_states(pairs, SPEC, ["cat"]), "cat")
    b = _by_key(merge_states(_states(df), SPEC, ["cat"]), "cat")
    assert {k: (r["n_rows"], r["sales"], r["sales_sum"]) for k, r in a.items()} == \
        {k: (r["n_rows"], r["sales"], r["sales_sum"]) for k, r in b.items()}
    assert all(a[k]["sales_m2"] == pytest.approx(b[k]["sales_m2"]) for k in b)
    assert merge_states(p[0], SPEC).dtypes == p[0].dtypes == merge_states(pairs, SPEC).dtypes  # a state is a state again


def test_a_late_extract_costs_its_own_rows(spark, scratch_dir):
    df = _lines(spark, 1200)
    first, late = df.where("period != '2024-03' or sku < 's5'"), df.where("period = '2024-03' and sku >= 's5'")
    for i in (1, 2, 3, 4):
        store_extract(first.where(F.col("period") == f"2024-0{i}"), SPEC, scratch_dir, "sales", f"2024-0{i}")
    before = manifest(spark, scratch_dir)["tables"]["sales"]
    for _ in range(2):  # a run that is repeated counts once
        store_extract(late, SPEC, scratch_dir, "sales", "2024-03", "late")
    after = manifest(spark, scratch_dir)["tables"]["sales"]
    assert len(after) == 5 and all(p in after for p in before)  # no other part was written again
    got = _by_key(merge_states(read_states(spark, scratch_dir, "sales", SPEC), SPEC), "cat", "sku")
    want = _by_key(period_state(df, SPEC), "cat", "sku")
    assert {k: (r["n_rows"], r["sales"]) for k, r in got.items()} == {k: (r["n_rows"], r["sales"]) for k, r in want.items()}
    # a span of periods reads only its parts
    part = read_states(spark, scratch_dir, "sales", SPEC, ["2024-03"])
    plan = part._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 2 and part.count() == len(part.select("cat", "sku", "extract").distinct().collect())


def test_outliers_by_stored_moments(spark):
    df = _lines(spark, 1500, seed=3).where("cat = 'a'").unionByName(
        spark.createDataFrame([("2024-04", "a", "s1", Decimal(10**9), 1.0, "planted")], SCHEMA))
    got = state_outliers(df.where("period = '2024-04'"), _states(df), SPEC, "sales", 3.0, ["cat"])
    assert [r.tag for r in got.collect()] == ["planted"] and got.columns == df.columns


def test_empty_and_wrong_keys(spark):
    none = _lines(spark, 5).where("false")
    assert merge_states(period_state(none, SPEC), SPEC, ["cat"]).count() == 0
    for keys in ([], ["other"]):
        with pytest.raises(ValueError):
            merge_states(period_state(none, SPEC), SPEC, keys)
