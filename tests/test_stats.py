import pytest

from profitlens.operators.stats import group_quantile, quantile_filter, sigma_outliers


def test_one_row_group_is_neither(spark):
    df = spark.createDataFrame([("g", 1.0)], "k string, v double")
    assert sigma_outliers(df, "k", "v", 6, "outside").count() == 0
    assert sigma_outliers(df, "k", "v", 72, "inside").count() == 0


def test_outlier_found(spark):
    rows = [("g", float(i % 3)) for i in range(60)] + [("g", 1000.0), ("h", 5.0), ("h", 6.0)]
    df = spark.createDataFrame(rows, "k string, v double")
    assert [r.v for r in sigma_outliers(df, "k", "v", 6).collect()] == [1000.0]
    assert sigma_outliers(df, "k", "v", 72, "inside").count() == len(rows) - 0


def test_quantile_linear(spark):
    df = spark.createDataFrame([("g", 1.0), ("g", 2.0), ("g", 10.0)], "k string, v double")
    assert abs(group_quantile(df, "k", "v", 0.8).collect()[0]._threshold - 6.8) < 1e-12
    assert [r.v for r in quantile_filter(df, "k", "v", 0.8).collect()] == [10.0]


def test_exact_quantile_matches_numpy_on_a_hot_group(spark):
    import numpy as np

    rng = np.random.default_rng(7)
    hot = [("hot", float(x)) for x in rng.normal(0, 10, 3000).round(2)]   # spans many range partitions
    cold = [(f"g{i % 7}", float(x)) for i, x in enumerate(rng.uniform(0, 5, 200).round(3))]
    df = spark.createDataFrame(hot + cold, "k string, v double")
    got = {r.k: r._threshold for r in group_quantile(df, "k", "v", 0.8).collect()}
    for k in {r[0] for r in hot + cold}:
        vals = [v for g, v in hot + cold if g == k]
        assert abs(got[k] - float(np.percentile(vals, 80))) < 1e-9, k


@pytest.mark.parametrize("q", [0.0, 0.25, 0.8, 1.0])
def test_quantile_by_selection_in_many_passes(spark, q):
    """Few values settle a group, so brackets are narrowed again and again: ties, heavy tails, infinities, a hot
    group, NULL and NaN."""
    import numpy as np

    rng = np.random.default_rng(3)
    rows = [("hot", float(x)) for x in rng.standard_cauchy(4000)]
    rows += [("ties", float(x)) for x in rng.choice([1.0, 1.0, 1.0, 2.0, -0.5], 900)] + [("one", 7.0)] * 300
    rows += [(f"g{i % 5}", float(x)) for i, x in enumerate(rng.lognormal(0, 4, 500))]
    rows += [("two", 1.0), ("two", 2.0), ("inf", float("-inf")), ("inf", 0.0), ("inf", 3.0)] + [("hot", float("nan"))] * 9
    rows += [("hot", None), ("none", None), (None, 1.0)]
    df = spark.createDataFrame(rows, "k string, v double").repartition(5)
    got = {r.k: r._threshold for r in group_quantile(df, "k", "v", q, few=2).collect()}
    values = {k: np.array([v for g, v in rows if g == k and v is not None and v == v]) for k, _ in rows if k}
    assert set(got) - {None} == {k for k, v in values.items() if len(v)}
    for k, v in values.items():
        if len(v):
            lo, hi = np.sort(v)[[int(np.floor((len(v) - 1) * q)), int(np.ceil((len(v) - 1) * q))]]
            want = lo + (hi - lo) * ((len(v) - 1) * q - np.floor((len(v) - 1) * q)) if lo != hi else lo
            assert np.isclose(got[k], want, rtol=1e-12, atol=0, equal_nan=True), k


def test_quantile_neither_sorts_nor_ranges_the_rows(spark):
    df = spark.createDataFrame([("hot", float(i)) for i in range(9000)] + [("g", 1.0)], "k string, v double")
    plan = quantile_filter(df, "k", "v", 0.8)._jdf.queryExecution().toString()
    assert "rangepartitioning" not in plan.lower()
    assert quantile_filter(df, "k", "v", 0.8).count() == 1801


def test_inliers_at_72_sigma_leave_a_row_out(spark):
    from profitlens.operators.stats import sigma_outliers
    rows = [("g", float(i % 2)) for i in range(9000)] + [("g", 1e9)]
    df = spark.createDataFrame(rows, "k string, v double")
    assert sigma_outliers(df, "k", "v", 72.0, keep="inside").count() == 9000
    assert sigma_outliers(df, "k", "v", 72.0, keep="outside").count() == 1

