"""S-row semantics on hand-written rows (FIXTURES §3)."""

import math

from pyspark.sql import functions as F

from profitlens.functions.expr import (
    conform_code, conform_numeric_code, matches_any, not_matching, pattern_match, ratio, round_half_even,
)
from profitlens.operators.dims import first_wins
from profitlens.operators.rollup import combine, null_key_report, rollup


def _col(df, c):
    return [r[0] for r in df.select(c).collect()]


def test_zero_division(spark):
    df = spark.createDataFrame([(1, 1.0, 0.0), (2, 0.0, 0.0), (3, 1.0, 2.0), (4, None, 2.0)],
                               "i int, m double, s double").orderBy("i")
    assert _col(df.select(ratio("m", "s").alias("r")), "r") == [0.0, None, 0.5, None]
    assert _col(df.select(ratio("m", "s", fill=0).alias("r")), "r") == [0.0, 0.0, 0.5, 0.0]
    # post-fill rate: the missing margin is filled with 0 first
    assert _col(df.select(ratio(F.coalesce("m", F.lit(0.0)), "s").alias("r")), "r") == [0.0, None, 0.5, 0.0]
    assert _col(df.select(ratio("m", "s", zero_den="null").alias("r")), "r") == [None, None, 0.5, None]


def test_all_missing_group_sums_to_zero(spark):
    df = spark.createDataFrame([("a", None), ("a", None)], "k string, v decimal(18,4)")
    assert [float(r.v) for r in rollup(df, ["k"], ["v"]).collect()] == [0.0]


def test_null_keys_dropped_and_reported(spark):
    df = spark.createDataFrame([("a", 1.0), (None, 2.0), (None, 3.0)], "k string, v double")
    assert rollup(df, ["k"], ["v"]).count() == 1
    rep = null_key_report(df, ["k"], ["v"]).collect()[0]
    assert rep.dropped_rows == 2 and rep.dropped_v == 5.0


def test_padded_codes(spark):
    df = spark.createDataFrame([("001",), (" 002\t",), (None,), ("　x ",)], "c string")
    assert _col(df.select(conform_code("c").alias("c")), "c") == ["001", "002", "__NA__", "x"]


def test_numeric_codes(spark):
    df = spark.createDataFrame([(12.7,), (float("nan"),), (float("inf"),), (None,)], "c double")
    assert _col(df.select(conform_numeric_code("c").alias("c")), "c") == ["12", "0", "0", "0"]


def test_exclusion_filter_keeps_nulls(spark):
    df = spark.createDataFrame([("装卸费",), ("返利",), (None,)], "t string")
    assert sorted(_col(df.where(not_matching("t", "装卸|搬运")), "t"), key=str) == [None, "返利"]
    assert _col(df.where(matches_any("t", "返利")), "t") == ["返利"]


def test_half_even(spark):
    df = spark.createDataFrame([(0.125,), (2.675,), (1.005,), (0.285,)], "x double")
    assert _col(df.select(round_half_even("x", 2).alias("x")), "x") == [0.12, 2.68, 1.0, 0.28]
    dec = spark.createDataFrame([(0.125,), (0.135,)], "x double").select(F.col("x").cast("decimal(18,4)").alias("x"))
    assert _col(dec.select(round_half_even("x", 2).alias("x")), "x") == [0.12, 0.14]


def test_first_wins_master(spark):
    s1 = spark.createDataFrame([("k", "B"), ("j", None)], "id string, name string")
    s2 = spark.createDataFrame([("k", "A"), ("j", "J")], "id string, name string")
    got = {r.id: r.name for r in first_wins([s1, s2], "id", ["name"]).collect()}
    assert got == {"k": "B", "j": None}


def test_pattern_from_column(spark):
    df = spark.createDataFrame([(1, "Foo Shop", "foo"), (2, "Bar", "x"), (3, None, "a")], "i int, n string, k string")
    assert _col(df.orderBy("i").select(pattern_match("n", "k").alias("m")), "m") == [True, False, None]


def test_combine_left_and_full(spark):
    a = spark.createDataFrame([("x", 1.0), ("y", 2.0)], "k string, a double")
    b = spark.createDataFrame([("y", 5.0), ("z", 7.0), ("z", 1.0)], "k string, b double")
    full = {r.k: (r.a, r.b) for r in combine({"a": a, "b": b}, ["k"], {"a": ["a"], "b": ["b"]}).collect()}
    assert full == {"x": (1.0, 0.0), "y": (2.0, 5.0), "z": (0.0, 8.0)}
    left = {r.k for r in combine({"a": a, "b": b}, ["k"], {"a": ["a"], "b": ["b"]}, keep="a").collect()}
    assert left == {"x", "y"}


def test_ratio_never_inf(spark):
    df = spark.createDataFrame([(5.0, 0.0), (-5.0, 0.0)], "n double, d double")
    vals = _col(df.select(ratio("n", "d").alias("r")), "r")
    assert all(v is not None and not math.isinf(v) for v in vals)
