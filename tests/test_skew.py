"""Joins with one-row-per-group tables while a third of the rows has one key, broadcasts off."""

import contextlib
import tempfile

import pytest
from pyspark.sql import functions as F

from profitlens.operators import skew
from profitlens.operators.allocate import allocate
from profitlens.operators.dims import enrich, enrich_all
from profitlens.operators.stats import quantile_filter, sigma_outliers
from profitlens.plans.abnormal import two_metric_outliers

N = 6000


@contextlib.contextmanager
def no_broadcast(spark, parts=32):
    conf = {"spark.sql.autoBroadcastJoinThreshold": "-1", "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
            "spark.sql.adaptive.coalescePartitions.enabled": "false", "spark.sql.shuffle.partitions": str(parts)}
    before = {k: spark.conf.get(k, None) for k in conf}
    try:
        for k, v in conf.items():
            spark.conf.set(k, v)
        yield
    finally:
        for k, v in before.items():
            spark.conf.unset(k) if v is None else spark.conf.set(k, v)


@pytest.fixture(scope="module")
def rows(spark):
    key = F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("g"), F.col("id") % 500))
    path = tempfile.mkdtemp(prefix="profitlens-case-") + "/rows"
    spark.range(N).select(key.alias("k"), F.col("id"), (F.col("id") % 97).cast("double").alias("v")).write.parquet(path)
    return spark.read.parquet(path)


def tasks_of_hot(df, cond="k = 'hot'"):
    """Rows of the hot key by the task that they lie in after the join."""
    return [r.n for r in df.where(cond).groupBy(F.spark_partition_id()).agg(F.count("*").alias("n")).collect()]


def test_only_hot_keys_are_found(spark, rows):
    with no_broadcast(spark):
        found = spark.range(1).select(skew.hot_keys(rows, ["k"], ["id"])[0].alias("m")).first().m
        want = rows.where("k = 'hot'").select(F.xxhash64("k").alias("h")).first().h
        assert set(found) == {want} and 20 <= found[want] <= 24  # a third of 32 parts, twice
        assert spark.range(1).select(skew.hot_keys(rows, ["k"], ["id"])[1].alias("m")).first().m == {}
        assert spark.range(1).select(skew.hot_keys(rows.limit(0), ["k"])[0].alias("m")).first().m == {}


def test_masters(spark, rows):
    dim = rows.groupBy("k").agg(F.max("id").alias("last"))
    with no_broadcast(spark):
        got = enrich(rows, dim, "k")
        assert got.columns == ["k", "id", "v", "last"]
        parts = tasks_of_hot(got)
        assert len(parts) >= 8 and sum(parts) == N // 3
        assert sorted(map(tuple, got.collect())) == sorted(map(tuple, rows.join(dim, "k", "left").collect()))
        # two masters, one pass for their hot keys; rows without a key stay and are dealt out as well
        some = rows.withColumn("k", F.when(F.col("k") != "hot", F.col("k"))).withColumn("j", F.col("id") % 2)
        other = spark.createDataFrame([(0, "even")], "j int, name string")  # key of another type
        got = enrich_all(some, [(dim, "k"), (other, "j", ["name"])])
        assert len(tasks_of_hot(enrich(some, dim, "k"), "k is null")) >= 8
        assert got.where("k is null and last is null").count() == N // 3
        assert got.where("name = 'even'").count() == N // 2 and got.count() == N


def test_statistics(spark, rows):
    with no_broadcast(spark):
        inside = sigma_outliers(rows, "k", "v", 50.0, keep="inside")
        parts = tasks_of_hot(inside)
        assert len(parts) >= 8 and sum(parts) == N // 3
        top = quantile_filter(rows, "k", "v", 0.0)
        parts = tasks_of_hot(top)
        assert len(parts) >= 8 and sum(parts) == N // 3 and top.count() == N
        work = rows.select(F.col("k").alias("category_id"), F.lit("s").alias("store_id"), F.col("id").alias("sku_id"),
                           F.lit("n").alias("sku_name"), F.when(F.col("id") % 30 == 0, 1e6).otherwise(F.col("v")).alias(
                               "post_coupon_margin"), F.col("v").alias("post_coupon_margin_rate"))
        parts = tasks_of_hot(two_metric_outliers(work, 2.0), "category_id = 'hot'")
        assert len(parts) >= 8 and sum(parts) == N // 30


def test_allocation(spark, rows):
    lines = rows.select("k", F.col("id").cast("string").alias("line"), (F.col("v") + 1).cast("decimal(18,4)").alias("w"))
    pool = spark.createDataFrame([("hot", 1000), ("g1", 50), ("nope", 5)], "k string, amt int").withColumn(
        "amt", F.col("amt").cast("decimal(18,4)"))
    with no_broadcast(spark):
        got, rest = allocate(lines, pool, ["k"], "w", "amt", ["line"])
        parts = tasks_of_hot(got)
        assert len(parts) >= 8 and sum(parts) == N // 3
        sums = {r.k: float(r.s) for r in got.groupBy("k").agg(F.sum("alloc_amount").alias("s")).collect()}
        assert sums == {"hot": 1000.0, "g1": 50.0} and [(r.k, float(r.amt)) for r in rest.collect()] == [("nope", 5.0)]
