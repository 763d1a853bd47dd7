"""Incremental allocation (ALC-05 .. ALC-09): a stored waterfall that a late extract changes only where it has to.

The state of a waterfall is, for each level, its pools, what was allocated and what was left, and the lines at the
finest grain. Levels share a key (e.g. the category); by its hash the state lies in buckets, each a published part of its
own. An update reads and rewrites the buckets of the late rows' shared keys. In them it goes down the levels: touched are
the groups whose lines or pool changed and that have a pool; only these are allocated again, and the difference in what
they leave changes the pools of the next level. All buckets of an update are committed at once."""

from __future__ import annotations

import functools
from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from profitlens.functions.expr import SHARE, UNALLOCATED, WIDE_MONEY
from profitlens.operators.allocate import MIN_BASE, Level, _all_present, _uniq, allocate
from profitlens.operators.skew import skew_join
from profitlens.session import materialize
from profitlens.sources.versions import publish_parts, read_parts

BUCKET = "bucket"


@dataclass(frozen=True)
class StoredWaterfall:
    """What is stored under ``root``/``name``: the levels, weight and amount of ``allocate.waterfall``."""
    root: str
    name: str
    levels: tuple[Level, ...]
    weight: str
    amount: str
    buckets: int = 64
    min_base: float = MIN_BASE

    def __post_init__(self):
        if not self.shared or any(lv.lines is not None for lv in self.levels):
            raise ValueError("levels must share a key and have the waterfall's own lines")

    @property
    def shared(self) -> list[str]:
        return [k for k in self.levels[0].keys if all(k in lv.keys for lv in self.levels)]

    @property
    def columns(self) -> list[str]:
        return _uniq([c for lv in self.levels for c in (*lv.keys, *lv.grain)])

    def bucket(self):
        return F.pmod(F.xxhash64(*self.shared), F.lit(self.buckets)).cast("int").alias(BUCKET)

    def table(self, kind: str, level: int | None = None) -> str:
        return f"{self.name}.{kind}" if level is None else f"{self.name}.{kind}{level}"


def _keyed(df: DataFrame, keys: DataFrame, how: str) -> DataFrame:
    """Semi or anti join of a small table (a row for each group), NULL equal to NULL."""
    own = keys.select(*[F.col(k).alias(f"_k_{k}") for k in keys.columns])
    same = functools.reduce(lambda a, b: a & b, [F.col(k).eqNullSafe(F.col(f"_k_{k}")) for k in keys.columns])
    return df.join(own, same, how)


def _in_scope(df: DataFrame, scope: DataFrame | None, how: str) -> DataFrame:
    keys = [] if scope is None else [c for c in scope.columns if c in df.columns]
    return df if not keys else df.join(scope.select(*keys).distinct(), keys, how)


def _union(*frames: DataFrame | None) -> DataFrame:
    return functools.reduce(lambda a, b: a.unionByName(b), [f for f in frames if f is not None])


def _pools(rows: DataFrame, keys: Sequence[str], amount: str) -> DataFrame:
    """Pool by key: amount and how many rows it is made of (a pool that no row is left of is gone)."""
    return rows.groupBy(*keys).agg(F.coalesce(F.sum(amount), F.lit(0)).cast(WIDE_MONEY).alias(amount),
                                   F.sum("_n").cast("long").alias("_n"))


def update_waterfall(stored: StoredWaterfall, lines: DataFrame, pool: DataFrame, scope: DataFrame | None = None) -> list[int]:
    """Add rows (of the first or of a late extract) to the lines and pools of a stored waterfall; returns the buckets that
    were read and written again (at most ``stored.buckets`` numbers). Afterwards ``read_waterfall`` gives what ``waterfall``
    gives over all rows so far. Corrections are rows with the opposite sign; either side may be empty. ``scope`` must be
    the same in all updates: another one needs a new store. Rows added twice count twice (an update that died before its
    commit has added none), and of two updates at once the later commit wins the buckets of both: run one at a time."""
    spark, w, amt = lines.sparkSession, stored.weight, stored.amount
    fine = sorted(c for c in stored.columns if c in lines.columns)
    late = materialize(lines.groupBy(*fine).agg(F.sum(w).cast(WIDE_MONEY).alias(w)), durable=True)
    change = materialize(_pools(pool.withColumn("_n", F.lit(1)), stored.levels[0].keys, amt), durable=True)
    hit = late.select(stored.bucket()).unionByName(change.select(stored.bucket())).distinct()
    buckets = sorted(r[0] for r in hit.collect())
    if not buckets:
        return []

    def old(kind, level=None):
        return read_parts(spark, stored.root, stored.table(kind, level), BUCKET, buckets)

    now = materialize(_union(old("lines"), late).groupBy(*fine).agg(F.sum(w).cast(WIDE_MONEY).alias(w)), durable=True)
    out = {stored.table("lines"): now}
    for i, lv in enumerate(stored.levels):
        keys = list(lv.keys)
        had = old("pool", i)
        pools = materialize(_pools(_union(had, change), keys, amt), durable=True)
        moved = _union(late.where(_all_present(keys)).select(*keys), change.select(*keys)).distinct()
        touched = materialize(_keyed(pools.select(*keys), moved, "left_semi"), durable=True)
        present = pools.where("_n > 0")
        own = skew_join(now.where(_all_present(keys)), touched, keys)  # lines of untouched groups stay out
        if set(now.columns) == {*keys, *lv.grain, w}:  # several branches read it; coarser levels stage their own sums
            own = materialize(own, durable=True)
        alloc, left = allocate(own, _keyed(present, touched, "left_semi").drop("_n"), keys, w, amt, lv.grain,
                               min_base=stored.min_base, pool_is_rolled_up=True, pre_aggregated=True)
        alloc = alloc.select(*_uniq([*keys, *lv.grain]), "alloc_share", "alloc_amount")
        left = materialize(left.select(*keys, F.col(amt).cast(WIDE_MONEY).alias(amt)), durable=True)
        alloc_had, left_had = old("alloc", i), old("left", i)
        if alloc_had is not None:
            kept = skew_join(alloc_had, touched.withColumn("_touched", F.lit(True)), keys, "left").where("_touched is null")
            alloc = alloc.unionByName(kept.drop("_touched"))
        gone = None if left_had is None else _keyed(left_had, touched, "left_semi")
        out |= {stored.table("pool", i): present, stored.table("alloc", i): alloc,
                stored.table("left", i): _union(left, None if left_had is None else _keyed(left_had, touched, "left_anti"))}
        if i + 1 < len(stored.levels):
            diff = _union(left.withColumn("_n", F.lit(1)),
                          None if gone is None else gone.withColumn(amt, -F.col(amt)).withColumn("_n", F.lit(-1)))
            diff = _in_scope(diff, scope if i == 0 else None, "left_semi")
            change = materialize(_pools(diff, stored.levels[i + 1].keys, amt).where(f"_n != 0 or `{amt}` != 0"), durable=True)
    publish_parts({k: df.withColumn(BUCKET, stored.bucket()) for k, df in out.items()}, stored.root, BUCKET, buckets)
    return buckets


def read_waterfall(spark: SparkSession, stored: StoredWaterfall, scope: DataFrame | None = None,
                   sentinel: str = UNALLOCATED) -> tuple[DataFrame, DataFrame]:
    """(allocated, unallocated) as ``waterfall`` returns them, from the stored state."""
    cols, parts, n = stored.columns, [], len(stored.levels)

    def shaped(df, level):
        return df.select(*[F.col(c) if c in df.columns else F.lit(sentinel).alias(c) for c in cols],
                         "alloc_share", "alloc_amount", F.lit(level).alias("alloc_level"))

    left = None
    for i in range(n):
        alloc = read_parts(spark, stored.root, stored.table("alloc", i), BUCKET)
        left = read_parts(spark, stored.root, stored.table("left", i), BUCKET)
        if alloc is not None:
            parts.append(shaped(alloc, i + 1))
        if i == 0:
            first = left
    if left is not None:
        last = left if n > 1 else _in_scope(left, scope, "left_semi")
        kept = last.select(*stored.levels[-1].keys, F.lit(None).cast(SHARE).alias("alloc_share"),
                           F.col(stored.amount).alias("alloc_amount"))
        parts.append(shaped(kept, n + 1))
    if not parts:
        raise ValueError(f"nothing is stored as {stored.name!r} in {stored.root}")
    none = spark.createDataFrame([], parts[0].select(*stored.levels[0].keys, F.col("alloc_amount").alias(stored.amount)).schema)
    unallocated = none if first is None or scope is None else _in_scope(first, scope, "left_anti")
    return _union(*parts), unallocated
