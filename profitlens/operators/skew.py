"""Joins of rows with one-row-per-group tables (masters, statistics, pools) that hold when a few keys have most rows.

Such a join sends all rows of a key to one task, and AQE cannot split it where the one-row side is an aggregate on
the key. ``hot_keys`` finds the keys that exceed a task's share with a bounded sketch; ``skew_join`` deals out only
those over several tasks and copies only their one row."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

SKETCHES = 64   # sketches by key hash, so that no single task merges those of all tasks
TOP = 64        # keys that one sketch reports,
TRACKED = 1024  # and those it holds while counting: a key above 0.4 % of its sketch's rows is always found


def key_hash(df: DataFrame, keys: Sequence[str], like: DataFrame | None = None) -> Column:
    """Hash of the keys; of the types they have in ``like``, since equal numbers of other types hash differently."""
    types = (like or df).schema
    return F.xxhash64(*[F.col(f"`{k}`").cast(types[k].dataType) for k in keys])


def hot_keys(rows: DataFrame, *keys: Sequence[str], parts: int | None = None) -> list[Column]:
    """For each list of key columns a column that holds the same map for all rows: hash of a hot key -> number of tasks
    that its rows are dealt to (twice its share of ``parts``, spark.sql.shuffle.partitions unless given).

    Hot is a key with more rows than a partition has on average. The keys are counted by frequent-items sketches
    (``approx_top_k``: mergeable, of bounded size), one pass over the key columns for all lists, so the map has at most
    SKETCHES * TOP entries and nothing grows with the number of keys. It is a scalar subquery: no job runs while a
    report is built."""
    parts = parts or int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    each = F.array(*[F.struct(F.lit(i).alias("i"), key_hash(rows, k).alias("h")) for i, k in enumerate(keys)])
    read = rows.select(F.explode(each).alias("x")).select("x.i", "x.h")
    sketch = (read.groupBy("i", F.pmod("h", F.lit(SKETCHES)).alias("s"))
              .agg(F.expr(f"approx_top_k(h, {TOP}, {TRACKED})").alias("top"), F.count("*").alias("n")))
    merged = sketch.agg(*[F.flatten(F.collect_list(F.when(F.col("i") == i, F.col("top")))).alias(f"t{i}")
                          for i in range(len(keys))], F.sum(F.when(F.col("i") == 0, F.col("n"))).alias("n"))
    n = F.coalesce("n", F.lit(0))

    def tasks(top: str) -> Column:
        hot = F.filter(F.coalesce(F.col(top), F.array()), lambda x: x["count"] * parts > n)
        return F.map_from_entries(F.transform(hot, lambda x: F.struct(
            x["item"].alias("h"), F.least(F.lit(parts), F.ceil(2.0 * parts * x["count"] / n)).cast("int").alias("p"))))

    maps = merged.select(F.array(*[tasks(f"t{i}") for i in range(len(keys))]).alias("m")).scalar()
    return [F.get(maps, F.lit(i)) for i in range(len(keys))]


def tasks_of(df: DataFrame, keys: Sequence[str], hot: Column, like: DataFrame | None = None) -> Column:
    """Number of tasks that the rows of each row's key are dealt to: 1 unless it is hot."""
    return F.coalesce(F.element_at(hot, key_hash(df, keys, like)), F.lit(1))


def skew_join(rows: DataFrame, groups: DataFrame, keys: Sequence[str], how: str = "inner", hot: Column | None = None,
              by: Sequence[str] | None = None) -> DataFrame:
    """``rows`` joined (inner or left) with ``groups``, which has one row for each value of ``keys``.

    ``hot`` comes from ``hot_keys`` (of these rows, unless given). The rows of a hot key are dealt out by the hash of
    the columns ``by`` (all other columns unless given), so a retried task deals them alike, and its row of
    ``groups`` is copied once for each part; every other row keeps one part and one copy. Rows without a key, which match
    nothing, are dealt out in the same way. Nothing is hinted: Spark broadcasts ``groups`` if its bytes allow it."""
    keys = list(keys)
    if hot is None:
        hot = hot_keys(rows, keys)[0]
    plain = [f.name for f in rows.schema.fields if f.name not in keys and not isinstance(f.dataType, (T.MapType, T.VariantType))]
    by = [f"`{c}`" for c in (plain if by is None else by)]
    part = F.pmod(F.xxhash64(*by), tasks_of(rows, keys, hot)).cast("int") if by else F.lit(0)
    copies = groups.withColumn("_part", F.explode(F.sequence(F.lit(0), tasks_of(groups, keys, hot, rows) - 1)))
    return rows.withColumn("_part", part).join(copies, [*keys, "_part"], how).drop("_part")
