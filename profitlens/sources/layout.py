"""Facts stored by their report keys (JN-05, JN-08, PIPE-04, PIPE-05): reports that combine them read each bucket in
place, so no line of any fact is shuffled again.

All facts of a store lie in one table, partitioned by fact and bucketed by the keys, so one scan task holds the same keys
of every fact. A key with more rows than a bucket has on average would fill one bucket alone: its rows are dealt out over
several, in partitions of their own, and only their partial sums meet later."""

from __future__ import annotations

import uuid
from collections.abc import Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profitlens.operators.rollup import _keys_present
from profitlens.operators.skew import hot_keys, tasks_of
from profitlens.sources.versions import DATA, commit_parts, manifest

FACT, DEALT, PART = "_fact", "_dealt", "_part"
OWN = (FACT, DEALT, PART)


def _registered(spark: SparkSession, folder: str, layout: Mapping) -> DataFrame:
    """The stored table as Spark's catalog sees it: that is where a scan learns of the buckets. The name comes from the
    folder, so a folder is registered once in a session."""
    table = f"profitlens_layout_{folder.rsplit('/', 2)[1]}"
    if not spark.catalog.tableExists(table):
        schema = T.StructType.fromJson(layout["schema"])
        by = ", ".join(f"`{k}`" for k in (*layout["keys"], PART))
        cols = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
        spark.sql(f"CREATE TABLE {table} ({cols}) USING parquet PARTITIONED BY ({DEALT}, {FACT}) "
                  f"CLUSTERED BY ({by}) INTO {layout['buckets']} BUCKETS LOCATION '{folder}'")
        spark.sql(f"MSCK REPAIR TABLE {table}")
    return spark.table(table)


def store_by_keys(facts: Mapping[str, DataFrame], keys: Sequence[str], root: str, name: str,
                  buckets: int | None = None, partition: Mapping[str, str] | None = None) -> int:
    """Store ``facts`` (each with the key columns) under ``root`` as the store ``name``; returns the version.

    One shuffle of the lines, paid once for all reports on these keys or finer ones. ``buckets`` is
    spark.sql.shuffle.partitions unless given; a key is hot if it has more rows than a bucket on average. Rows that lack
    a key are kept and dealt out like hot ones: a report on other keys may count them. ``partition`` (a period) names the
    part that is replaced, so a late extract rewrites its period alone. Readers see the old version until all is written.
    Columns of the same name must have the same type in all facts."""
    keys, root = list(keys), root.rstrip("/")
    spark = next(iter(facts.values())).sparkSession
    types: dict[str, T.DataType] = {}
    for tag, df in facts.items():
        for f in df.schema.fields:
            if f.name in OWN:
                raise ValueError(f"{f.name} is a column of the store's own")
            if types.setdefault(f.name, f.dataType) != f.dataType:
                raise ValueError(f"column {f.name} of fact {tag!r} has another type in another fact")
    buckets = buckets or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True),
                  [df.withColumn(FACT, F.lit(tag)) for tag, df in facts.items()])
    hot = hot_keys(rows, keys, parts=buckets)[0]
    rest = [f"`{c}`" for c in types if c not in keys]
    parts = F.when(_keys_present(keys), tasks_of(rows, keys, hot)).otherwise(F.lit(buckets))
    rows = rows.select(
        *[f"`{c}`" for c in types], (F.pmod(F.xxhash64(F.col(FACT), *rest), parts)).cast("int").alias(PART),
        (parts > 1).cast("int").alias(DEALT), FACT)
    folder = f"{DATA}/{uuid.uuid4().hex}/{name}"
    layout = {"keys": keys, "buckets": buckets, "schema": rows.schema.jsonValue()}
    table = f"profitlens_layout_new_{uuid.uuid4().hex}"
    (rows.repartition(buckets, *keys, PART).write.partitionBy(DEALT, FACT).bucketBy(buckets, *keys, PART)
     .option("path", f"{root}/{folder}").format("parquet").saveAsTable(table))
    spark.sql(f"DROP TABLE {table}")  # the entry alone: files of a table with a path of its own stay
    part = dict(partition or {})
    return commit_parts(spark, root, {name: [{"partition": part, "folder": folder, "layout": layout}]}, [part])


def read_stored(spark: SparkSession, root: str, name: str, fact: str) -> DataFrame:
    """All lines of one stored fact, with the columns that the store has; other facts' files are not read."""
    own = [_registered(spark, f"{root.rstrip('/')}/{p['folder']}", p["layout"]) for p in _parts(spark, root, name)]
    return reduce(DataFrame.unionByName, [t.where(F.col(FACT) == fact).drop(*OWN) for t in own])


def _parts(spark: SparkSession, root: str, name: str) -> list[dict]:
    parts = manifest(spark, root.rstrip("/"))["tables"].get(name)
    if not parts:
        raise ValueError(f"{name!r} is not stored in {root}")
    return parts


def combine_stored(spark: SparkSession, root: str, name: str, keys: Sequence[str],
                   measures: Mapping[str, Sequence[str]], keep: str | Sequence[str] = "any") -> DataFrame:
    """``combine`` of stored facts: same rows, same sums, same meaning of ``keep``.

    If ``keys`` hold all keys of the store, the lines of ordinary keys are summed where they lie, without a shuffle; those
    of dealt keys send partial sums. Several parts (periods), or coarser keys, send one row for each key and part.
    Facts that are not asked for are not read."""
    keys, root = list(keys), root.rstrip("/")
    keep_tags = set(measures) if keep == "any" else ({keep} if isinstance(keep, str) else set(keep))
    names = [m for tag in measures for m in measures[tag]]
    if len(set(names)) != len(names):
        raise ValueError("measure names must be unique across facts")
    sums = [F.sum(F.when(F.col(FACT) == tag, F.col(m))).alias(m) for tag in measures for m in measures[tag]]
    kept = F.max(F.col(FACT).isin(*keep_tags).cast("int")).alias("_keep")
    parts = _parts(spark, root, name)
    whole, partial = [], []
    for p in parts:
        stored = p["layout"]["keys"]
        lines = _registered(spark, f"{root}/{p['folder']}", p["layout"])
        lines = lines.where(F.col(FACT).isin(*measures) & _keys_present(keys))
        for dealt in (0, 1):
            own = lines.where(F.col(DEALT) == dealt).groupBy(*dict.fromkeys([*keys, *stored, PART])).agg(*sums, kept)
            at_once = not dealt and len(parts) == 1 and set(stored) <= set(keys)
            (whole if at_once else partial).append(own.select(*keys, *names, "_keep"))
    together = reduce(DataFrame.unionByName, partial)
    types = {m: together.schema[m].dataType for m in names}
    together = together.groupBy(*keys).agg(*[F.sum(m).cast(types[m]).alias(m) for m in names], F.max("_keep").alias("_keep"))
    out = reduce(DataFrame.unionByName, [*whole, together])
    return out.where(F.col("_keep") == 1).select(*keys, *[F.coalesce(m, F.lit(0).cast(types[m])).alias(m) for m in names])
