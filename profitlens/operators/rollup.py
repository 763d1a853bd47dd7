"""Rollups, fact combination, control totals and completeness checks."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def _keys_present(keys: Sequence[str]):
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def rollup(df: DataFrame, keys: Sequence[str], measures: Sequence[str],
           drop_null_keys: bool = True) -> DataFrame:
    """Sum ``measures`` by ``keys`` (AGG-01..12).

    * a group whose values are all missing sums to 0, not NULL (S1);
    * rows with a NULL key are dropped, as a pandas group-by does (S2) —
      ``null_key_report`` returns what was dropped.
    Spark adds map-side partial aggregation, so hot keys do not skew the shuffle.
    """
    src = df.where(_keys_present(keys)) if drop_null_keys and keys else df
    aggs = [F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in measures]
    if not keys:
        return src.agg(*aggs)
    return src.groupBy(*keys).agg(*aggs)


def null_key_report(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> DataFrame:
    """Rows and amounts a rollup drops because a key is NULL (one row)."""
    dropped = df.where(~_keys_present(keys))
    return dropped.agg(F.count(F.lit(1)).alias("dropped_rows"),
                       *[F.coalesce(F.sum(m), F.lit(0)).alias(f"dropped_{m}") for m in measures])


def combine(frames: Mapping[str, DataFrame], keys: Sequence[str],
            measures: Mapping[str, Sequence[str]], keep: str | Sequence[str] = "any") -> DataFrame:
    """Outer-join several facts on one key by *tagged union + one group-by* (JN-05, JN-08).

    Equivalent to a chain of full outer joins of the per-fact rollups with the
    measures filled with 0 afterwards, but costs a single shuffle.
    ``keep='any'`` keeps every key (full outer); ``keep=<tag>`` (or a list of
    tags) keeps only keys present in one of those facts (left join with that
    fact as the standard).
    """
    keep_tags = set(frames) if keep == "any" else ({keep} if isinstance(keep, str) else set(keep))
    all_measures = [m for tag in frames for m in measures[tag]]
    if len(set(all_measures)) != len(all_measures):
        raise ValueError("measure names must be unique across facts")
    parts = []
    for tag, df in frames.items():
        sel = [F.col(k) for k in keys] + [F.col(m) for m in measures[tag]]
        sel.append(F.lit(1 if tag in keep_tags else 0).alias("_keep"))
        parts.append(df.where(_keys_present(keys)).select(*sel))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p, allowMissingColumns=True)
    out = u.groupBy(*keys).agg(*[F.coalesce(F.sum(m), F.lit(0)).alias(m) for m in all_measures],
                               F.max("_keep").alias("_keep"))
    if keep_tags != set(frames):
        out = out.where(F.col("_keep") == 1)
    return out.drop("_keep")


def reconcile(pairs: Mapping[str, tuple[DataFrame, str, DataFrame, str]]) -> DataFrame:
    """Control totals (AGG-13): for each metric, total in the raw input and in the
    result, and the difference — as a DataFrame, never printed or collected.

    ``pairs[metric] = (raw_df, raw_col, result_df, result_col)``.
    All inputs go into one tagged union and one group-by on the metric name;
    partial sums per task keep the final merge tiny.
    """
    total = "decimal(38,4)"
    parts = []
    for metric, (raw, raw_c, res, res_c) in pairs.items():
        parts.append(raw.select(F.lit(metric).alias("metric"),
                                F.col(raw_c).cast(total).alias("raw_total"),
                                F.lit(None).cast(total).alias("result_total")))
        parts.append(res.select(F.lit(metric).alias("metric"),
                                F.lit(None).cast(total).alias("raw_total"),
                                F.col(res_c).cast(total).alias("result_total")))
    u = parts[0]
    for p in parts[1:]:
        u = u.unionByName(p)
    out = u.groupBy("metric").agg(
        F.coalesce(F.sum("raw_total"), F.lit(0)).cast(total).alias("raw_total"),
        F.coalesce(F.sum("result_total"), F.lit(0)).cast(total).alias("result_total"))
    return out.withColumn("diff", (F.col("result_total") - F.col("raw_total")).cast(total))


def date_completeness(df: DataFrame, date_col: str) -> DataFrame:
    """Completeness of a dated extract (AGG-14, SRT-01): one row per calendar day
    between the first and last date, in order, with the row count and a
    ``is_missing`` flag.

    The rows are read once, for the daily counts; the calendar is generated from
    those, so its size is the number of days in the range.
    """
    d = df.select(F.to_date(F.col(date_col)).alias("biz_date")).where(F.col("biz_date").isNotNull())
    counts = d.groupBy("biz_date").agg(F.count(F.lit(1)).alias("n_rows"))
    bounds = counts.agg(F.min("biz_date").alias("lo"), F.max("biz_date").alias("hi"))
    calendar = bounds.select(F.explode(F.sequence("lo", "hi", F.expr("interval 1 day"))).alias("biz_date"))
    return (calendar.join(counts, "biz_date", "left")
            .select("biz_date",
                    F.coalesce("n_rows", F.lit(0)).cast("bigint").alias("n_rows"),
                    F.col("n_rows").isNull().alias("is_missing"))
            .orderBy("biz_date"))
