"""Mergeable period states (AGG-01..12, AGG-15): sums, counts and centred second moments of each extract, stored once
and merged for any span of periods and any coarser grain, so that a late extract costs its own rows only."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profitlens.operators.rollup import _keys_present
from profitlens.operators.skew import skew_join
from profitlens.operators.stats import outside_band
from profitlens.sources.versions import publish_set, read_published


@dataclass(frozen=True)
class StateSpec:
    """Grain of a state, the measures it adds up and those whose mean and deviation it keeps."""
    keys: tuple[str, ...]
    sums: tuple[str, ...]
    moments: tuple[str, ...] = ()

    def columns(self, keys: Sequence[str] | None = None) -> list[str]:
        return [*(self.keys if keys is None else keys), "n_rows", *self.sums,
                *[f"{x}_{part}" for x in self.moments for part in ("n", "sum", "m2")]]


def _added(df: DataFrame, col: str, out: str):
    """Sum that is 0 where nothing is there; money stays exact and keeps one type however often it is merged."""
    t = df.schema[col].dataType
    total = F.coalesce(F.sum(col), F.lit(0))
    return (total.cast(T.DecimalType(38, t.scale)) if isinstance(t, T.DecimalType) else total).alias(out)


def period_state(rows: DataFrame, spec: StateSpec) -> DataFrame:
    """State of some rows: one row for each key with ``n_rows``, the sums under the names of their measures (so a state
    can stand for the lines in any report that adds them up) and, for each moment x, ``x_n``, ``x_sum`` and ``x_m2``
    (sum of squared distances from the mean) of its values that are neither NULL nor NaN. Rows with a NULL key are
    dropped, missing values sum to 0, as in ``rollup``. One shuffle, partial sums in each task."""
    src = rows.where(_keys_present(spec.keys))
    for x in spec.moments:
        v = F.col(x)
        if isinstance(rows.schema[x].dataType, (T.DoubleType, T.FloatType)):
            v = F.when(~F.isnan(v), v)
        src = src.withColumn(f"_v_{x}", v)
    aggs = [F.count("*").alias("n_rows"), *[_added(src, m, m) for m in spec.sums]]
    for x in spec.moments:
        v = f"_v_{x}"
        m2 = F.var_pop(F.col(v).cast("double")) * F.count(v)
        aggs += [F.count(v).alias(f"{x}_n"), _added(src, v, f"{x}_sum"), F.coalesce(m2, F.lit(0.0)).alias(f"{x}_m2")]
    return src.groupBy(*spec.keys).agg(*aggs).select(*spec.columns())


def _mean(total, n):
    return F.try_divide(total.cast("double"), n.cast("double"))


def merge_states(states: DataFrame, spec: StateSpec, keys: Sequence[str] | None = None) -> DataFrame:
    """One state out of many (of periods, extracts or finer keys), of the grain ``keys`` (the states' own unless given).

    A merged state can be merged again: the order and the grouping don't matter, for money not to the last digit. Second
    moments are moved to the common mean, m2 + n * (mean - common mean)^2, which keeps the digits that a difference of
    sums of squares would lose. Only states are read and shuffled; a coarse key with many states is split."""
    keys = list(spec.keys if keys is None else keys)
    if not keys or not set(keys) <= set(spec.keys):
        raise ValueError(f"keys must be some of {spec.keys}")
    m2 = []
    read = states
    if spec.moments:
        means = states.groupBy(*keys).agg(*[_mean(F.sum(f"{x}_sum"), F.sum(f"{x}_n")).alias(f"_mean_{x}")
                                            for x in spec.moments])
        read = skew_join(states, means, keys)
        for x in spec.moments:
            n = F.col(f"{x}_n")
            away = _mean(F.col(f"{x}_sum"), n) - F.col(f"_mean_{x}")
            m2.append(F.sum(F.col(f"{x}_m2") + F.coalesce(n * away * away, F.lit(0.0))).alias(f"{x}_m2"))
    plain = [c for c in spec.columns([]) if not any(c == f"{x}_m2" for x in spec.moments)]
    return read.groupBy(*keys).agg(*[_added(states, c, c) for c in plain], *m2).select(*spec.columns(keys))


def finish_state(state: DataFrame, spec: StateSpec) -> DataFrame:
    """What a state says: sums, ``n_rows`` and, for each moment x, ``x_mean`` and ``x_std`` (of the sample; NULL for
    fewer than two values)."""
    drop = [f"{x}_{part}" for x in spec.moments for part in ("n", "sum", "m2")]
    out = state
    for x in spec.moments:
        n = F.col(f"{x}_n")
        out = out.withColumns({f"{x}_mean": _mean(F.col(f"{x}_sum"), n),
                               f"{x}_std": F.when(n > 1, F.sqrt(F.try_divide(F.col(f"{x}_m2"), (n - 1).cast("double"))))})
    return out.drop(*drop)


def state_outliers(rows: DataFrame, states: DataFrame, spec: StateSpec, col: str, k: float = 6.0,
                   keys: Sequence[str] | None = None) -> DataFrame:
    """Rows outside mean +- k * std of their group in ``states``: a period's rows against all periods' moments, of which
    only the states are read (STA-02 without the history's lines)."""
    keys = list(spec.keys if keys is None else keys)
    s = finish_state(merge_states(states, spec, keys), spec)
    s = s.select(*keys, F.col(f"{col}_mean").alias("_mean"), F.col(f"{col}_std").alias("_std"))
    return skew_join(rows, s, keys).where(outside_band(col, "_mean", "_std", k)).select(*[f"`{c}`" for c in rows.columns])


def store_extract(rows: DataFrame, spec: StateSpec, root: str, name: str, period: str, extract: str = "1") -> int:
    """Store the state of an extract of a period; returns the version. Only its rows are read. The same extract stored
    again replaces itself (a run that is repeated counts once); all others stay as they are."""
    return publish_set({name: period_state(rows, spec)}, root, {"period": period, "extract": extract})


def read_states(spark: SparkSession, root: str, name: str, spec: StateSpec,
                periods: Sequence[str] | None = None) -> DataFrame:
    """The stored states (of some periods), for ``merge_states``; other periods' files are not read."""
    df = read_published(spark, root, name)
    if periods is not None:
        df = df.where(F.col("period").isin(*periods))
    return df.select("period", "extract", *spec.columns())
