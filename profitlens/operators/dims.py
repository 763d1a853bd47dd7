"""Master data: deterministic first-wins masters and star enrichment."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profitlens.operators.skew import hot_keys, skew_join
from profitlens.session import materialize


def first_wins(sources: Sequence[DataFrame], key: str | Sequence[str], attrs: Sequence[str]) -> DataFrame:
    """Master from several sources, first source wins per key (AGG-17, PIPE-03).

    Deterministic replacement for ``drop_duplicates(keep='first')`` (S14):
    the winner is the row with the lowest source priority, then non-NULL
    attributes, then the smallest attribute values. Implemented as a distinct
    (hash aggregate, partial per task) followed by ``min(struct(...))`` per key,
    so a key that appears in a third of all rows does not land whole in one
    task (a ``row_number`` window would).
    """
    keys = [key] if isinstance(key, str) else list(key)
    tagged = None
    for prio, src in enumerate(sources, start=1):
        t = src.select(*keys, *attrs).withColumn("_prio", F.lit(prio))
        tagged = t if tagged is None else tagged.unionByName(t)
    order = [F.col("_prio")]
    for a in attrs:
        order += [F.col(a).isNull().alias(f"_null_{a}"), F.col(a).alias(f"_v_{a}")]
    # distinct (key, source, attributes) first: a hash aggregate with partial
    # combine shrinks the input to a few rows per key before the struct minimum
    best = (tagged.where(F.expr(" AND ".join(f"`{k}` IS NOT NULL" for k in keys))).distinct()
            .groupBy(*keys).agg(F.min(F.struct(*order)).alias("_best")))
    return best.select(*keys, *[F.col(f"_best._v_{a}").alias(a) for a in attrs])


def enrich(fact: DataFrame, dim: DataFrame, on: str | Sequence[str], attrs: Sequence[str] | None = None,
           durable: bool = True) -> DataFrame:
    """Left join a master onto a fact (JN-03). The master must be unique per key
    (build it with ``first_wins``) so the fact is never multiplied."""
    return enrich_all(fact, [(dim, on, attrs)], durable)


def enrich_all(fact: DataFrame, masters: Sequence[tuple], durable: bool = True) -> DataFrame:
    """Left join several masters (master, key, attributes or None for all). Hot keys
    are dealt out over several tasks (``skew_join``); one pass over the fact's key
    columns finds those of every master. The fact is staged, since that pass reads
    it as well: a report of several shuffles is made once (``durable=False``: no job
    runs while the report is built). AQE broadcasts a master when its measured bytes
    allow it."""
    keys = [[on] if isinstance(on, str) else list(on) for _, on, *_ in masters]
    out = fact = materialize(fact, durable=durable)
    for (dim, _, *rest), on, hot in zip(masters, keys, hot_keys(fact, *keys)):
        attrs = (rest[0] if rest else None) or dim.columns
        out = skew_join(out, dim.select(*on, *[a for a in attrs if a not in on]), on, "left", hot, fact.columns)
    return out
