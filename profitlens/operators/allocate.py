"""Pro-rata allocation of pooled amounts over sales lines (ALC-01..09).

Kernel (per group of ``keys``): share = weight / sum(weight) when the group's
base sum(weight) >= ``min_base``; allocated = share * pool.

Plan shape, chosen for scale:

* lines are first pre-aggregated to ``keys + grain`` (sum of line shares equals
  the share of the summed weight, so allocated totals are unchanged) — map-side
  partial aggregation, no hot-key skew. Lines without a grain value keep their
  share; only a missing key leaves a line out;
* those are written once (``materialize``): every level and branch reads them,
  not the lines;
* a group that is not hot (``hot_keys``: it has no more lines than a partition has
  on average) is allocated in one task: its lines are shuffled once, to its pool,
  and windows over the group give base, largest line and rounding remainder. Pools
  and lines allocated so are written as one table;
* the lines of hot groups (e.g. one category) aren't gathered: an aggregate gives
  each its base and largest line, those meet the pools in the same table, and
  ``skew_join`` joins it back, dealing the lines over several tasks;
* the largest line of a group takes what the rounded others leave, so in a hot
  group it comes from the small table and needs no second join with the lines;
* pools that cannot be allocated (no lines, base below ``min_base``, or a
  missing key) are returned as a residual (left anti join) so no money
  disappears. The reference silently loses zero-base pools;
  ``strict_reference=True`` restores that behaviour.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from profitlens.functions.expr import SHARE, UNALLOCATED, WIDE_MONEY
from profitlens.operators.skew import hot_keys, key_hash, skew_join, tasks_of
from profitlens.session import materialize

MIN_BASE = 0.01


def _uniq(cols: Sequence[str]) -> list[str]:
    out: list[str] = []
    for c in cols:
        if c not in out:
            out.append(c)
    return out


def _all_present(keys: Sequence[str]) -> Column:
    cond = F.lit(True)
    for k in keys:
        cond = cond & F.col(k).isNotNull()
    return cond


def pool_rollup(pool: DataFrame, keys: Sequence[str], amount: str) -> DataFrame:
    """Pool amounts summed to the allocation keys (AGG-09). Amounts with a missing
    key are summed as well: they match no line and stay in the residual."""
    return pool.groupBy(*keys).agg(F.coalesce(F.sum(amount), F.lit(0)).cast(WIDE_MONEY).alias(amount))


def allocate(lines: DataFrame, pool: DataFrame, keys: Sequence[str], weight: str,
             amount: str, grain: Sequence[str] = (), min_base: float = MIN_BASE,
             strict_reference: bool = False, pool_is_rolled_up: bool = False,
             pre_aggregated: bool = False, exact: bool = True) -> tuple[DataFrame, DataFrame]:
    """Allocate ``pool[amount]`` over ``lines`` pro rata to ``lines[weight]`` within ``keys``.

    Returns ``(allocated, residual)``:
      allocated: keys + grain, ``weight`` (summed), ``alloc_share`` (DECIMAL(38,12)),
                 ``pool_amount`` and ``alloc_amount`` (money)
      residual:  keys + ``amount`` — pools that were not allocated.
    With ``exact=True`` the per-line amounts (rounded to 1/10000) of every group
    add up exactly to its pool, so allocated + residual = pool to the last digit.
    """
    keys = list(keys)
    cols = _uniq(keys + list(grain))
    pl = pool if pool_is_rolled_up else pool_rollup(pool, keys, amount)

    # Pre-aggregated lines at the output grain (skipped when the caller already
    # aggregated the lines at exactly this grain).
    if pre_aggregated and set(cols) == set(lines.columns) - {weight}:
        lw = lines.where(_all_present(keys)).select(*cols, F.coalesce(F.col(weight), F.lit(0)).alias(weight))
    else:
        lw = materialize(lines.where(_all_present(keys)).groupBy(*cols)
                         .agg(F.coalesce(F.sum(weight), F.lit(0)).alias(weight)), durable=True)
    extra = [c for c in cols if c not in keys]
    hot = hot_keys(lw, keys)[0]
    # base and largest line of each group; ties go to the largest grain values
    base = F.sum(weight)
    top = F.max(F.struct(F.abs(F.col(weight)).alias("_abs"), *extra, F.col(weight).alias("_w")))
    usable = F.coalesce(F.col("_base") >= F.lit(min_base), F.lit(False))
    # strict reference: any pool with lines counts as matched, share 0 when base < min_base
    matched = F.col("_base").isNotNull() if strict_reference else usable
    largest = F.lit(True)
    for c in extra:
        largest = largest & F.col(c).eqNullSafe(F.col(f"_top.{c}"))

    def share(weight_col: Column) -> Column:
        return F.when(usable, F.coalesce(F.try_divide(weight_col.cast("double"), F.col("_base").cast("double")),
                                         F.lit(0.0))).otherwise(F.lit(0.0))

    def amount_of(weight_col: Column) -> Column:
        return (share(weight_col) * F.col(amount).cast("double")).cast(WIDE_MONEY)

    # Pools of hot groups with base and largest line; the other pools with their lines, which have one
    # task's room: the lines are shuffled once, for base, shares and remainder. One table holds both kinds.
    pools = pl.withColumn("_parts", tasks_of(pl, keys, hot, lw))
    hot_base = lw.where(tasks_of(lw, keys, hot) > 1).groupBy(*keys).agg(base.alias("_base"), top.alias("_top"))
    hot_met = pools.where("_parts > 1").join(hot_base, keys, "left")
    own = Window.partitionBy(*keys)
    met = (pools.where("_parts = 1").join(lw.where(tasks_of(lw, keys, hot) == 1), keys, "left")
           .withColumns({"_base": base.over(own), "_top": top.over(own)})
           .withColumn("_first", largest)
           .withColumn("_alloc", amount_of(F.col(weight))))
    if exact:
        others = F.sum(F.when(~F.col("_first"), F.col("_alloc"))).over(own)
        met = met.withColumn("_alloc", F.when(F.col("_first") & usable, F.col(amount) - F.coalesce(others, F.lit(0)))
                             .otherwise(F.col("_alloc")).cast(WIDE_MONEY))
    # of a pool that its group can't take one row is left
    met = met.where(F.coalesce(matched, F.lit(False)) | F.coalesce("_first", F.lit(True)))
    met = met.withColumn("_top", F.when(F.lit(False), F.col("_top")))  # needed no longer
    met = materialize(met.unionByName(hot_met, allowMissingColumns=True), durable=True)

    def shared(rows: DataFrame, weight_col: Column, alloc: Column | None = None) -> DataFrame:
        return rows.select(*cols, weight_col.alias(weight), share(weight_col).cast(SHARE).alias("alloc_share"),
                           F.col(amount).cast(WIDE_MONEY).alias("pool_amount"),
                           (amount_of(weight_col) if alloc is None else alloc.cast(WIDE_MONEY)).alias("alloc_amount"))

    residual = met.where(~matched).select(*keys, amount)
    cold = shared(met.where((F.col("_parts") == 1) & matched), F.col(weight), F.col("_alloc"))
    # the lines of hot groups that have a pool, as the staged table knows them
    ok = met.where((F.col("_parts") > 1) & matched).select(*keys, amount, "_base", "_top", "_parts")
    hot = ok.agg(F.map_from_entries(F.collect_set(F.struct(key_hash(ok, keys, lw).alias("h"), "_parts")))).scalar()
    ok = ok.drop("_parts")
    dealt = skew_join(lw.where(tasks_of(lw, keys, hot) > 1), ok, keys, "inner", hot, extra)
    if not exact:
        return cold.unionByName(shared(dealt, F.col(weight))), residual
    rest = shared(dealt.where(~(usable & largest)), F.col(weight))
    sums = rest.groupBy(*keys).agg(F.sum("alloc_amount").alias("_sum"))
    tops = ok.where(usable).join(sums, keys, "left").select(
        "*", *[F.col(f"_top.{c}").alias(c) for c in extra])
    last = shared(tops, F.col("_top._w"), F.col(amount) - F.coalesce("_sum", F.lit(0)))
    return cold.unionByName(rest).unionByName(last), residual


@dataclass(frozen=True)
class Level:
    """One waterfall level: pool/base ``keys`` and the line columns kept (``grain``).
    ``lines`` overrides the waterfall's lines for this level."""

    keys: tuple[str, ...]
    grain: tuple[str, ...] = ()
    lines: DataFrame | None = field(default=None, compare=False)


def waterfall(lines: DataFrame, pool: DataFrame, levels: Sequence[Level], weight: str,
              amount: str, scope: DataFrame | None = None, min_base: float = MIN_BASE,
              sentinel: str = UNALLOCATED, strict_reference: bool = False
              ) -> tuple[DataFrame, DataFrame]:
    """Multi-level allocation (ALC-05/06/07/09).

    Level 1 allocates the pool at ``levels[0].keys``; what it cannot place is
    filtered by ``scope`` (a DataFrame of allowed key values, joined left-semi)
    and rolled up to the next level's keys, and so on. What the last level
    cannot place is kept whole on a ``sentinel`` member.

    Returns ``(allocated, unallocated)``:
      allocated: every output column (union of level keys and grains),
                 ``alloc_share``, ``alloc_amount``, ``alloc_level`` (1..n, n+1 = kept whole).
                 Columns a level does not know are set to ``sentinel``.
      unallocated: level-1 residual outside ``scope`` (keys of level 1 + amount),
                 reported instead of silently dropped.
    """
    out_cols = _uniq([c for lv in levels for c in list(lv.keys) + list(lv.grain)])
    # One pre-aggregation at the finest grain any level needs, written once; every
    # level re-aggregates this (much smaller) table.
    fine_cols = sorted(c for c in out_cols if c in lines.columns)
    fine = materialize(lines.groupBy(*fine_cols).agg(F.sum(weight).alias(weight)), durable=True)
    pending = pool_rollup(pool, levels[0].keys, amount)
    unallocated = None
    parts = []
    for i, lv in enumerate(levels):
        lines_i = lv.lines if lv.lines is not None else fine
        alloc, resid = allocate(lines_i, pending, lv.keys, weight, amount, lv.grain,
                                min_base=min_base, strict_reference=strict_reference,
                                pool_is_rolled_up=True, pre_aggregated=lv.lines is None)
        parts.append(alloc.select(*[c for c in out_cols if c in alloc.columns],
                                  "alloc_share", "alloc_amount")
                     .withColumn("alloc_level", F.lit(i + 1)))
        if i == 0 and scope is not None:
            scope_keys = [c for c in scope.columns if c in resid.columns]
            unallocated = resid.join(scope.select(*scope_keys).distinct(), scope_keys, "left_anti")
            resid = resid.join(scope.select(*scope_keys).distinct(), scope_keys, "left_semi")
        if i + 1 < len(levels):
            pending = pool_rollup(resid, levels[i + 1].keys, amount)
        else:
            pending = resid
    kept = pending.select(*[c for c in pending.columns if c in out_cols],
                          F.lit(None).cast(SHARE).alias("alloc_share"),
                          F.col(amount).cast(WIDE_MONEY).alias("alloc_amount"),
                          F.lit(len(levels) + 1).alias("alloc_level"))
    parts.append(kept)
    result = None
    for p in parts:
        p = p.select(*[F.col(c) if c in p.columns else F.lit(sentinel).alias(c) for c in out_cols],
                     "alloc_share", "alloc_amount", "alloc_level")
        result = p if result is None else result.unionByName(p)
    if unallocated is None:
        unallocated = pending.limit(0)
    return result, unallocated


def reallocate_single(lines: DataFrame, pool: DataFrame, keys: Sequence[str], weight: str,
                      amount: str, grain: Sequence[str], sentinel: str = UNALLOCATED,
                      residual_share: float | None = None, min_base: float = MIN_BASE,
                      pool_is_rolled_up: bool = False) -> DataFrame:
    """One-level allocation whose residual is kept whole on ``sentinel`` in the
    grain columns (ALC-08, ALC-07 hop 2). ``residual_share`` is the share reported
    on those rows (the fresh hop reports 1). The pool is usually the output of an
    earlier allocation; it is rolled up to ``keys`` (one row per group) unless the
    caller did."""
    if not pool_is_rolled_up:
        pool = pool_rollup(pool, list(keys), amount)
    alloc, resid = allocate(lines, pool, keys, weight, amount, grain, min_base=min_base,
                            pool_is_rolled_up=True)
    out_cols = _uniq(list(keys) + list(grain))
    kept = resid.select(*[F.col(c) if c in resid.columns else F.lit(sentinel).alias(c) for c in out_cols],
                        F.lit(None).cast(WIDE_MONEY).alias(weight),
                        (F.lit(residual_share).cast(SHARE) if residual_share is not None
                         else F.lit(None).cast(SHARE)).alias("alloc_share"),
                        F.col(amount).cast(WIDE_MONEY).alias("pool_amount"),
                        F.col(amount).cast(WIDE_MONEY).alias("alloc_amount"))
    return (alloc.select(*out_cols, F.col(weight).cast(WIDE_MONEY).alias(weight),
                         "alloc_share", "pool_amount", "alloc_amount")
            .unionByName(kept))


def allocate_with_fallback(lines: DataFrame, pool_rows: DataFrame, keys: Sequence[str],
                           weight: str, amount: str, grain: Sequence[str],
                           min_base: float = MIN_BASE) -> DataFrame:
    """ALC-04: allocate a pool over ``grain`` by weight; groups that cannot be
    allocated fall back to the ``grain`` recorded on the pool rows themselves.

    ``pool_rows`` are the raw pool lines (they carry the fallback grain).
    The fallback takes pool rows of unallocated groups through a left-semi join on
    the distinct group keys, so amounts are never multiplied (reference defect).
    Output: keys + grain + ``alloc_amount`` summed.
    """
    alloc, resid = allocate(lines, pool_rows, keys, weight, amount, grain, min_base=min_base)
    left = resid.select(*[F.col(k).alias(f"_r_{k}") for k in keys])
    same = F.lit(True)
    for k in keys:  # pools without a key are in the residual too
        same = same & F.col(k).eqNullSafe(F.col(f"_r_{k}"))
    fallback = (pool_rows.join(left, same, "left_semi")
                .select(*_uniq(list(keys) + list(grain)), F.col(amount).cast(WIDE_MONEY).alias("alloc_amount")))
    both = alloc.select(*_uniq(list(keys) + list(grain)), "alloc_amount").unionByName(fallback)
    return (both.groupBy(*_uniq(list(keys) + list(grain)))
            .agg(F.sum("alloc_amount").cast(WIDE_MONEY).alias("alloc_amount")))


# Fixed values (reference): the numeric / text codes the original scripts stamp
# on allocation rows that have no real member, by allocation variant.
LEGACY_LABELS = {
    "store_sku": {"store_id": "9999", "channel": "XXXX", "supplier_id": "999999", "sku_id": "1"},
    "store_category": {"store_id": "9999", "channel": "XXXX", "supplier_id": "999999"},
    "realloc_sku": {"sku_id": "9999"},
    "chain_sku": {"sku_id": "0", "channel": "XXYY"},
}


def with_legacy_labels(df: DataFrame, labels: dict[str, str], sentinel: str = UNALLOCATED) -> DataFrame:
    """Optional: replace ``sentinel`` with the original scripts' codes per column
    (e.g. ``LEGACY_LABELS['store_sku']``) for reports that must keep those keys.
    Beware that such codes can clash with real codes; ``alloc_level`` still
    tells allocated from kept-whole rows."""
    out = df
    for c, label in labels.items():
        if c in df.columns:
            out = out.withColumn(c, F.when(F.col(c) == sentinel, F.lit(label)).otherwise(F.col(c)))
    return out
