"""Per-group statistical filters (STA-01..06, AGG-15, AGG-16)."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from profitlens.operators.skew import hot_keys, skew_join
from profitlens.session import materialize


def _by(by: str | Sequence[str]) -> list[str]:
    return [by] if isinstance(by, str) else list(by)


def group_moments(df: DataFrame, by: str | Sequence[str], col: str) -> DataFrame:
    """Mean and sample standard deviation per group (AGG-15).
    Both are algebraic aggregates: partial per task, merged per group."""
    v = F.col(col).cast("double")
    v = F.when(F.isnan(v), F.lit(None)).otherwise(v)  # NaN -> NULL (S10)
    return df.groupBy(*_by(by)).agg(F.avg(v).alias("_mean"), F.stddev_samp(v).alias("_std"))


def sigma_outliers(df: DataFrame, by: str | Sequence[str], col: str, k: float = 6.0,
                   keep: str = "outside") -> DataFrame:
    """Rows whose ``col`` lies outside (``keep='outside'``, strict) or strictly
    inside (``keep='inside'``) mean ± k·std of their group.

    A one-row group has an undefined std and yields nothing either way, as in
    the reference. NULL/NaN values never qualify. The per-group statistics are
    joined back to the rows (broadcast by AQE when small; otherwise the rows of a
    hot group are dealt out over several tasks).
    """
    keys = _by(by)
    m = group_moments(df, keys, col)
    v = F.col(col).cast("double")
    lo = F.col("_mean") - F.lit(k) * F.col("_std")
    hi = F.col("_mean") + F.lit(k) * F.col("_std")
    if keep == "outside":
        cond = (v > hi) | (v < lo)
    elif keep == "inside":
        cond = (v < hi) & (v > lo)
    else:
        raise ValueError("keep must be 'outside' or 'inside'")
    cond = F.coalesce(cond & ~F.isnan(v), F.lit(False))
    return skew_join(df, m, keys).where(cond).drop("_mean", "_std")


def outside_band(value: str, mean: str, std: str, k: float):
    """Strictly outside mean ± k·std; NULL / NaN never qualify."""
    v = F.col(value).cast("double")
    lo = F.col(mean) - F.lit(k) * F.col(std)
    hi = F.col(mean) + F.lit(k) * F.col(std)
    return F.coalesce(((v > hi) | (v < lo)) & ~F.isnan(v), F.lit(False))


GRID = 128           # quantile estimates that the next bracket of a group is taken from
GRID_ACCURACY = 2048
FEW = 4096           # a group with so few values in its bracket is settled by counting them


def group_quantile(df: DataFrame, by: str | Sequence[str], col: str, q: float = 0.8,
                   exact: bool = True, accuracy: int = 100_000, few: int = FEW) -> DataFrame:
    """Per-group quantile with linear interpolation (AGG-16, pandas' default).

    ``exact=True`` selects the two values around rank (n-1)*q without sorting or
    staging the rows. A bracket of values per group starts as [min, max]; each pass is
    one aggregate with map-side partials: it counts the rows below and inside the
    proposed bracket and takes a grid of quantile estimates inside, from which the next,
    about a fiftieth as wide, is proposed. The counts decide: where an estimate missed,
    the bracket moves to the side that has the rank. Groups with at most ``few`` rows in
    their bracket, or one value, are settled by counting the values in it. Passes grow
    with the logarithm of the largest group; what is written is one row per group.
    ``exact=False`` uses ``percentile_approx`` (one aggregate, rank error 1/accuracy).
    Returns keys + ``_threshold``; NULL / NaN values do not count.
    """
    keys = _by(by)
    v = F.col(col).cast("double")
    v = F.when(F.isnan(v), F.lit(None)).otherwise(v)
    base = df.select(*keys, v.alias("_v")).where(F.col("_v").isNotNull())
    if not exact:
        return base.groupBy(*keys).agg(F.percentile_approx("_v", q, accuracy).alias("_threshold"))

    steps = [i / GRID for i in range(GRID + 1)]
    grid = lambda x: F.percentile_approx(x, steps, GRID_ACCURACY)
    hot = hot_keys(df, keys)[0]
    first = base.groupBy(*keys).agg(F.count("_v").alias("_n"), F.min("_v").alias("_a"), F.max("_v").alias("_b"),
                                    grid(F.col("_v")).alias("_grid"))
    pos = (F.col("_n") - 1).cast("double") * F.lit(q)
    state = materialize(first.select(
        *keys, F.floor(pos).alias("_lo"), F.ceil(pos).alias("_hi"), (pos - F.floor(pos)).alias("_frac"), "_a", "_b",
        F.lit(0).cast("long").alias("_upto"), F.col("_n").alias("_in"), "_grid", (F.col("_n") <= few).alias("_done")),
        durable=True)
    while not state.where("not _done").isEmpty():
        state = materialize(_narrowed(base, state, keys, hot, grid, few), durable=True)

    at = (F.col("_v") >= F.col("_a")) & (F.col("_v") <= F.col("_b"))
    # (group, value) counts: at most ``few`` + 2 different values per group, those below the bracket under NULL
    values = (skew_join(base, state.select(*keys, "_a", "_b"), keys, "inner", hot).where("_v <= _b")
              .groupBy(*keys, F.when(at, F.col("_v")).alias("_v")).agg(F.count("*").alias("_c")))
    upto = F.sum("_c").over(Window.partitionBy(*keys).orderBy(F.col("_v").asc_nulls_first()))
    values = values.withColumn("_upto", upto).join(state.select(*keys, "_lo", "_hi", "_frac"), keys)
    out = values.where("_v is not null").groupBy(*keys).agg(
        F.min(F.when(F.col("_upto") > F.col("_lo"), F.col("_v"))).alias("_x"),
        F.min(F.when(F.col("_upto") > F.col("_hi"), F.col("_v"))).alias("_y"), F.first("_frac").alias("_frac"))
    between = F.col("_x") + (F.col("_y") - F.col("_x")) * F.col("_frac")
    return out.select(*keys, F.when(F.col("_x") == F.col("_y"), F.col("_x")).otherwise(between).alias("_threshold"))


def _narrowed(base: DataFrame, state: DataFrame, keys: list[str], hot, grid, few: int) -> DataFrame:
    """The state after one more pass over the rows of the groups that are not done.

    [_a, _b] holds the values of both ranks and its ends are values of the group; _upto rows are at or below _a, _in lie
    strictly inside, and _grid estimates their quantiles (NULL: not known yet). Ties at an end are not inside, so each
    pass with a grid leaves a small part of what was inside, however many rows share a value."""
    cell = lambda rank, by: F.floor((F.col(rank) - F.col("_upto")) / F.col("_in").cast("double") * GRID).cast("int") + by
    first, last = cell("_lo", -1), cell("_hi", 3)
    asked = state.where("not _done").withColumns({
        "_p": F.when(F.col("_grid").isNull() | (first < 1), F.col("_a")).otherwise(F.get("_grid", first)),
        "_q": F.when(F.col("_grid").isNull() | (last > GRID), F.col("_b")).otherwise(F.get("_grid", last))})
    v, p, q = F.col("_v"), F.col("_p"), F.col("_q")
    inside = (v > p) & (v < q)
    seen = (skew_join(base, asked.select(*keys, "_p", "_q"), keys, "inner", hot).groupBy(*keys)
            .agg(F.count_if(v < p).alias("_under_p"), F.count_if(v <= p).alias("_to_p"), F.count_if(v <= q).alias("_to_q"),
                 F.count_if(inside).alias("_mid"), F.max(F.when(v < p, v)).alias("_below"),
                 F.min(F.when(v > q, v)).alias("_above"), grid(F.when(inside, v)).alias("_g")))
    lo, hi = F.col("_lo"), F.col("_hi")
    # where the two ranks lie: between the proposed ends, to one side, or next to each other across an end
    place = (F.when((lo >= F.col("_under_p")) & (hi < F.col("_to_q")), "in").when(hi < F.col("_under_p"), "left")
             .when(lo >= F.col("_to_q"), "right").when(lo < F.col("_under_p"), "across p").otherwise("across q"))
    s = asked.join(seen, keys).withColumn("_w", place)
    w = F.col("_w")
    a = F.when(w == "in", p).when(w == "right", F.col("_above")).when(w == "across p", F.col("_below")) \
        .when(w == "across q", q).otherwise(F.col("_a"))
    b = F.when(w == "in", q).when(w == "left", F.col("_below")).when(w == "across p", p) \
        .when(w == "across q", F.col("_above")).otherwise(F.col("_b"))
    done = ((w == "in") & (F.col("_mid") <= few)) | w.startswith("across")
    s = s.select(*keys, "_lo", "_hi", "_frac", a.alias("_a"), b.alias("_b"), F.col("_to_p").alias("_upto"),
                 F.col("_mid").alias("_in"), F.when(w == "in", F.col("_g")).alias("_grid"), done.alias("_done"))
    return state.where("_done").unionByName(s)


def quantile_filter(df: DataFrame, by: str | Sequence[str], col: str, q: float = 0.8,
                    exact: bool = True) -> DataFrame:
    """Rows with ``col`` at or above their group's ``q`` quantile (STA-01)."""
    keys = _by(by)
    t = group_quantile(df, keys, col, q, exact)
    return (skew_join(df, t, keys).where(F.col(col).cast("double") >= F.col("_threshold"))
            .drop("_threshold"))
