"""Control totals taken in the job that writes a report (AGG-13)."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from profitlens.operators.rollup import _keys_present, null_key_report, rollup

TOTAL = "decimal(38,4)"
SCHEMA = f"metric string, raw_total {TOTAL}, dropped_rows bigint, dropped_amount {TOTAL}, result_total {TOTAL}, " \
         f"diff {TOTAL}, recomputed boolean"


def _sum(col):
    return F.coalesce(F.sum(F.col(col) if isinstance(col, str) else col), F.lit(0)).cast(TOTAL)


def _dropped(keys: Sequence[str]):
    return ~_keys_present(keys)


def _observed_input(df: DataFrame, keys: Sequence[str], measures: Sequence[str]) -> tuple[DataFrame, Observation]:
    obs = Observation()
    gone = _dropped(keys)
    metrics = [F.count_if(gone).alias("dropped_rows")]
    for m in measures:
        metrics += [_sum(m).alias(f"all_{m}"), _sum(F.when(gone, F.col(m))).alias(f"dropped_{m}")]
    return df.observe(obs, *metrics), obs


def _metrics(obs: Observation) -> dict:
    """The observed metrics; none where Spark found the observed rows to be empty and took them out of the plan."""
    try:
        return obs.get
    except Py4JJavaError as e:  # there is no row to convert
        if e.java_exception.getClass().getSimpleName() != "AssertionError":
            raise
        return {}


def write_with_totals(facts: Mapping[str, tuple[DataFrame, Sequence[str], Sequence[str]]],
                      build: Callable[[Mapping[str, DataFrame]], DataFrame],
                      write: Callable[[DataFrame], DataFrame]) -> tuple[DataFrame, DataFrame]:
    """Write a report and take its control totals on the way, without another scan.

    ``facts[name] = (rows, keys, measures)``: the rows a report is built from, the keys it
    rolls them up by and the measures that must come out again under their own names.
    ``build(rows by name)`` makes the report; ``write(report)`` writes it and returns it as
    read back. Returns (that, totals): for each measure the total of the input, rows and amount
    dropped for a NULL key, the total of the report and the difference, which is 0 for a
    report that keeps all keys (dropped amounts are no difference).

    The totals are ``DataFrame.observe`` metrics of the writing job itself. A stage that is run
    again after a lost executor adds to its metrics twice, a fact read by two branches counts
    twice, and an input that is found empty may report nothing; so a measure whose totals
    differ, or are missing, is summed again from the rows and the written report before it is
    reported (``recomputed``). In the plain case nothing is read twice.
    """
    names = [m for _, _, ms in facts.values() for m in ms]
    if len(set(names)) != len(names):
        raise ValueError("measure names must be unique across facts")
    watched, seen = {}, {}
    for name, (rows, keys, measures) in facts.items():
        watched[name], seen[name] = _observed_input(rows, keys, measures)
    out = Observation()
    written = write(build(watched).observe(out, *[_sum(m).alias(m) for m in names]))
    result = _metrics(out)
    lines = []
    for name, (rows, keys, measures) in facts.items():
        raw = _metrics(seen[name])
        for m in measures:
            line = None
            if raw and result:
                line = _line(m, raw[f"all_{m}"], raw["dropped_rows"], raw[f"dropped_{m}"], result[m], False)
            if line is None or line[5] != 0:
                line = _recomputed(rows, keys, m, written)
            lines.append(line)
    return written, written.sparkSession.createDataFrame(lines, SCHEMA)


def _line(metric, total, dropped_rows, dropped_amount, result, recomputed):
    return metric, total, dropped_rows, dropped_amount, result, result - (total - dropped_amount), recomputed


def _recomputed(rows: DataFrame, keys: Sequence[str], measure: str, written: DataFrame):
    """The same line by scans of the rows and of the written report: three sums of one row each."""
    total = rollup(rows, [], [measure]).first()[measure]
    gone = null_key_report(rows, keys, [measure]).first()
    result = rollup(written, [], [measure]).first()[measure]
    return (*rows.sparkSession.createDataFrame(
        [(measure, total, gone.dropped_rows, gone[f"dropped_{measure}"], result)],
        f"metric string, t {TOTAL}, n bigint, d {TOTAL}, r {TOTAL}")
        .select("metric", "t", "n", "d", "r", (F.col("r") - (F.col("t") - F.col("d"))).cast(TOTAL)).first(), True)
