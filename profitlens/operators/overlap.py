"""Days that several extracts deliver (PIPE-01, AGG-14): found before a union counts them twice."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from profitlens.operators.skew import skew_join
from profitlens.session import materialize

NEW, PART, AGAIN = "new", "partly repeated", "delivered again"


def _tagged(extracts: Sequence[DataFrame], date_col: str) -> DataFrame:
    """All rows with the number of their extract (from 1), their day ('' for undated rows) and two 64-bit hashes of the
    whole row; columns that an extract lacks are NULL."""
    out = None
    for i, e in enumerate(extracts, 1):
        e = e.withColumn("_extract", F.lit(i))
        out = e if out is None else out.unionByName(e, allowMissingColumns=True)
    # a NULL leaves xxhash64 as it is, so each column's hash input says whether it is there
    cells = [x for c in sorted(out.columns) if c != "_extract" for x in (F.col(f"`{c}`"), F.col(f"`{c}`").isNull())]
    return out.withColumns({"_day": F.coalesce(F.to_date(F.col(date_col)).cast("string"), F.lit("")),
                            "_a": F.xxhash64(*cells), "_b": F.xxhash64(F.lit("second"), *cells)})


def _digests(rows: DataFrame) -> DataFrame:
    wide = lambda c: F.sum(F.col(c).cast("decimal(20,0)")).alias(c)
    return rows.groupBy("_extract", "_day").agg(F.count("*").alias("n_rows"), wide("_a"), wide("_b"))


def extract_digests(extracts: Sequence[DataFrame], date_col: str) -> DataFrame:
    """A digest of the multiset of rows for each extract and day: rows and the sums of two row hashes. It doesn't depend
    on the order of rows or columns, and two parts' digests add up to that of both. Stored beside an extract it tells
    later whether a day has come before, without the earlier rows."""
    d = _digests(_tagged(extracts, date_col))
    return d.select(F.col("_extract").alias("extract"), F.to_date(F.nullif("_day", F.lit(""))).alias("biz_date"), "n_rows",
                    F.col("_a").alias("digest_a"), F.col("_b").alias("digest_b"))


def overlap_report(extracts: Sequence[DataFrame], date_col: str) -> DataFrame:
    """One row for each extract and day it has: ``n_rows``, ``repeated_rows`` and ``status``.

    Repeated are the rows that an extract before it (by position) holds as well, copy by copy: of a row that it has n
    times and an earlier one m times, min(n, m) are repeated (for several earlier ones the largest m). ``delivered
    again``: all rows of the day are repeated. Undated rows are a day of their own (NULL); an empty extract has no row.

    Days are settled by their digests: those of one extract need no more, nor do those whose digest an earlier extract
    shows too. Only rows of the days left over are compared, by their hashes: (hash, extract) counts, of which a row
    value has at most one for each extract. Rows of a hot day are dealt out."""
    rows = _tagged(extracts, date_col)
    days = materialize(_digests(rows), durable=True)
    same = Window.partitionBy("_day", "n_rows", "_a", "_b").orderBy("_extract")  # at most one row for each extract
    days = days.withColumn("_seen", F.row_number().over(same) > 1)
    open_days = (days.groupBy("_day").agg(F.count("*").alias("_of"), F.count_if("_seen").alias("_settled"))
                 .where("_of > 1 and _settled < _of - 1").select("_day"))
    before = Window.partitionBy("_day", "_a", "_b").orderBy("_extract").rowsBetween(Window.unboundedPreceding, -1)
    again = (skew_join(rows.select("_extract", "_day", "_a", "_b"), open_days, ["_day"])
             .groupBy("_day", "_a", "_b", "_extract").agg(F.count("*").alias("_n"))
             .withColumn("_m", F.coalesce(F.max("_n").over(before), F.lit(0)))
             .groupBy("_extract", "_day").agg(F.sum(F.least("_n", "_m")).alias("_again")))
    repeated = F.when(F.col("_seen"), F.col("n_rows")).otherwise(F.coalesce("_again", F.lit(0))).cast("long")
    return (days.join(again, ["_extract", "_day"], "left")
            .select(F.col("_extract").alias("extract"), F.to_date(F.nullif("_day", F.lit(""))).alias("biz_date"), "n_rows",
                    repeated.alias("repeated_rows"))
            .withColumn("status", F.when(F.col("repeated_rows") == 0, NEW)
                        .when(F.col("repeated_rows") < F.col("n_rows"), PART).otherwise(AGAIN)))


def union_once(extracts: Sequence[DataFrame], date_col: str, report: DataFrame | None = None) -> DataFrame:
    """Union by name in which a row counts as often as in the extract that holds it most often, so a day that was
    delivered twice, in whole or in part, counts once. ``report``: that of ``overlap_report``, if it is there already.

    Rows of days without repeats pass as they are. On the others equal rows (all columns) are counted for each extract
    and the largest count is kept; columns must be comparable there (no maps)."""
    rows = _tagged(extracts, date_col).drop("_a", "_b")
    cols = [c for c in rows.columns if c not in ("_extract", "_day")]
    report = overlap_report(extracts, date_col) if report is None else report
    shared = (report.where("repeated_rows > 0").select(F.coalesce(F.col("biz_date").cast("string"), F.lit("")).alias("_day"))
              .distinct().withColumn("_shared", F.lit(True)))
    marked = skew_join(rows, shared, ["_day"], "left")
    names = [f"`{c}`" for c in cols]
    once = (marked.where("_shared").groupBy(*names, "_extract").agg(F.count("*").alias("_n"))
            .groupBy(*names).agg(F.max("_n").alias("_n"))
            .select(*names, F.explode(F.sequence(F.lit(1).cast("long"), F.col("_n"))).alias("_i")).drop("_i"))
    return marked.where("_shared is null").select(*names).unionByName(once)
