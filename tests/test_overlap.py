"""Days delivered twice are found, counted copy by copy, and united once."""

import random
from collections import Counter
from datetime import date, datetime

from pyspark.sql import functions as F

from profitlens.operators.overlap import extract_digests, overlap_report, union_once

SCHEMA = "ts timestamp, k string, v double"


def _df(spark, rows, schema=SCHEMA):
    return spark.createDataFrame(rows, schema)


def _t(day, hour=0):
    return datetime(2024, 1, day, hour)


def _brute(parts):
    """(extract, day) -> (rows, repeated rows), by counters of whole rows."""
    out, before = {}, Counter()
    for i, rows in enumerate(parts, 1):
        mine = Counter(rows)
        for r, n in mine.items():
            key = (i, r[0].date() if r[0] else None)
            a, b = out.get(key, (0, 0))
            out[key] = (a + n, b + min(n, before[r]))
        for r, n in mine.items():
            before[r] = max(before[r], n)
    return out, before


def _report(spark, parts):
    return {(r.extract, r.biz_date): (r.n_rows, r.repeated_rows, r.status)
            for r in overlap_report([_df(spark, p) for p in parts], "ts").collect()}


def test_planted_overlaps(spark):
    a = [(_t(1, h), "x", 1.0) for h in range(5)] + [(_t(2), "x", 1.0)] * 3 + [(None, "u", 1.0), (None, None, None)]
    b = [(_t(2), "x", 1.0)] * 2 + [(_t(3), "x", 1.0), (_t(4), "y", None)]
    c = a[:5] + [(_t(2), "x", 1.0)] * 4 + [(_t(4), None, 1.0), (None, "u", 1.0)]
    got = _report(spark, [a, b, c])
    assert got == {
        (1, date(2024, 1, 1)): (5, 0, "new"), (1, date(2024, 1, 2)): (3, 0, "new"), (1, None): (2, 0, "new"),
        (2, date(2024, 1, 2)): (2, 2, "delivered again"), (2, date(2024, 1, 3)): (1, 0, "new"),
        (2, date(2024, 1, 4)): (1, 0, "new"),
        (3, date(2024, 1, 1)): (5, 5, "delivered again"), (3, date(2024, 1, 2)): (4, 3, "partly repeated"),
        (3, date(2024, 1, 4)): (1, 0, "new"), (3, None): (1, 1, "delivered again")}  # a NULL's place tells rows apart


def test_against_brute_force(spark):
    r = random.Random(7)
    rows = [(_t(r.choice([1, 1, 1, 2, 3])) if r.random() < .9 else None, r.choice(["x", None, ""]),
             r.choice([0.0, 1.0, None])) for _ in range(300)]
    parts = [rows[:150], rows[100:220], rows[:150], [], rows[200:]]
    want, union = _brute(parts)
    got = _report(spark, parts)
    assert {k: v[:2] for k, v in got.items()} == want
    dfs = [_df(spark, p) for p in parts]
    assert Counter(tuple(x) for x in union_once(dfs, "ts").collect()) == union


def test_no_overlap_compares_no_rows(spark):
    a, b = _df(spark, [(_t(1), "x", 1.0)] * 2), _df(spark, [(_t(2), "x", 1.0)])
    assert {r.status for r in overlap_report([a, b], "ts").collect()} == {"new"}
    assert union_once([a, b], "ts").count() == 3  # equal rows of one extract stay


def test_columns_by_name(spark):
    a = _df(spark, [(_t(1), "x", 1.0)])
    b = a.select("v", "ts", "k")  # another order
    c = a.withColumn("_extra", F.lit("new column"))
    assert [r.repeated_rows for r in overlap_report([a, b, c], "ts").orderBy("extract").collect()] == [0, 1, 0]
    out = union_once([a, b, c], "ts")
    assert out.columns == ["ts", "k", "v", "_extra"] and out.count() == 2


def test_digests_do_not_depend_on_order(spark):
    rows = [(_t(1, i % 24), f"k{i}", float(i)) for i in range(200)]
    a, b = _df(spark, rows).repartition(7), _df(spark, rows[::-1]).coalesce(1).select("k", "v", "ts")
    d = {(r.extract, r.n_rows, r.digest_a, r.digest_b) for r in extract_digests([a, b], "ts").collect()}
    assert len(d) == 2 and len({x[1:] for x in d}) == 1
    other = extract_digests([_df(spark, rows[:-1] + [(_t(1), "k", 0.0)])], "ts").first()
    assert (other.digest_a, other.digest_b) not in {x[2:] for x in d}


def test_empty(spark):
    none = _df(spark, [])
    assert overlap_report([none, none], "ts").count() == 0 and union_once([none], "ts").count() == 0
