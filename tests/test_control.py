"""Control totals of the writing job, and the scans that follow where they differ."""

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from profitlens.operators import control
from profitlens.operators.control import write_with_totals
from profitlens.operators.rollup import combine
from profitlens.session import stage

D = Decimal


def _sales(spark):
    return spark.createDataFrame([("a", D("1.5")), ("a", None), ("b", D(2)), (None, D(4))], "k string, net decimal(18,4)")


def _cost(spark):
    return spark.createDataFrame([("b", D(1)), ("c", D(3))], "k string, cost decimal(18,4)")


def _write(df):
    return stage(df, "test-control")


def _lines(totals):
    return {r.metric: tuple(r)[1:] for r in totals.collect()}


def _both(w):
    return combine({"s": w["s"], "c": w["c"]}, ["k"], {"s": ["net"], "c": ["cost"]})


def test_totals_come_from_the_writing_job(spark, monkeypatch):
    def scan(*_):
        raise AssertionError("the plain case scans nothing again")
    monkeypatch.setattr(control, "_recomputed", scan)
    written, totals = write_with_totals({"s": (_sales(spark), ["k"], ["net"]), "c": (_cost(spark), ["k"], ["cost"])},
                                        _both, _write)
    assert sorted(tuple(r) for r in written.collect()) == [("a", D("1.5"), D(0)), ("b", D(2), D(1)), ("c", D(0), D(3))]
    assert _lines(totals) == {"net": (D("7.5"), 1, D(4), D("3.5"), D(0), False), "cost": (D(4), 0, D(0), D(4), D(0), False)}


def test_a_report_that_loses_rows(spark):
    def left(w):
        return combine({"s": w["s"], "c": w["c"]}, ["k"], {"s": ["net"], "c": ["cost"]}, keep="s")
    _, totals = write_with_totals({"s": (_sales(spark), ["k"], ["net"]), "c": (_cost(spark), ["k"], ["cost"])}, left, _write)
    got = _lines(totals)
    assert got["cost"] == (D(4), 0, D(0), D(1), D(-3), True)  # confirmed by a scan
    assert got["net"][4:] == (D(0), False)


def test_metrics_that_count_twice_are_replaced(spark):
    """A fact read by two branches: whatever its metrics say, the reported totals are right."""
    def twice(w):
        n = w["s"].groupBy("k").agg(F.count("*").alias("n"))
        return _both(w).join(n, "k", "left")
    _, totals = write_with_totals({"s": (_sales(spark), ["k"], ["net"]), "c": (_cost(spark), ["k"], ["cost"])}, twice, _write)
    assert {m: v[:5] for m, v in _lines(totals).items()} == {
        "net": (D("7.5"), 1, D(4), D("3.5"), D(0)), "cost": (D(4), 0, D(0), D(4), D(0))}


def test_empty_inputs(spark):
    facts = {"s": (_sales(spark).where("false"), ["k"], ["net"]), "c": (_cost(spark).limit(0), ["k"], ["cost"])}
    written, totals = write_with_totals(facts, _both, _write)
    assert written.count() == 0 and {v[:5] for v in _lines(totals).values()} == {(D(0), 0, D(0), D(0), D(0))}
    with pytest.raises(ValueError):
        write_with_totals({"a": (_sales(spark), ["k"], ["net"]), "b": (_sales(spark), ["k"], ["net"])}, _both, _write)
