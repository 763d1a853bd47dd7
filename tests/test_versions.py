"""Publishing that readers see whole or not at all; headers from the heads of files."""

import os

import pytest
from pyspark.sql import functions as F

from profitlens.plans.publish import publish_reports_at_once, publish_tables
from profitlens.sources.files import read_raw, replace_table, write_version
from profitlens.sources.headers import catalogue_headers, decode_report, first_line
from profitlens.sources.versions import drop_old_versions, manifest, publish_set, read_published


def _frame(spark, *rows):
    return spark.createDataFrame(list(rows), "k string, v double")


def _dies(spark):
    """A frame whose write fails in the middle: one task has written its rows, another fails."""
    return spark.range(0, 100, 1, 2).select(F.lit("x").alias("k"), F.when(F.col("id") == 99, F.raise_error(F.lit("dead")).cast(
        "double")).otherwise(F.col("id").cast("double")).alias("v"))


def test_a_set_is_published_at_once(spark, scratch_dir):
    a, b = _frame(spark, ("a", 1.0)), _frame(spark, ("b", 2.0))
    assert publish_set({"margin": a, "oi": b}, scratch_dir) == 1
    with pytest.raises(Exception, match="dead"):  # the first report is written whole, the second dies
        publish_set({"margin": _frame(spark, ("new", 9.0)), "oi": _dies(spark)}, scratch_dir)
    assert manifest(spark, scratch_dir)["version"] == 1
    assert [tuple(r) for r in read_published(spark, scratch_dir, "margin").collect()] == [("a", 1.0)]
    assert publish_set({"margin": b}, scratch_dir) == 2
    assert [tuple(r) for r in read_published(spark, scratch_dir, "margin").collect()] == [("b", 2.0)]
    assert [tuple(r) for r in read_published(spark, scratch_dir, "margin", version=1).collect()] == [("a", 1.0)]
    assert [tuple(r) for r in read_published(spark, scratch_dir, "oi").collect()] == [("b", 2.0)]
    with pytest.raises(ValueError):
        read_published(spark, scratch_dir, "other")
    assert drop_old_versions(spark, scratch_dir, keep=1) >= 2  # the first margin and what the dead write left
    assert [tuple(r) for r in read_published(spark, scratch_dir, "oi").collect()] == [("b", 2.0)]


def test_periods_are_replaced_one_by_one(spark, scratch_dir):
    for period, v in (("2024-01", 1.0), ("2024-02", 2.0), ("2024-02", 3.0)):
        publish_reports_at_once({"margin": _frame(spark, ("k", v))}, scratch_dir, "c1", period)
    df = read_published(spark, scratch_dir, "margin")
    assert sorted((r.company, r.period, r.v) for r in df.collect()) == [("c1", "2024-01", 1.0), ("c1", "2024-02", 3.0)]
    plan = df.where("period = '2024-02'")._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("parquet") == 1  # the other period is not read


def test_two_publishers(spark, scratch_dir, monkeypatch):
    """A manifest that another publisher took the number of is made anew from that one."""
    from profitlens.sources import versions

    publish_set({"a": _frame(spark, ("a", 1.0))}, scratch_dir)
    real, calls = versions.manifest, []

    def stale(s, root, version=None):
        found = real(s, root, version)
        calls.append(1)
        if len(calls) == 1:  # another publisher commits between the reading and the writing
            monkeypatch.setattr(versions, "manifest", real)
            publish_set({"b": _frame(spark, ("b", 2.0))}, scratch_dir)
            monkeypatch.setattr(versions, "manifest", stale)
        return found

    monkeypatch.setattr(versions, "manifest", stale)
    assert publish_set({"c": _frame(spark, ("c", 3.0))}, scratch_dir) == 3
    assert sorted(real(spark, scratch_dir)["tables"]) == ["a", "b", "c"]


def test_catalog_table_survives_a_dead_write(spark):
    replace_table(_frame(spark, ("a", 1.0)), "pl_version_t")
    with pytest.raises(Exception, match="dead"):
        replace_table(_dies(spark), "pl_version_t")
    with pytest.raises(Exception, match="dead"):  # the set is swapped only when all are written
        publish_tables({"t": _frame(spark, ("new", 2.0)), "u": _dies(spark)}, "pl_version_")
    assert [tuple(r) for r in spark.table("pl_version_t").collect()] == [("a", 1.0)]
    replace_table(spark.createDataFrame([(1, "x")], "other int, name string"), "pl_version_t")  # other columns
    assert spark.table("pl_version_t").columns == ["other", "name"]
    replace_table(_frame(spark, ("b", 3.0)), "pl_version_t")
    left = [t.name for t in spark.catalog.listTables() if t.name.startswith("pl_version_t__v")]
    assert len(left) == 2  # the present and the one before
    # a table of the plain kind is taken over
    _frame(spark, ("old", 0.0)).write.mode("overwrite").saveAsTable("pl_version_plain")
    replace_table(_frame(spark, ("b", 3.0)), "pl_version_plain")
    assert [tuple(r) for r in spark.table("pl_version_plain").collect()] == [("b", 3.0)]
    assert write_version(_frame(spark), "pl_version_plain").startswith("pl_version_plain__v")


def _write(path, data):
    os.makedirs(os.path.dirname(path), exist_ok=True)
    with open(path, "wb") as f:
        f.write(data)


def test_headers_come_from_the_heads(spark, scratch_dir):
    big = b"h1,h2\n" + b"1,2\n" * 200_000
    _write(f"{scratch_dir}/in/big.csv", big)
    _write(f"{scratch_dir}/in/gbk.csv", "报表\n商品编码,金额\nx,1\n".encode("gbk"))
    _write(f"{scratch_dir}/in/long.csv", b",".join(b"column%d" % i for i in range(9000)) + b"\n")
    _write(f"{scratch_dir}/in/empty.csv", b"")
    folder, kept = f"{scratch_dir}/in", f"{scratch_dir}/catalogue"
    got = {r.file.rsplit("/", 1)[1]: r for r in catalogue_headers(spark, folder, "GBK").collect()}
    assert got["big.csv"].header == ["h1", "h2"] and got["big.csv"].head_bytes < len(big) // 10
    assert len(got["long.csv"].header) == 9000 and "empty.csv" not in got  # no bytes, no file
    assert [r.header for r in catalogue_headers(spark, f"{folder}/gbk.csv", "GBK", 1).collect()] == [["商品编码", "金额"]]
    # a stored catalogue: only the new file is opened
    first = catalogue_headers(spark, folder, "GBK", catalogue=kept)
    assert first.count() == 3
    _write(f"{folder}/new.csv", b"n1\n5\n")
    opened = spark.read.parquet(kept).count()
    again = {r.file.rsplit("/", 1)[1]: r.header for r in catalogue_headers(spark, folder, "GBK", catalogue=kept).collect()}
    assert again["big.csv"] == ["h1", "h2"] and again["new.csv"] == ["n1"] and len(again) == 4
    assert spark.read.parquet(kept).count() == opened + 1
    rows = read_raw(spark, [f"{folder}/big.csv", f"{folder}/new.csv"], catalogue=kept)
    assert rows.columns == ["h1", "h2", "n1"] and rows.count() == 200_001


def test_first_line():
    assert first_line("a,b\r\nc".encode("utf-8-sig"), "utf-8", 0, False) == ["a", "b"]
    assert first_line(b"a,b", "utf-8", 0, False) is None and first_line(b"a,b", "utf-8", 0, True) == ["a", "b"]
    assert first_line(b"\n \nx\n\"a,1\",b\n", "utf-8", 1, False) == ["a,1", "b"]


def test_rows_before_the_header_in_blocks(spark, scratch_dir):
    """Files that are read in several blocks, several in one task: only the first lines of a file go."""
    for n in range(3):
        _write(f"{scratch_dir}/in/{n}.csv", f"report {n}\n\nline 2\nk,v\n".encode() + b"".join(b"%d,%d\n" % (n, i) for i in range(3000)))
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    try:
        for size in ("4096", "128MB"):
            spark.conf.set("spark.sql.files.maxPartitionBytes", size)
            got = read_raw(spark, f"{scratch_dir}/in", skip_rows=2).groupBy("k").agg(
                F.count("*").alias("n"), F.sum("v").cast("long").alias("s")).collect()
            assert sorted(map(tuple, got)) == [(str(n), 3000, 2999 * 1500) for n in range(3)]
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_bytes_that_do_not_decode_are_counted(spark, scratch_dir):
    _write(f"{scratch_dir}/in/good.csv", "商品,金额\n苹果,1\n".encode("gbk"))
    _write(f"{scratch_dir}/in/bad.csv", "商品,金额\n".encode("gbk") + b"\xff\xfe,1\nok,2\n")
    got = {r.file.rsplit("/", 1)[1]: (r.lines, r.bad_lines) for r in decode_report(spark, f"{scratch_dir}/in", "GBK").collect()}
    assert got == {"good.csv": (2, 0), "bad.csv": (3, 1)}
    _write(f"{scratch_dir}/u/good.csv", "商品,�\n".encode())
    _write(f"{scratch_dir}/u/bad.csv", b"a\n\xc3(\n")
    got = {r.file.rsplit("/", 1)[1]: (r.lines, r.bad_lines) for r in decode_report(spark, f"{scratch_dir}/u").collect()}
    assert got == {"good.csv": (1, 0), "bad.csv": (2, 1)}
