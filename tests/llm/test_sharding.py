import zlib
from collections import defaultdict

from pyspark.sql import functions as F

from profitlens.llm.sharding import shard_documents
from llm_cases import SF, SF01


def check(df, rows, shards=16):
    size = lambda t: len((t or "").encode()) + 1
    want = sorted(((d, size(t), zlib.crc32((t or "").encode())) for d, t in rows), key=str)
    got = df.collect()
    assert sorted(((r.doc_id, r.size, r.text_crc32) for r in got), key=str) == want
    slots, totals = defaultdict(list), defaultdict(int)
    for r in got:
        assert r.law == "bytes" and r.grown_shard is None and 0 <= r.shard < shards
        slots[r.shard].append(r.slot)
        totals[r.shard] += r.size
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    return [totals[i] for i in range(shards)]


def test_near_equal_bytes(spark):
    docs = spark.read.parquet(f"{SF01}/documents.parquet")
    totals = check(shard_documents(docs), [(r.doc_id, r.text) for r in docs.collect()])
    most = max(len(r.text.encode()) for r in docs.select("text").collect())
    assert max(totals) - min(totals) <= 2 * most + 0.01 * sum(totals)


def test_one_value_and_copies_are_split(spark):
    docs = spark.range(4000).select(F.col("id").alias("doc_id"), F.lit("same text").alias("text"),
                                    F.lit("en").alias("lang"), F.lit("src1").alias("source"))
    totals = check(shard_documents(docs), [(i, "same text") for i in range(4000)])
    assert max(totals) - min(totals) <= 0.02 * sum(totals) / 16 + 20


def test_any_number_of_shards_and_target_bytes(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.collect()]
    totals = check(shard_documents(docs, shards=5), rows, 5)
    assert max(totals) <= 1.3 * sum(totals) / 5
    target = sum(totals) // 7
    assert len({r.shard for r in shard_documents(docs, target_bytes=target).collect()}) in (7, 8)


def test_leaves_follow_the_metadata(spark):
    docs = spark.range(1600).select(F.col("id").alias("doc_id"), F.lit("t" * 10).alias("text"), F.lit("en").alias("lang"),
                                    F.concat(F.lit("s"), F.lpad((F.col("id") % 16).cast("string"), 2, "0")).alias("source"))
    found = shard_documents(docs).join(docs, "doc_id").groupBy("shard").agg(F.countDistinct("source").alias("n")).collect()
    assert all(r.n <= 3 for r in found)


def test_odd_rows(odd, empty):
    check(shard_documents(odd), [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()])
    assert shard_documents(empty).count() == 0
    assert shard_documents(empty, target_bytes=100).count() == 0


def test_sources_with_a_common_beginning_and_a_null_one(spark):
    """The tree splits by source although all names begin alike and one source is null."""
    name = F.concat(F.lit("https://common/crawl/"), F.lpad((F.col("id") % 16).cast("string"), 2, "0"))
    docs = spark.range(1700).select(F.col("id").alias("doc_id"), F.lit("t" * 10).alias("text"), F.lit("en").alias("lang"),
                                    F.when(F.col("id") < 1600, name).alias("source"))
    found = shard_documents(docs).join(docs, "doc_id").groupBy("shard").agg(F.countDistinct("source").alias("n")).collect()
    assert len(found) == 16 and all(r.n <= 3 for r in found)


def test_equal_rows_are_parted(spark):
    """A third of the rows is one row without an id: shards of nearly equal bytes all the same."""
    rows = [(None, "same text " * 20, "en", "s")] * 1000 + [(i, f"text {i} " * (i % 40), "en", f"s{i % 5}") for i in range(2000)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(5)
    got = shard_documents(docs, shards=16).collect()
    sizes, slots = {}, {}
    for r in got:
        sizes[r.shard] = sizes.get(r.shard, 0) + r.size
        slots.setdefault(r.shard, []).append(r.slot)
    assert len(got) == 3000 and len(sizes) == 16
    assert all(sorted(s) == list(range(len(s))) for s in slots.values())
    mean = sum(sizes.values()) / 16
    assert max(sizes.values()) - min(sizes.values()) <= 2 * max(r.size for r in got) + 0.01 * mean
