"""Benchmark decontamination: prefix-filtered join of item windows with the documents. DataFrame functions only."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from profitlens.llm._common import staged
from profitlens.session import drop_staged

WINDOW = 10    # words of a window of an item
SHINGLE = 5    # words of the shingles that are joined; windows of fewer words are one shingle
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
# Words after A-Z are lower-cased: runs of digits, a-z and characters outside ASCII.
WORD = r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+"


def words_of(text: Column) -> Column:
    lowered = F.translate(F.coalesce(text.cast("string"), F.lit("")), UPPER, LOWER)
    return F.regexp_extract_all(lowered, F.lit(WORD), F.lit(0))


def _hash(words: list[Column]) -> Column:
    return F.xxhash64(*words)


def _item_windows(benchmark: DataFrame, id_col: str, text_col: str, window: int) -> DataFrame:
    """(item, words): every window of every item, words an array."""
    items = benchmark.select(F.coalesce(F.col(id_col).cast("string"), F.lit("")).alias("item"),
                             words_of(F.col(text_col)).alias("w")).where(F.size("w") > 0)
    items = items.withColumn("n", F.least(F.size("w"), F.lit(window)))
    at = items.select("item", "w", "n", F.explode(F.sequence(F.lit(1), F.size("w") - F.col("n") + 1)).alias("s"))
    return at.select("item", F.slice("w", F.col("s"), F.col("n")).alias("words"))


def _window_shingles(windows: DataFrame, shingle: int) -> DataFrame:
    """(win, wlen, offset, len, shingle, h) of every shingle of every window (win, words)."""
    length = F.least(F.size("words"), F.lit(shingle))
    at = windows.select("win", "words", F.size("words").alias("wlen"), length.alias("len"),
                        F.explode(F.sequence(F.lit(0), F.size("words") - length)).alias("offset"))
    part = at.withColumn("part", F.slice("words", F.col("offset") + 1, F.col("len")))
    h = F.lit(None).cast("long")
    for n in range(1, shingle + 1):
        h = F.when(F.col("len") == n, _hash([F.get("part", F.lit(i)) for i in range(n)])).otherwise(h)
    return part.select("win", "wlen", "offset", "len", F.array_join("part", " ").alias("shingle"), h.alias("h"))


def _document_shingles(docs: DataFrame, id_col: str, text_col: str, lengths: list[int]) -> DataFrame:
    """A row (row, doc_id, n_words, pos, len, h, shingle) for each shingle of the given lengths of each document, and one with
    pos -1 for the document itself. ``row`` numbers the documents: all a document's rows are made together from it."""
    read = docs.select(F.col(id_col).alias("doc_id"), F.monotonically_increasing_id().alias("row"),
                       words_of(F.col(text_col)).alias("w"))
    shifted = [F.concat(F.array(F.lit(None).cast("string")), F.col("w")).alias("w0")]
    shifted += [F.slice("w", F.lit(i), F.size("w")).alias(f"w{i}") for i in range(1, max(lengths, default=1))]
    at = read.select("row", "doc_id", F.size("w").alias("n_words"), F.posexplode(F.arrays_zip(*shifted)).alias("at", "z"))
    at = at.select("row", "doc_id", "n_words", (F.col("at") - 1).alias("pos"), "z.*")
    made = []
    for n in lengths:
        own = [F.col(f"w{i}") for i in range(n)]
        made.append(F.struct(F.lit(n).alias("len"), _hash(own).alias("h"), F.concat_ws(" ", *own).alias("shingle"),
                             (F.col("pos") + n <= F.col("n_words")).alias("whole")))
    head = F.struct(F.lit(0).alias("len"), F.xxhash64("row").alias("h"), F.lit("").alias("shingle"), F.lit(True).alias("whole"))
    if len(made) == 1:
        at = at.select("row", "doc_id", "n_words", "pos", F.when(F.col("pos") < 0, head).otherwise(made[0]).alias("x"))
    else:
        own = F.when(F.col("pos") < 0, F.array(head))
        at = at.select("row", "doc_id", "n_words", "pos", F.explode(own.otherwise(F.array(*made)) if made else own).alias("x"))
    return at.select("row", "doc_id", "n_words", "pos", "x.*").where("whole").drop("whole")


def benchmark_hits(docs: DataFrame, benchmark: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                   item_col: str = "item_id", item_text: str = "text", window: int = WINDOW,
                   shingle: int = SHINGLE) -> DataFrame:
    """Every document with what it shares with the benchmark: doc_id, n_words, n_hit (words inside an occurrence of a
    window), items (sorted ids, as text, of the items with an occurring window) and spans (the hit runs of words,
    an array of (start, end), end excluded).

    A window is ``window`` consecutive words of an item (an item of fewer words is one window). Windows are sets of
    shingles of ``shingle`` words. Document shingles that some item has are found by one join (hash, then the words
    themselves) and written; they give each shingle's number of occurrences. For full containment the prefix of a window
    is its rarest shingle: only this one is joined, its place gives the window's place, which must lie inside the document,
    and the window's first and last shingles (which cover its words) must stand at their places.

    Documents are told apart by a number that is written with the rows found, so ids may be null or repeat and no
    id, text or item is a hot key of the last joins. The tables of the benchmark are written first: Spark broadcasts them
    where their bytes allow it, else AQE can split a hot shingle of the documents. Null and empty texts have no words and no
    hits; a null item id is the empty text; rows of one item id are one item; empty tables give no rows or no hits. Only
    the named columns are read. ``shingle`` must be at least half of ``window``."""
    if 2 * shingle < window:
        raise ValueError("two shingles must cover a window")
    made = _item_windows(benchmark, item_col, item_text, window)
    made = staged(made.withColumn("key", F.array_join("words", " ")).distinct(), "decon-windows")
    wins = staged(made.select("key", "words").distinct().withColumn("win", F.monotonically_increasing_id()), "decon-wins")
    parts = _window_shingles(wins, shingle)
    known = staged(parts.select("len", "shingle", "h").distinct().withColumn("sid", F.monotonically_increasing_id()),
                   "decon-shingles")
    parts = staged(parts.join(known, ["len", "shingle", "h"]).select("win", "wlen", "offset", "len", "sid"), "decon-parts")
    lengths = sorted(r.len for r in known.select("len").distinct().collect())  # at most ``shingle`` values

    rows = _document_shingles(docs, id_col, text_col, lengths)
    k = known.select(F.col("len").alias("k_len"), F.col("h").alias("k_h"), F.col("shingle").alias("k_shingle"), "sid")
    same = (F.col("h") == F.col("k_h")) & (F.col("len") == F.col("k_len")) & (F.col("shingle") == F.col("k_shingle"))
    found = staged(rows.join(k, same, "left").where("pos = -1 or sid is not null")
                   .select("row", "doc_id", "n_words", "pos", "sid"), "decon-found")
    heads, places = found.where("pos = -1"), found.where("pos >= 0").select("row", "n_words", "pos", "sid")

    count = places.groupBy("sid").agg(F.count("*").alias("n"))
    ends = F.struct("offset", "sid")
    prefix = (parts.join(count, "sid", "left").groupBy("win")
              .agg(F.min(F.struct(F.coalesce("n", F.lit(0)).alias("n"), "sid", "offset")).alias("rare"),
                   F.first("wlen").alias("wlen"), F.min(ends).alias("head"), F.max(ends).alias("tail"))
              .where("rare.n > 0")
              .select("win", "wlen", F.col("rare.sid").alias("sid"), F.col("rare.offset").alias("offset"),
                      F.col("head.sid").alias("head_sid"), F.col("tail.sid").alias("tail_sid"),
                      F.col("tail.offset").alias("tail_offset")))
    prefix = staged(prefix, "decon-prefix")
    start = F.col("pos") - F.col("offset")
    likely = (places.join(prefix, "sid").where((start >= 0) & (start + F.col("wlen") <= F.col("n_words")))
              .select("row", start.alias("start"), "win", "wlen", "head_sid", "tail_sid",
                      (start + F.col("tail_offset")).alias("tail")))
    at = lambda place, sid: [F.col("row") == F.col("f_row"), F.col(place) == F.col("f_pos"), F.col(sid) == F.col("f_sid")]
    f = places.select(F.col("row").alias("f_row"), F.col("pos").alias("f_pos"), F.col("sid").alias("f_sid"))
    sure = (likely.join(f, reduce(lambda a, b: a & b, at("start", "head_sid")), "left_semi")
            .join(f, reduce(lambda a, b: a & b, at("tail", "tail_sid")), "left_semi"))
    sure = staged(sure.select("row", "start", "wlen", "win"), "decon-hits")
    for t in (known, parts, prefix):
        drop_staged(t)

    own = Window.partitionBy("row").orderBy("start")  # one document's windows
    spans = sure.groupBy("row", "start").agg((F.col("start") + F.max("wlen")).alias("end"))
    before = F.max("end").over(own.rowsBetween(Window.unboundedPreceding, -1))
    spans = spans.withColumn("fresh", F.coalesce(F.col("start") > before, F.lit(True)).cast("int"))
    spans = (spans.withColumn("run", F.sum("fresh").over(own)).groupBy("row", "run")
             .agg(F.min("start").alias("start"), F.max("end").alias("end")))
    spans = spans.groupBy("row").agg(F.sum(F.col("end") - F.col("start")).alias("n_hit"),
                                     F.sort_array(F.collect_list(F.struct("start", "end"))).alias("spans"))
    items = (sure.select("row", "win").distinct().join(wins.select("win", "key"), "win").join(made.select("key", "item"), "key")
             .groupBy("row").agg(F.array_sort(F.collect_set("item")).alias("items")))
    none = F.array().cast("array<string>")
    return (heads.select("row", "doc_id", F.col("n_words").cast("long").alias("n_words")).join(spans, "row", "left")
            .join(items, "row", "left")
            .select("doc_id", "n_words", F.coalesce("n_hit", F.lit(0)).cast("long").alias("n_hit"),
                    F.coalesce("items", none).alias("items"),
                    F.coalesce("spans", F.array().cast("array<struct<start:int,end:int>>")).alias("spans")))
