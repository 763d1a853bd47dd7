"""Quality rules: per-document counts and the cross-document frequency of lines on each host."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profitlens.llm._common import WORD, small_batches, staged

SYMBOLS = "#*$%&|<>"
MIN_WORDS = 50        # documents with fewer words fail the base rules
MAX_REPEAT_PCT = 50   # so do those with a larger share of words in repeated 3-word windows
MIN_DOCS = 10         # a line is never frequent on a host unless more documents than this have it,
MAX_SHARE_PCT = 5     # and more than this share of the host's documents
MIN_LEFT_PCT = 50     # a document keeps at least this share of its words without its frequent lines

COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")


def line_key():
    """line -> 64-bit key of the normalised line (lower case, digits as 0, single spaces), None without a word."""
    import re

    import xxhash

    word, digits = re.compile(WORD), re.compile("[0-9]")

    def key(line: str) -> int | None:
        words = word.findall(line)
        if not words:
            return None
        plain = digits.sub("0", " ".join(words).lower())
        value = xxhash.xxh3_64_intdigest(plain)
        return value - (1 << 64) if value >> 63 else value

    return key


def repeated_words(words: list[str]) -> int:
    """Words that lie in a window of three which the list holds twice or more, the first one included."""
    if len(set(zip(words, words[1:], words[2:]))) == max(0, len(words) - 2):
        return 0
    first: dict[tuple, int] = {}
    inside = bytearray(len(words))
    for i, window in enumerate(zip(words, words[1:], words[2:])):
        j = first.setdefault(window, i)
        if j != i:
            inside[i:i + 3] = inside[j:j + 3] = b"\1\1\1"
    return sum(inside)


def document_lines(df: DataFrame, id_col: str, text_col: str, host_col: str, others: tuple[str, ...] = ()) -> DataFrame:
    """A compact row for each document: doc_id, host, the columns ``others``, the base counts, a 128-bit key of the text and its distinct
    normalised lines (64-bit key and words, repeats added up). A null host counts as the empty one, a null text as an
    empty one without lines."""
    small_batches(df.sparkSession)
    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").alias("text"),
                     F.coalesce(F.col(host_col).cast("string"), F.lit("")).alias("host"), *others)
    line_type = T.ArrayType(T.StructType([T.StructField("h", T.LongType()), T.StructField("w", T.IntegerType())]))
    schema = docs.drop("text").schema
    for c in COUNTS:
        schema = schema.add(c, "long")
    schema = schema.add("text_key", "binary").add("lines", line_type)

    def run(batches):
        import re

        import xxhash

        word, key = re.compile(WORD), line_key()
        lines_type = pa.list_(pa.struct([("h", pa.int64()), ("w", pa.int32())]))

        def one(text):
            text = text or ""
            words = word.findall(text)
            lines, seen, dup = {}, set(), 0
            for line in text.split("\n"):
                k = key(line)
                if k is not None:
                    dup += line in seen
                    seen.add(line)
                    lines[k] = lines.get(k, 0) + len(word.findall(line))
            return (len(words), sum(map(len, words)), sum(map(text.count, SYMBOLS)), dup, repeated_words(words),
                    xxhash.xxh3_128_digest(text), [{"h": h, "w": w} for h, w in lines.items()])

        for batch in batches:
            made = [one(t) for t in batch.column(1).to_pylist()]
            cols = [pa.array([m[i] for m in made], pa.int64()) for i in range(5)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), *batch.columns[2:], *cols, pa.array([m[5] for m in made], pa.binary()),
                 pa.array([m[6] for m in made], lines_type)], schema.names)

    return docs.mapInArrow(run, schema)


def frequent_lines(docs: DataFrame, min_docs: int = MIN_DOCS, max_share_pct: int = MAX_SHARE_PCT) -> DataFrame:
    """(host, h) of the lines above the limits, from all rows of ``document_lines``: lines that more than ``min_docs``
    documents of the host have and more than ``max_share_pct`` percent of them.

    Distinct documents are distinct texts: exact copies count once, so a page is not taken for boilerplate because it
    was crawled often. The group keys of the first step are (host, line, text), and counts are pre-aggregated, so a hot
    host or line never meets in one task."""
    texts = docs.select("host", "text_key").distinct().groupBy("host").agg(F.count("*").alias("texts"))
    texts = staged(texts, "quality-hosts")  # read back, it is no aggregate on the join key, so AQE can split a hot host
    lines = docs.select("host", "text_key", F.explode("lines.h").alias("h")).distinct()
    counts = lines.groupBy("host", "h").agg(F.count("*").alias("n")).where(F.col("n") > min_docs)
    return (counts.join(texts, "host").where(F.col("n") * 100 > F.col("texts") * max_share_pct)
            .select("host", "h"))


def line_frequency_rules(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                         min_docs: int = MIN_DOCS, max_share_pct: int = MAX_SHARE_PCT,
                         min_left_pct: int = MIN_LEFT_PCT, others: tuple[str, ...] = ()) -> DataFrame:
    """For every row: doc_id, the base counts, base_failed, removed_words, removed_lines (keys), kept and ``others``.

    kept is false if the base rules fail (under MIN_WORDS words, or over MAX_REPEAT_PCT percent of the words in repeated
    3-word windows), or if the document is depleted: less than ``min_left_pct`` percent of its words are left without
    the lines that are frequent on its host.
    Null or empty text: no words, base_failed. Null hosts count as the empty host. Rows that repeat a doc_id each get
    their own verdict as long as their texts differ, and the same one else. Empty table: no rows. Other columns are
    never read."""
    docs = staged(document_lines(df, id_col, text_col, host_col, others), "quality-lines")
    frequent = staged(frequent_lines(docs, min_docs, max_share_pct), "quality-frequent")
    # every distinct text of a host is looked at once; its copies share the result
    removed = (docs.select("host", "text_key", F.explode("lines").alias("l"))
               .select("host", "text_key", F.col("l.h").alias("h"), F.col("l.w").alias("w"))
               .join(frequent, ["host", "h"]).distinct()
               .groupBy("host", "text_key").agg(F.sum("w").alias("w"), F.collect_list("h").alias("hs")))
    removed = staged(removed, "quality-removed")  # as above: copies of one text may hold a third of the rows
    found = docs.drop("lines").join(removed, ["host", "text_key"], "left")
    base = ((F.col("n_words") < MIN_WORDS)
            | (F.col("n_repeat_words") * 100 > F.col("n_words") * MAX_REPEAT_PCT))
    gone = F.coalesce(F.col("w"), F.lit(0))
    return found.select(
        "doc_id", *COUNTS, base.alias("base_failed"), gone.cast("long").alias("removed_words"),
        F.coalesce("hs", F.array().cast("array<long>")).alias("removed_lines"),
        (~base & ((F.col("n_words") - gone) * 100 >= F.col("n_words") * min_left_pct)).alias("kept"),
        "text_key", *others)


def apply_line_rules(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", host_col: str = "source",
                     **limits) -> DataFrame:
    """The kept documents with all columns of docs; their frequent lines are taken out of the text (the other lines
    stay as they are, in order).

    The documents are written with a number of their own, which brings each its verdict: rows without an id, with a
    repeated one, or equal in all columns are rows like any other, and no value of theirs is a join key."""
    small_batches(docs.sparkSession)
    row = "__row"
    own = staged(docs.withColumn(row, F.monotonically_increasing_id()), "quality-rows")
    verdict = line_frequency_rules(own, id_col, text_col, host_col, others=(row,), **limits)
    kept = verdict.where("kept").select(F.col(row).alias("__own"), F.col("removed_lines").alias("__gone"))
    schema = docs.schema
    at = docs.columns.index(text_col)

    def run(batches):
        key = line_key()
        for batch in batches:
            texts = batch.column(at).to_pylist()
            for i, lines in enumerate(batch.column(batch.num_columns - 1).to_pylist()):
                if lines:
                    drop = set(lines)
                    texts[i] = "\n".join(x for x in texts[i].split("\n") if key(x) not in drop)
            cols = [*batch.columns[:at], pa.array(texts, pa.string()), *batch.columns[at + 1:-1]]
            yield pa.RecordBatch.from_arrays(cols, schema.names)

    joined = own.join(kept, own[row] == kept["__own"]).drop(row, "__own")
    return joined.mapInArrow(run, schema)
