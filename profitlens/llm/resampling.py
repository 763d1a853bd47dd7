"""Importance resampling towards a target: hashed n-gram features, array-scored weights, and an exact cutoff by weighted
median-of-medians selection."""

from __future__ import annotations

import math
from functools import reduce

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profitlens.llm._common import small_batches, staged
from profitlens.session import drop_staged

BUCKETS = 10_000
LONGEST = 3          # words of the longest feature
MIN_WORDS = 20       # shorter documents are never drawn
PIECE = 1 << 20      # bytes of a text whose words are held at once
PENDING = 1 << 20    # features that are held before they are counted
FINISH = 1 << 16     # so few remaining keys are sorted at once on the driver
# A word of UTF-8 bytes, A-Z already lower-cased: digits, a-z, and every character outside ASCII.
TOKEN = rb"[0-9a-z\x80-\xFF]+"
GAP = rb"[^0-9A-Za-z\x80-\xFF]"


def _features(buckets: int, longest: int):
    """text as bytes -> for each piece of it the number of words and an array of the buckets of its features. Pieces end
    between words; features that reach over an end are counted with the later piece."""
    import re
    from zlib import crc32

    import numpy as np

    token, gap = re.compile(TOKEN), re.compile(GAP)

    def run(data: bytes):
        last = [None] * longest  # by length: the CRC of the feature that ends with the last word so far
        start = 0
        while start < len(data):
            cut = gap.search(data, start + PIECE) if start + PIECE < len(data) else None
            end = cut.start() if cut else len(data)
            words = token.findall(data[start:end].lower())
            start = end
            if not words:
                continue
            spaced = [b" " + w for w in words]
            level, skipped, levels = list(map(crc32, words)), 0, []
            for g in range(longest):
                if g and last[g - 1] is not None:
                    level = list(map(crc32, spaced, [last[g - 1], *level]))
                elif g:
                    skipped += 1
                    level = list(map(crc32, spaced[skipped:], level))
                levels.append(level)
            last = [x[-1] if x else None for x in levels]
            made = np.concatenate([np.fromiter(x, np.int64, len(x)) for x in levels])
            yield len(words), made % buckets

    return run


def bucket_counts(df: DataFrame, text_col: str = "text", buckets: int = BUCKETS, longest: int = LONGEST) -> DataFrame:
    """(bucket, n): features of all texts by bucket. Each task counts into one array; only the arrays are shuffled."""
    small_batches(df.sparkSession)

    def run(batches):
        import numpy as np

        features, counts, held, size = _features(buckets, longest), np.zeros(buckets, np.int64), [], 0
        for batch in batches:
            for data in batch.column(0):
                for _, made in features(data.as_py() or b""):
                    held.append(made)
                    size += len(made)
                    if size > PENDING:
                        counts += np.bincount(np.concatenate(held), minlength=buckets)
                        held, size = [], 0
        if held:
            counts += np.bincount(np.concatenate(held), minlength=buckets)
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["bucket", "n"])

    texts = df.select(F.col(text_col).cast("string").cast("binary").alias("data"))
    return texts.mapInArrow(run, "bucket long, n long").groupBy("bucket").agg(F.sum("n").alias("n"))


def bucket_gains(raw: DataFrame, target: DataFrame, buckets: int = BUCKETS) -> list[int]:
    """For each bucket floor(1000 * ln of the smoothed ratio of its shares of the target and of the raw features). Both
    inputs have at most a row for each bucket, so this is all the driver ever gets."""
    s, t = ({r.bucket: r.n for r in c.collect()} for c in (raw, target))
    total_s, total_t = float(sum(s.values()) + buckets), float(sum(t.values()) + buckets)
    return [math.floor(1000 * math.log((t.get(b, 0) + 1.0) * total_s / ((s.get(b, 0) + 1.0) * total_t)))
            for b in range(buckets)]


def importance_weights(df: DataFrame, id_col: str, text_col: str, gains: list[int], longest: int = LONGEST) -> DataFrame:
    """doc_id, n_words, n_features and weight (sum of the gains of a text's features) of every row."""
    small_batches(df.sparkSession)

    def run(batches):
        import numpy as np

        features, gain = _features(len(gains), longest), np.array(gains, np.int64)
        for batch in batches:
            rows = []
            for data in batch.column(1):
                n = f = w = 0
                for words, made in features(data.as_py() or b""):
                    n, f, w = n + words, f + len(made), w + int(gain[made].sum())
                rows.append((n, f, w))
            cols = [pa.array(c, pa.int64()) for c in (zip(*rows) if rows else [(), (), ()])]
            yield pa.RecordBatch.from_arrays([batch.column(0), *cols], ["doc_id", "n_words", "n_features", "weight"])

    docs = df.select(F.col(id_col).alias("doc_id"), F.col(text_col).cast("string").cast("binary").alias("data"))
    schema = docs.select("doc_id").schema.add("n_words", "long").add("n_features", "long").add("weight", "long")
    return docs.mapInArrow(run, schema)


def gumbel(doc_id, seed: int):
    """Noise of a document: floor(-1000 * ln(-ln(u))), u from the SHA-256 of seed and id. A null id counts as empty."""
    text = F.concat(F.lit(f"{seed}:"), F.coalesce(doc_id.cast("string"), F.lit("")))
    h = F.conv(F.substring(F.sha2(text, 256), 1, 8), 16, 10).cast("double")
    return F.floor(-1000 * F.log(-F.log((h + 0.5) / 4294967296.0)))


# ------------------------------------------------------------------ selection

def _first_half(rows: pa.Table, order: list[tuple[str, str]]) -> pa.Table:
    """The row at which half of the column ``size`` is reached, in the given order; its size becomes the whole."""
    rows = rows.take(pc.sort_indices(rows, sort_keys=order))
    total = pc.sum(rows["size"]).as_py()
    at = pc.index(pc.greater_equal(pc.multiply(pc.cumulative_sum(rows["size"]), 2), total), pa.scalar(True)).as_py()
    return rows.slice(at, 1).set_column(rows.column_names.index("size"), "size", pa.array([total], pa.int64()))


def _partition_medians(order: list[tuple[str, str]]):
    """A partition's rows -> one row: the median of its batches' medians, weighted by their sizes, and all its rows as
    size. Only a batch and the medians of earlier ones are held."""

    def run(batches):
        picks = []
        for batch in batches:
            rows = pa.Table.from_batches([batch])
            if len(rows):
                picks.append(_first_half(rows.append_column("size", pa.array([1] * len(rows), pa.int64())), order))
        if picks:
            yield from _first_half(pa.concat_tables(picks), order).combine_chunks().to_batches()

    return run


def cutoff(keys: DataFrame, order: list[tuple[str, str]], k: int, finish: int = FINISH) -> dict | None:
    """The k-th row of ``keys`` in the given order of all its columns (name, "ascending" or "descending"; nulls last),
    whose rows must all differ; None if k is 0 or there are fewer rows.

    Weighted median of medians: each partition gives the weighted median of its batches' medians, the driver (a row for
    each partition) takes the median of these weighted by the partitions' remaining sizes. At least an eighth of the
    remaining rows lies on either side of it; the side without the k-th row is discarded. Once few rows are left they
    are written anew, so later rounds read only those; ``finish`` rows are sorted at once."""
    names = [c for c, _ in order]
    cur, kept = keys.select(*names), None
    schema = T.StructType([*cur.schema.fields, T.StructField("size", T.LongType())])
    left = cur.count()
    if not 0 < k <= left:
        return None
    size = left  # rows of the table that cur reads
    while left > finish:
        pivots = cur.mapInArrow(_partition_medians(order), schema).toArrow()
        pivot = _first_half(pivots, order).to_pylist()[0]
        below = _before(pivot, order, cur)
        less = cur.where(below).count()
        if k == less + 1:
            break
        if k <= less:
            cur, left = cur.where(below), less
        else:
            at = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(_value(pivot, c, cur)) for c in names])
            cur, left, k = cur.where(~below & ~at), left - less - 1, k - less - 1
        if 4 * left <= size:
            old, kept = kept, staged(cur, "selection")
            cur, size = kept, left
            if old is not None:
                drop_staged(old)
    else:
        rows = cur.toArrow()
        pivot = rows.take(pc.sort_indices(rows, sort_keys=order)).slice(k - 1, 1).to_pylist()[0]
    if kept is not None:
        drop_staged(kept)
    return {c: pivot[c] for c in names}


def _value(row: dict, name: str, like: DataFrame):
    return F.lit(row[name]).cast(like.schema[name].dataType)


def _before(row: dict, order: list[tuple[str, str]], like: DataFrame):
    """Condition: a row of ``like`` comes before the given one (never null). Nulls come last."""
    cond = F.lit(False)
    for name, way in reversed(order):
        c, v = F.col(name), _value(row, name, like)
        if row[name] is None:
            first, same = c.isNotNull(), c.isNull()
        else:
            first, same = F.coalesce((c < v) if way == "ascending" else (c > v), F.lit(False)), c.eqNullSafe(v)
        cond = first | (same & cond)
    return cond


def ranked(winners: DataFrame, order: list[tuple[str, str]]) -> DataFrame:
    """winners with a column rank (1, 2, ... in the given order): a range sort, whose partitions are numbered by adding
    up their sizes. All columns of the order decide a row's partition, so no single value makes one of them large."""
    spark = winners.sparkSession
    by = [F.col(c).asc_nulls_last() if way == "ascending" else F.col(c).desc_nulls_last() for c, way in order]
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = staged(winners.repartitionByRange(parts, *by).sortWithinPartitions(*by)
                  .withColumns({"__part": F.spark_partition_id(), "__at": F.monotonically_increasing_id()}), "winners")
    sizes = rows.groupBy("__part").agg(F.count("*").alias("__n"), F.min("__at").alias("__first"))  # a row a partition
    ahead = F.sum("__n").over(Window.orderBy("__part")) - F.col("__n") - F.col("__first") + 1
    return (rows.join(F.broadcast(sizes.select("__part", ahead.alias("__ahead"))), "__part")
            .withColumn("rank", F.col("__at") + F.col("__ahead")).drop("__part", "__at", "__ahead"))


def resample(docs: DataFrame, target: DataFrame, id_col: str = "doc_id", text_col: str = "text", percent: int = 5,
             seed: int = 42, min_words: int = MIN_WORDS, buckets: int = BUCKETS, longest: int = LONGEST,
             finish: int = FINISH) -> DataFrame:
    """Draw ``percent`` of the documents with at least ``min_words`` words, without replacement, by importance weights
    towards the texts of ``target`` (column ``text_col`` there too).

    Features are runs of 1 to ``longest`` words (A-Z lower-cased; digits, letters and all characters outside ASCII),
    hashed to ``buckets``. A document's weight is the sum of its features' gains (see ``bucket_gains``), its score the
    weight plus seeded Gumbel noise; the floor(percent * N / 100) highest scores are drawn, ties to the smaller id.

    Returns doc_id, n_words, n_features, weight, score and rank (1 for the highest; null for those not drawn) of every
    row. Null and empty texts have no features and weight 0; a null id comes after every other at equal scores; rows
    that share an id are documents of their own, and if they are equal in all these columns any of them comes first.
    An empty table gives no rows, an empty target is one without features. Other columns are not read."""
    gains = bucket_gains(bucket_counts(docs, text_col, buckets, longest),
                         bucket_counts(target, text_col, buckets, longest), buckets)
    found = importance_weights(docs, id_col, text_col, gains, longest)
    # __row tells equal rows apart; it is written with the row, so it stays the same for every reader
    scored = staged(found.withColumn("score", F.col("weight") + gumbel(F.col("doc_id"), seed))
                    .withColumn("__row", F.monotonically_increasing_id()), "resample-scored")
    order = [("score", "descending"), ("doc_id", "ascending"), ("n_words", "ascending"), ("__row", "ascending")]
    able = scored.where(F.col("n_words") >= min_words)
    out = ["doc_id", "n_words", "n_features", "weight", "score"]
    last = cutoff(able, order, percent * able.count() // 100, finish)
    if last is None:
        return scored.select(*out, F.lit(None).cast("long").alias("rank"))
    at = reduce(lambda a, b: a & b, [F.col(c).eqNullSafe(_value(last, c, scored)) for c, _ in order])
    drawn = (F.col("n_words") >= min_words) & (_before(last, order, scored) | at)
    won = ranked(scored.where(drawn), order).select(*out, "rank")
    return won.unionByName(scored.where(~drawn).select(*out, F.lit(None).cast("long").alias("rank")))
