"""Ranked lexical search: integer impact vectors in buckets of similar length, pruned by Cauchy-Schwarz and by coordinates."""

from __future__ import annotations

import math
from functools import reduce
from itertools import repeat

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from profitlens.llm._common import small_batches, staged
from profitlens.llm.resampling import GAP, TOKEN
from profitlens.session import drop_staged

BUCKET = 8192            # vectors of a bucket
BLOCK_TERMS = 1 << 19    # about so many (item, term) pairs are searched at once
FOCUS_REST = 0.25        # the focus of an item leaves at most this share of its length to the other coordinates
PIECE = 1 << 20          # bytes of a text whose words are held at once
TERM = r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+"
UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"


def item_terms(items: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """(item_id, term, tf): the terms of every item; rows of one id are one item."""
    words = F.regexp_extract_all(F.translate(F.col(text_col).cast("string"), UPPER, LOWER), F.lit(TERM), F.lit(0))
    return items.select(F.col(id_col).alias("item_id"), F.explode(words).alias("term")).groupBy("item_id", "term").agg(
        F.count("*").alias("tf"))


def term_vectors(docs: DataFrame, id_col: str, text_col: str, vocabulary: list[str]) -> DataFrame:
    """doc_id, n (terms with repeats, of any kind) and, for the terms of the vocabulary, tids and tfs of every document
    with a term; row numbers the documents."""
    small_batches(docs.sparkSession)

    def run(batches):
        import re

        import numpy as np

        token, gap = re.compile(TOKEN), re.compile(GAP)
        known, size = {w.encode(): i for i, w in enumerate(vocabulary)}, max(1, len(vocabulary))

        def pieces(data):
            start = 0
            while start < len(data):
                cut = gap.search(data, start + PIECE) if start + PIECE < len(data) else None
                end = cut.start() if cut else len(data)
                yield token.findall(data[start:end].lower())
                start = end

        for batch in batches:
            n, keys, counts = [], [], []
            for at, data in enumerate(batch.column(2)):
                n.append(0)
                for words in pieces(data.as_py() or b""):
                    n[at] += len(words)
                    tids = np.fromiter(map(known.get, words, repeat(-1)), np.int64, len(words))
                    tids, tfs = np.unique(tids[tids >= 0], return_counts=True)
                    keys.append(at * size + tids)
                    counts.append(tfs)
            keys, counts = (np.concatenate(x) if x else np.zeros(0, np.int64) for x in (keys, counts))
            keys, back = np.unique(keys, return_inverse=True)  # pieces of one text share terms
            tfs = np.zeros(len(keys), np.int64)
            np.add.at(tfs, back, counts)
            ends = np.cumsum(np.bincount(keys // size, minlength=len(n)))
            offsets = pa.array(np.concatenate([[0], ends]).astype(np.int32))
            lists = [pa.ListArray.from_arrays(offsets, pa.array(x.astype(np.int32))) for x in (keys % size, tfs)]
            made = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(n, pa.int64()), *lists], names)
            yield made.filter(pc.greater(made.column(2), 0))

    read = docs.select(F.monotonically_increasing_id().alias("row"), F.col(id_col).alias("doc_id"),
                       F.col(text_col).cast("string").cast("binary").alias("data"))
    names = ["row", "doc_id", "n", "tids", "tfs"]
    schema = T.StructType([*read.schema.fields[:2], T.StructField("n", T.LongType()),
                           T.StructField("tids", T.ArrayType(T.IntegerType())),
                           T.StructField("tfs", T.ArrayType(T.IntegerType()))])
    return read.mapInArrow(run, schema)


def impact_vectors(vectors: DataFrame, documents: int, terms: int) -> DataFrame:
    """row, doc_id, tids, imps (a term's impact (10^9 tf) div (1000 tf + 8 m), m = 25 + (75 n N) div L) and norm, their
    length; vectors without a coordinate go."""

    def run(batches):
        import numpy as np

        for batch in batches:
            m = np.array([25 + 75 * n * documents // terms for n in batch.column(2).to_pylist()], np.int64)
            sizes = batch.column(3).value_lengths().to_numpy()
            tf = batch.column(4).flatten().to_numpy().astype(np.int64)
            doc = np.repeat(np.arange(len(sizes)), sizes)
            imps = 10**9 * tf // (1000 * tf + 8 * m[doc])
            norm = np.sqrt(np.bincount(doc, imps.astype(float) ** 2, len(sizes)))
            offsets = pa.array(np.concatenate([[0], np.cumsum(sizes)]).astype(np.int32))
            own = [pa.ListArray.from_arrays(offsets, x) for x in (batch.column(3).flatten(), pa.array(imps.astype(np.int32)))]
            made = pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), *own, pa.array(norm)],
                                              ["row", "doc_id", "tids", "imps", "norm"])
            yield made.filter(pc.greater(made.column(4), 0))

    schema = T.StructType([*vectors.schema.fields[:2], T.StructField("tids", T.ArrayType(T.IntegerType())),
                           T.StructField("imps", T.ArrayType(T.IntegerType())), T.StructField("norm", T.DoubleType())])
    return vectors.mapInArrow(run, schema)


def document_frequencies(vectors: DataFrame) -> DataFrame:
    """(tid, df): how many vectors have each coordinate. Counted into one array by each task."""

    def run(batches):
        import numpy as np

        counts = np.zeros(0, np.int64)
        for batch in batches:
            own = np.bincount(batch.column(0).flatten().to_numpy(), minlength=len(counts))
            own[:len(counts)] += counts
            counts = own
        used = np.flatnonzero(counts)
        yield pa.RecordBatch.from_arrays([pa.array(used), pa.array(counts[used])], ["tid", "df"])

    return vectors.select("tids").mapInArrow(run, "tid long, df long").groupBy("tid").agg(F.sum("df").alias("df"))


def _searched(queries: list[tuple[list[int], list[int]]], floors: list[int], k: int, bucket: int):
    """Impact vectors, longest first -> for each query (its term ids and integer weights) the k best of the partition
    with a score of at least its floor: (query, doc_id, score, row).

    A bucket is skipped for a query if the product of the lengths is below the floor. Inside, the query's largest
    coordinates (its focus) are summed by lists of the bucket's coordinates, and a document stays if this sum and the
    Cauchy-Schwarz bound of the other coordinates reach the floor. Those are scored exactly, in integers, from their own
    vectors. The floor rises to the k-th best score found. Negative weights only lower a score: bounds leave them out."""

    def run(batches):
        import numpy as np

        plans = []
        for tids, weights in queries:
            order = np.argsort(weights)[::-1]
            tids, q = np.array(tids, np.int64)[order], np.array(weights, np.int64)[order]
            rest = np.sqrt(np.append(np.cumsum((np.maximum(q, 0).astype(float) ** 2)[::-1])[::-1], 0))  # from i on
            focus = int(np.argmax(rest <= FOCUS_REST * rest[0]))
            plans.append((tids, q, rest[0], rest[focus], focus))
        floor = np.array([max(1, f) for f in floors], np.int64)
        best = [None] * len(queries)
        size = 1 + max((int(p[0].max()) for p in plans if len(p[0])), default=0)
        dense = np.zeros(size, np.int64)

        def search(rows: pa.Table):
            sizes = pc.list_value_length(rows["tids"]).to_numpy()
            starts = np.concatenate([[0], np.cumsum(sizes)])
            tids = pc.list_flatten(rows["tids"]).to_numpy().astype(np.int64)
            imps = pc.list_flatten(rows["imps"]).to_numpy().astype(np.int64)
            norm = rows["norm"].to_numpy()
            place = np.argsort(tids, kind="stable")  # the bucket's coordinates, term by term
            owner = np.repeat(np.arange(len(sizes)), sizes)[place]
            listed, first = imps[place], np.searchsorted(tids[place], np.arange(size + 1))
            longest = norm.max()
            for at, (own, q, length, rest, focus) in enumerate(plans):
                if not length * longest * (1 + 1e-9) >= floor[at]:
                    continue
                part, squares = np.zeros(len(sizes), np.int64), np.zeros(len(sizes), np.int64)
                for t, w in zip(own[:focus], q[:focus]):
                    docs, values = owner[first[t]:first[t + 1]], listed[first[t]:first[t + 1]]
                    part[docs] += w * values
                    squares[docs] += values * values
                bound = part + rest * np.sqrt(np.maximum(norm * norm * (1 + 1e-12) - squares, 0))
                likely = np.flatnonzero(bound * (1 + 1e-9) >= floor[at])
                if not len(likely):
                    continue
                dense[own] = q
                counts = sizes[likely]
                cells = np.arange(counts.sum()) + np.repeat(starts[likely] - np.cumsum(counts) + counts, counts)
                score = np.add.reduceat(dense[tids[cells]] * imps[cells], np.cumsum(counts) - counts)
                dense[own] = 0
                good = score >= floor[at]
                if good.any():
                    add(at, likely[good], score[good], rows)

        def add(at, chosen, score, rows):
            if len(score) > k:  # equal scores stay: ids decide among them
                high = score >= np.partition(score, -k)[-k]
                chosen, score = chosen[high], score[high]
            taken = rows.select(["doc_id", "row"]).take(pa.array(chosen)).append_column("score", pa.array(score))
            found = taken if best[at] is None else pa.concat_tables([best[at], taken])
            order = [("score", "descending"), ("doc_id", "ascending"), ("row", "ascending")]
            best[at] = found.take(pc.sort_indices(found, sort_keys=order).slice(0, k)).combine_chunks()
            if len(best[at]) == k:
                floor[at] = max(floor[at], best[at]["score"][k - 1].as_py())

        held, size_held = [], 0
        for batch in batches:
            for part in (batch.slice(i, bucket) for i in range(0, batch.num_rows, bucket)):
                held.append(part)
                size_held += part.num_rows
                if size_held >= bucket:
                    search(pa.Table.from_batches(held))
                    held, size_held = [], 0
        if size_held:
            search(pa.Table.from_batches(held))
        for at, found in enumerate(best):
            if found is not None:
                made = [pa.array([at] * len(found), pa.int32()), *[found[c].combine_chunks() for c in ("doc_id", "score", "row")]]
                yield pa.RecordBatch.from_arrays(made, ["query", "doc_id", "score", "row"])

    return run


def _best(vectors: DataFrame, queries, floors, k: int, bucket: int) -> DataFrame:
    """(query, doc_id, score, row, rank) of the k best of each query. Only k rows of a task and query are shuffled."""
    schema = T.StructType([T.StructField("query", T.IntegerType()), vectors.schema["doc_id"],
                           T.StructField("score", T.LongType()), T.StructField("row", T.LongType())])
    found = vectors.select("row", "doc_id", "tids", "imps", "norm").mapInArrow(_searched(queries, floors, k, bucket), schema)
    own = Window.partitionBy("query").orderBy(F.desc("score"), F.asc_nulls_last("doc_id"), "row")
    return found.withColumn("rank", F.row_number().over(own)).where(F.col("rank") <= k)


def _search_block(docs: DataFrame, terms: DataFrame, id_col: str, text_col: str, k: int, bucket: int) -> DataFrame | None:
    """The results of one block of items (item_id, term, tf), which the driver holds; None without a document."""
    rows = terms.collect()
    vocabulary = sorted({r.term for r in rows})
    tid = {t: i for i, t in enumerate(vocabulary)}
    raw = staged(term_vectors(docs, id_col, text_col, vocabulary), "search-terms")
    total = raw.agg(F.count("*").alias("n"), F.sum("n").alias("l")).first()
    if not total.n:
        return None
    dealt = impact_vectors(raw, total.n, total.l).repartitionByRange(F.desc("norm"), "row")
    vectors = staged(dealt.sortWithinPartitions(F.desc("norm"))
                     .withColumn("place", F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1)), "search-vectors")
    drop_staged(raw)
    df = {r.tid: r.df for r in document_frequencies(vectors).collect()}  # at most a row for each term of the block
    weight = [math.floor(1000 * math.log((2 * total.n + 2) / (2 * df[i] + 1))) if i in df else 0
              for i in range(len(vocabulary))]
    items: dict = {}
    for r in rows:
        own = items.setdefault(r.item_id, ([], []))
        if weight[tid[r.term]]:
            own[0].append(tid[r.term])
            own[1].append(weight[tid[r.term]] * r.tf)
    queries = list(items.values())
    # floors: the k-th best score among the longest vectors of each partition
    heads = _best(vectors.where(F.col("place") < bucket // 8), queries, [1] * len(queries), k, bucket)
    floors = {r.query: r.score for r in heads.where(F.col("rank") == k).select("query", "score").collect()}
    found = _best(vectors, queries, [floors.get(i, 1) for i in range(len(queries))], k, bucket)
    ids = docs.sparkSession.createDataFrame([(i, v) for i, v in enumerate(items)],
                                            T.StructType([T.StructField("query", T.IntegerType()), terms.schema["item_id"]]))
    return found.join(F.broadcast(ids), "query").select("item_id", "rank", "doc_id", "score")


def ranked_search(docs: DataFrame, items: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                  item_col: str = "item_id", item_text: str = "text", k: int = 10, bucket: int = BUCKET,
                  block_terms: int = BLOCK_TERMS) -> DataFrame:
    """For each item its ``k`` best documents with a score above 0: item_id, rank (from 1), doc_id, score.

    Terms are runs of digits, letters (A-Z lower-cased) and characters outside ASCII. With N documents that have a term, L
    terms in all and n in a document, a term in df documents weighs floor(1000 * ln((2 N + 2) / (2 df + 1))), and its
    impact on a document that holds it tf times is (10^9 tf) div (1000 tf + 8 m), m = 25 + (75 n N) div L. The score sums
    weight times impact over the item's terms with their repeats, in 64-bit integers. Equal scores: smaller doc_id first,
    rows without an id last.

    Whole texts are read once for each block of items, whose terms the tasks hold: blocks are dealt by the hash of the
    item id, about ``block_terms`` terms each. The documents' impact vectors over the block's terms are ordered by length
    by a range sort and searched in buckets (see ``_searched``); every task starts from the k-th best score among the
    longest vectors of all partitions. All documents are ranked: nothing but a bound below the floor leaves one out.

    Rows that share a doc_id are documents of their own; rows of one item_id are one item, with the terms of all of them;
    a null item id is an item too. Null and empty texts have no terms, an item without terms has no rows, and empty tables
    give none. Only the named columns are read."""
    terms = staged(item_terms(items, item_col, item_text), "search-items")
    blocks = max(1, math.ceil(terms.count() / block_terms))
    done = []
    for b in range(blocks):
        own = terms.where(F.pmod(F.xxhash64("item_id"), F.lit(blocks)) == b) if blocks > 1 else terms
        found = _search_block(docs, own, id_col, text_col, k, bucket)
        if found is not None:
            done.append(found)
    drop_staged(terms)
    if not done:
        types = {"item_id": items.schema[item_col].dataType, "doc_id": docs.schema[id_col].dataType}
        return docs.sparkSession.createDataFrame([], T.StructType([
            T.StructField("item_id", types["item_id"]), T.StructField("rank", T.IntegerType()),
            T.StructField("doc_id", types["doc_id"]), T.StructField("score", T.LongType())]))
    return reduce(DataFrame.unionByName, done)
