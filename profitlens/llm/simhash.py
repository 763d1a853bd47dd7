"""SimHash near-duplicates: pigeonhole blocks, block join, Hamming check, connected components."""

from __future__ import annotations

from itertools import combinations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profitlens.llm._common import WORD, small_batches, staged
from profitlens.llm.components import connected_components

BITS = 64
# A block bucket with more fingerprints than this is dealt out again by blocks of the bits that are free in it.
HOT_BUCKET = 4096


def fingerprints(df: DataFrame, id_col: str, text_col: str, shingle: int = 3, seed: int = 42,
                 others: tuple = ()) -> DataFrame:
    """doc_id, the columns ``others`` and the 64-bit SimHash (signed long) of each whole text.

    Words of the text (A-Z lower-cased) form shingles of ``shingle`` words joined by a space, with repeats; fewer words:
    the whole sequence. A bit is 1 if it is set in over half of the shingles' XXH64. Null text, or no word: 0."""
    small_batches(df.sparkSession)

    def run(batches):
        import re

        import numpy as np
        import xxhash

        word, lower = re.compile(WORD), {c: c + 32 for c in range(65, 91)}
        hash64 = xxhash.xxh64_intdigest

        def one(text):
            words = word.findall(text.translate(lower)) if text else []
            if not words:
                return 0
            if len(words) > shingle:
                parts = map(" ".join, zip(*[words[i:] for i in range(shingle)]))
                h = np.fromiter((hash64(p, seed) for p in parts), np.uint64, len(words) - shingle + 1)
            else:
                h = np.array([hash64(" ".join(words), seed)], np.uint64)
            ones = np.zeros(BITS, np.int64)
            for i in range(0, len(h), 4096):  # bit b of a hash is column b
                ones += np.unpackbits(h[i:i + 4096].view(np.uint8).reshape(-1, 8), axis=1, bitorder="little").sum(0, dtype=np.int64)
            return int(np.packbits(2 * ones > len(h), bitorder="little").view(np.int64)[0])

        for batch in batches:
            made = pa.array([one(t) for t in batch.column(batch.num_columns - 1).to_pylist()], pa.int64())
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], made], schema.names)

    docs = df.select(F.col(id_col).alias("doc_id"), *others, F.col(text_col).cast("string").alias("__text"))
    schema = docs.drop("__text").schema.add("fp", "long")
    return docs.mapInArrow(run, schema)


def _signed(mask: int) -> int:
    return mask - (1 << 64) if mask >> 63 else mask


def _blocks(positions: list[int], k: int) -> list[list[int]]:
    """k runs of the bit positions, sizes at most one apart."""
    n = len(positions)
    return [positions[n * i // k:n * (i + 1) // k] for i in range(k)]


def block_masks(distance: int, positions: list[int], blocks: int) -> list[int]:
    """Masks of every choice of ``blocks - distance`` blocks: two values that differ in at most ``distance`` of these
    positions agree on at least one mask."""
    parts = _blocks(positions, blocks)
    return [sum(1 << p for part in chosen for p in part) for chosen in combinations(parts, blocks - distance)]


def _links(distance: int):
    """Rows (t, s, key, fp), sorted and a bucket's rows together -> links (a, b) that span the bucket's groups of
    fingerprints within ``distance`` bits (each next to one that was reached before), not all pairs."""

    def run(batches):
        import numpy as np

        count = np.bitwise_count

        def bucket(fps, out):
            rest = fps
            while len(rest) > 1:
                queue, rest = [rest[0]], rest[1:]
                while queue and len(rest):
                    at = queue.pop()
                    near = count(rest ^ at) <= distance
                    if near.any():
                        reached = rest[near]
                        out.append((np.full(len(reached), at), reached))
                        queue.extend(reached)
                        rest = rest[~near]

        def table(cols):
            change = np.flatnonzero(np.any([c[1:] != c[:-1] for c in cols[:3]], axis=0)) + 1
            starts, ends = np.concatenate([[0], change]), np.concatenate([change, [len(cols[0])]])
            return starts, ends

        held = None
        for batch in batches:
            cols = [np.asarray(c) for c in batch.columns]
            cols = cols if held is None else [np.concatenate(x) for x in zip(held, cols)]
            if not len(cols[0]):
                continue
            starts, ends = table(cols)
            out = []
            for k in np.flatnonzero(ends[:-1] - starts[:-1] > 1):
                bucket(cols[3][starts[k]:ends[k]].view(np.uint64), out)
            held = [c[starts[-1]:] for c in cols]  # the last bucket may go on in the next batch
            if out:
                yield _batch(out)
        if held is not None and len(held[0]) > 1:
            out = []
            bucket(held[3].view(np.uint64), out)
            if out:
                yield _batch(out)

    def _batch(out):
        import numpy as np

        a, b = (np.concatenate(x).view(np.int64) for x in zip(*out))
        return pa.RecordBatch.from_arrays([pa.array(a), pa.array(b)], ["a", "b"])

    return run


def links_within(fps: DataFrame, distance: int = 3, blocks: int | None = None) -> DataFrame:
    """Links (a, b) between distinct fingerprints (column fp) that connect all those within ``distance`` bits.

    Pigeonhole: 64 bits in ``blocks`` blocks (twice the distance unless given); close pairs agree on all but
    ``distance`` of them, so each fingerprint goes to a bucket for every choice of the others, and only buckets are
    searched. A bucket of more than HOT_BUCKET fingerprints is dealt out again by the same rule over the bits that are
    free in it, cut so fine that at most 2^13 different fingerprints can share a bucket: no bucket is unbounded,
    none is dropped. Within a bucket the exact Hamming distance decides."""
    blocks = blocks or 2 * distance
    masks = block_masks(distance, list(range(BITS)), blocks)
    fp = F.col("fp")
    keys = fps.select("fp", F.explode(F.array(*[
        F.struct(F.lit(t).alias("t"), fp.bitwiseAND(F.lit(_signed(m))).alias("key")) for t, m in enumerate(masks)
    ])).alias("b")).select(F.col("b.t").alias("t"), F.col("b.key").alias("key"), "fp")
    hot = keys.groupBy("t", "key").agg(F.count("*").alias("n")).where(F.col("n") > HOT_BUCKET).select("t", "key")
    hot = staged(hot, "simhash-hot")
    plain = keys.join(hot, ["t", "key"], "left_anti").select("t", F.lit(-1).alias("s"), "key", "fp")
    free = [[p for p in range(BITS) if not m >> p & 1] for m in masks]
    inner = [block_masks(distance, f, 2 * distance + 2) for f in free]
    table = F.array(*[F.array(*[F.lit(_signed(m | masks[t])) for m in ms]) for t, ms in enumerate(inner)])
    again = (keys.join(hot, ["t", "key"], "left_semi")
             .select("t", "fp", F.posexplode(F.element_at(table, F.col("t") + 1)).alias("s", "m"))
             .select("t", "s", F.col("fp").bitwiseAND(F.col("m")).alias("key"), "fp"))
    both = plain.unionByName(again)
    dealt = both.repartition("t", "s", "key").sortWithinPartitions("t", "s", "key")
    return dealt.mapInArrow(_links(distance), "a long, b long")


def near_duplicates(df: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle: int = 3,
                    distance: int = 3, seed: int = 42) -> DataFrame:
    """doc_id, fingerprint (16 hex digits) and component_id of every row: the smallest doc_id reachable over links of
    fingerprints at ``distance`` or fewer differing bits.

    Rows of one fingerprint are one class from the start (copies are never paired); only classes go to the buckets and
    the component search, which runs in Spark. Null and empty texts have fingerprint zero and link like any other. A
    null doc_id never names a component unless all its documents lack one (then null). Repeated rows stay; an empty
    table gives no rows. Only the two named columns are read, so others cannot clash."""
    return _grouped(df, id_col, text_col, shingle, distance, seed).select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id")


def _grouped(df: DataFrame, id_col: str, text_col: str, shingle: int = 3, distance: int = 3, seed: int = 42,
             others: tuple = ()) -> DataFrame:
    """doc_id, ``others``, fp, root (the fingerprint that names the component) and component_id of every row."""
    docs = staged(fingerprints(df, id_col, text_col, shingle, seed, others), "simhash-docs")
    classes = staged(docs.groupBy("fp").agg(F.min("doc_id").alias("least")), "simhash-classes")
    edges = staged(links_within(classes.select("fp"), distance).distinct(), "simhash-links")
    roots = connected_components(edges)
    found = (classes.join(roots, classes.fp == roots.node, "left")
             .select("fp", F.coalesce("root", "fp").alias("root"), "least"))
    least = found.groupBy("root").agg(F.min("least").alias("component_id"))
    return docs.join(found.join(least, "root").select("fp", "root", "component_id"), "fp")


def keep_one(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> DataFrame:
    """One document of each group of near-duplicates, all columns: the one with the smallest doc_id, of several rows with
    this doc_id (or without any) the one with the smallest digest of the text. Groups that share a doc_id, or lack one,
    each keep theirs."""
    digest = F.sha2(F.col(text_col).cast("string"), 256)
    found = _grouped(docs, id_col, text_col, others=(digest.alias("digest"),), **options)
    first = (found.where(F.col("doc_id").eqNullSafe(F.col("component_id"))).groupBy("root")
             .agg(F.min(F.struct("doc_id", "digest")).alias("kept"))
             .select(F.col("kept.doc_id").alias("__kept"), F.col("kept.digest").alias("__kept_digest")))
    own = docs.withColumn("__digest", digest)
    same = own[id_col].eqNullSafe(first["__kept"]) & own["__digest"].eqNullSafe(first["__kept_digest"])
    return own.join(first, same, "left_semi").dropDuplicates([id_col, "__digest"]).drop("__digest")
