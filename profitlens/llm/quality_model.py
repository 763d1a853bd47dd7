"""Quality classifier: supervised subword embeddings, averaged per document, softmax output."""

from __future__ import annotations

from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from profitlens.llm._common import WORD, small_batches

BUCKETS = 1 << 18    # rows of the embedding table; words and n-grams are hashed to them
DIMS = 8
NGRAMS = (3, 4)      # lengths of the character n-grams
MAX_TRAIN = 4000     # documents that the model is fitted on: a bounded sample of the labelled ones
MAX_FEATURES = 12_000_000  # distinct features of the sample, in all, that the driver holds
EPOCHS = 12
RATE = 0.3
SEED = 11
CHUNK_WORDS = 50_000  # words whose features are made at once


@dataclass
class Model:
    """weights: for each bucket its embedding's part in the difference of the two classes' outputs; bias likewise."""
    weights: object
    bias: float


class Subwords:
    """Hashed features of a whole text: its words, runs of repeated words and the character n-grams of each word with its
    boundaries."""

    def __init__(self):
        import re

        import numpy as np

        self.np, self.word = np, re.compile(WORD)
        self.base = np.uint64(0x9E3779B97F4A7C15 | 1)
        self.mix = np.uint64(0xD6E8FEB86659FD93)
        self.grow(1 << 12)

    def grow(self, n: int):
        np = self.np
        with np.errstate(over="ignore"):
            inverse = np.uint64(pow(int(self.base), -1, 1 << 64))
            self.powers = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, self.base)]), dtype=np.uint64)
            self.inverses = np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, inverse)]), dtype=np.uint64)

    def buckets(self, hashes, kind: int):
        np = self.np
        with np.errstate(over="ignore"):
            h = (hashes + np.uint64(kind) * self.base) * self.mix
            return ((h ^ (h >> np.uint64(32))) * self.mix >> np.uint64(64 - 18)).astype(np.int32)

    def chunk(self, words: list[str]):
        np = self.np
        a = np.frombuffer((" " + " ".join(words) + " ").encode("utf-32-le"), np.uint32).astype(np.uint64)
        n = len(a)
        if n >= len(self.powers):
            self.grow(2 * n)
        space = np.flatnonzero(a == 32)
        with np.errstate(over="ignore"):
            run = np.concatenate([[np.uint64(0)], np.cumsum(a * self.powers[:n], dtype=np.uint64)])
            starts, ends = space[:-1] + 1, space[1:]
            whole = (run[ends] - run[starts]) * self.inverses[starts]
            # a word that repeats the one before gives the same feature whatever it is
            again = int((whole[1:] == whole[:-1]).sum())
            out = [self.buckets(whole, 1), np.full(again, self.buckets(np.zeros(1, np.uint64), 2)[0], np.int32)]
            marks = np.cumsum(a == 32)
            for k in NGRAMS:
                if n < k:
                    continue
                h = (run[k:] - run[:-k]) * self.inverses[:n - k + 1]
                inner = marks[k - 2:n - 1] - marks[:n - k + 1]  # spaces in all but the first and the last character
                out.append(self.buckets(h[inner == 0], 2 + k))
        return np.concatenate(out)

    def features(self, text: str | None):
        """Arrays of buckets of a whole text, a chunk of words at a time; none for a text without a word."""
        words = self.word.findall(text) if text else []
        for i in range(0, len(words), CHUNK_WORDS):
            yield self.chunk(words[i:i + CHUNK_WORDS])


def training_sample(df: DataFrame, id_col: str, text_col: str, label_col: str, limit: int = MAX_TRAIN) -> list:
    """(label, buckets, counts) of ``limit`` labelled rows at most, those with the smallest hash of the id. The whole
    texts of the sample become features on the executors; the driver gets distinct buckets with counts, MAX_FEATURES in
    all at most (rows beyond are left out of the sample)."""
    small_batches(df.sparkSession)
    place = F.xxhash64(F.col(id_col).cast("string"), F.lit(SEED))
    labelled = df.where(F.col(label_col).isin(0, 1))
    # only ids are ordered; the bounded list of them (8 bytes each) goes to the texts
    chosen = F.broadcast(labelled.select(place.alias("__p")).orderBy("__p").limit(limit).distinct())
    rows = labelled.withColumn("__p", place).join(chosen, "__p", "left_semi").select(
        "__p", F.col(label_col).cast("int").alias("label"), F.col(text_col).cast("string").alias("text"))

    def run(batches):
        import numpy as np

        subwords = Subwords()
        for batch in batches:
            ids, counts = [], []
            for t in batch.column(2).to_pylist():
                got = list(subwords.features(t))
                found, n = np.unique(np.concatenate([np.empty(0, np.int32), *got]), return_counts=True)
                ids.append(found.astype(np.int32).tobytes())
                counts.append(n.astype(np.float32).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(ids, pa.binary()),
                                              pa.array(counts, pa.binary())], ["p", "label", "ids", "counts"])

    import numpy as np

    out, total = [], 0
    made = rows.mapInArrow(run, "p long, label int, ids binary, counts binary").orderBy("p", "label", "ids")
    for r in made.toLocalIterator():  # a part at a time, until the bound is reached
        ids = np.frombuffer(r.ids, np.int32)
        total += len(ids)
        if len(out) >= limit or total > MAX_FEATURES:
            break
        if len(ids):
            out.append((r.label, ids, np.frombuffer(r.counts, np.float32)))
    return out


def train(sample: list, epochs: int = EPOCHS, rate: float = RATE, seed: int = SEED) -> Model | None:
    """Stochastic gradient descent, one document a step: its features' embeddings are averaged, a softmax layer gives
    the two classes. None without samples."""
    import numpy as np

    if not sample:
        return None
    rng = np.random.default_rng(seed)
    table = rng.uniform(-1 / DIMS, 1 / DIMS, (BUCKETS, DIMS)).astype(np.float32)
    out, bias = np.zeros((2, DIMS), np.float32), np.zeros(2, np.float32)
    share = sum(label for label, _, _ in sample) / len(sample)
    bias[:] = np.log(np.clip([1 - share, share], 0.01, 0.99))
    docs = [(label, ids, (n / n.sum())[:, None]) for label, ids, n in sample]
    steps, done = epochs * len(docs), 0
    for _ in range(epochs):
        for k in rng.permutation(len(docs)):
            label, ids, w = docs[k]
            speed = rate * (1 - done / steps)
            done += 1
            rows = table[ids]
            mean = (w * rows).sum(0)
            logits = out @ mean + bias
            p = np.exp(logits - logits.max())
            p /= p.sum()
            p[label] -= 1
            back = out.T @ p
            out -= speed * np.outer(p, mean)
            bias -= speed * 0.1 * p
            # each feature moves by its weight, scaled so that a typical one moves noticeably
            table[ids] = rows - speed * (w * np.float32(len(ids))).clip(max=20) * back
    return Model((table @ (out[1] - out[0])).astype(np.float32), float(bias[1] - bias[0]))


def score_quality(df: DataFrame, id_cols: list, text_col: str, model: Model | None) -> DataFrame:
    """id columns and score (0 to 1): the softmax probability of label 1 for each whole text. The averaged embeddings
    enter a linear layer, so a bucket's part in the output is one number, and the mean of these is the output.

    Null or empty text: the score of no features (the bias alone). No model: 0.5. Repeated rows repeat; an empty table
    gives no rows; only the named columns are read."""
    spark = df.sparkSession
    small_batches(spark)
    schema = df.select(*id_cols).schema.add("score", "double")
    held = spark.sparkContext.broadcast(None if model is None else (model.weights, model.bias))

    def run(batches):
        import math

        subwords = Subwords()

        def one(text):
            if held.value is None:
                return 0.5
            weights, bias = held.value
            total = n = 0
            for b in subwords.features(text):
                total += float(weights[b].sum(dtype="float64"))
                n += len(b)
            return 1 / (1 + math.exp(-max(-500.0, min(500.0, bias + total / max(1, n)))))

        for batch in batches:
            scores = [one(t) for t in batch.column(batch.num_columns - 1).to_pylist()]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(scores, pa.float64())], schema.names)

    return df.select(*id_cols, F.col(text_col).cast("string").alias("__text")).mapInArrow(run, schema)


def learn_quality(documents: DataFrame, labels: DataFrame, training, limit: int = MAX_TRAIN) -> Model | None:
    """The model of the labelled documents whose id the condition ``training`` (a function of the id column) accepts.
    ``labels`` (doc_id, quality) is joined by id; null labels teach nothing."""
    place = F.xxhash64(F.col("doc_id").cast("string"), F.lit(SEED))
    known = labels.where(F.col("quality").isin(0, 1) & training(F.col("doc_id"))).select("doc_id", "quality")
    known = known.orderBy(place).limit(limit)  # the bound of the sample: at most ``limit`` ids and labels
    rows = documents.select("doc_id", F.col("text").cast("string").alias("text")).join(F.broadcast(known.dropDuplicates()), "doc_id")
    # a row for each id and label, however often the id repeats: the text with the smallest digest
    rows = rows.groupBy("doc_id", "quality").agg(F.min_by("text", F.sha2("text", 256)).alias("text"))
    return train(training_sample(rows, "doc_id", "text", "quality", limit))
