"""Language identification by hyperdimensional letter n-gram profiles."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profitlens.llm._common import small_batches

DIMS = 512          # length of the vectors
SEED = 20240229
UNIT = 10_000       # length of a text's vector in a prototype
MAX_LANGUAGES = 2000   # prototypes are held in memory: at most this many languages
CACHED_NGRAMS = 1 << 16  # n-gram vectors a task keeps
TEXTS = 64          # texts whose trigrams a task holds at once
CELLS = 1 << 20     # numbers of unpacked vectors that a task holds at once


class NgramSpace:
    """Vectors of letter trigrams: a letter has a random vector of +1 and -1 drawn from its code point; a trigram binds
    (multiplies) the vectors of its letters, permuted (rolled) by their distance from its end. Vectors are held as bits
    (1 for -1), so binding is an exclusive or. They are kept for up to CACHED_NGRAMS trigrams (fewer if they are longer
    than DIMS) and made anew beyond, so memory is bounded for any script."""

    def __init__(self, dims: int = DIMS, seed: int = SEED):
        import numpy as np
        import regex

        self.np, self.dims, self.seed = np, dims, seed
        self.cached = max(1, CACHED_NGRAMS * DIMS // dims)
        self.other = regex.compile(r"\P{L}+")
        self.letters: dict[int, object] = {}
        self.clear()

    def clear(self):
        self.codes = self.np.empty(0, self.np.int64)
        self.table = self.np.empty((0, -(-self.dims // 8)), self.np.uint8)

    def letter(self, point: int):
        bits = self.np.random.Generator(self.np.random.PCG64([self.seed, point])).integers(0, 2, self.dims)
        return (2 * bits - 1).astype(self.np.int8)

    def packed(self, point: int):
        """The letter's bits, rolled by 2, 1 and 0."""
        if point not in self.letters:
            if len(self.letters) > 1 << 14:
                self.letters.clear()
            minus = self.letter(point) < 0
            self.letters[point] = self.np.packbits([self.np.roll(minus, 2), self.np.roll(minus, 1), minus], axis=1)
        return self.letters[point]

    def trigrams(self, text: str | None):
        """Codes of all trigrams of the text: lower-cased, each run of other characters one space, a space at both
        ends; those around a space are left out. Empty if there is no letter."""
        np = self.np
        words = self.other.sub(" ", text.lower()).strip() if text else ""
        if not words:
            return np.empty(0, np.int64)
        a = np.frombuffer(f" {words} ".encode("utf-32-le"), np.uint32).astype(np.int64)
        codes = (a[:-2] << 42) | (a[1:-1] << 21) | a[2:]
        return codes[a[1:-1] != 32]

    def make(self, codes):
        """Bits of the vectors of the codes, a row each."""
        np, mask = self.np, (1 << 21) - 1
        points, at = np.unique(np.stack([codes >> 42, (codes >> 21) & mask, codes & mask]), return_inverse=True)
        first, second, last = at.reshape(3, -1)
        letters = np.stack([self.packed(int(p)) for p in points])
        return letters[first, 0] ^ letters[second, 1] ^ letters[last, 2]

    def learn(self, codes):
        """Make room for, and make, the vectors of a batch's codes (any order, with repeats)."""
        np = self.np
        new = np.setdiff1d(codes, self.codes)
        if len(self.codes) + len(new) > self.cached:
            self.clear()
            new = np.unique(codes)[:self.cached]
        if len(new):
            both = np.concatenate([self.codes, new])
            order = np.argsort(both)
            self.codes, self.table = both[order], np.concatenate([self.table, self.make(new)])[order]

    def bundle(self, codes):
        """The sum of the vectors of all trigrams (with repeats): exact whole numbers."""
        np = self.np
        found, counts = np.unique(codes, return_counts=True)
        minus = np.zeros(self.dims, np.float64)
        # a sum of fewer than 2^24 ones is exact in single precision
        kind = np.float32 if len(codes) < 1 << 24 else np.float64
        chunk = max(1, CELLS // self.dims)
        for i in range(0, len(found), chunk):
            part = found[i:i + chunk]
            at = np.minimum(np.searchsorted(self.codes, part), max(0, len(self.codes) - 1))
            known = self.codes[at] == part if len(self.codes) else np.zeros(len(part), bool)
            rows = self.table[at] if known.all() else np.empty((len(part), self.table.shape[1]), np.uint8)
            if not known.all():  # beyond the cache
                rows[known], rows[~known] = self.table[at[known]], self.make(part[~known])
            minus += counts[i:i + chunk].astype(kind) @ np.unpackbits(rows, axis=1, count=self.dims).astype(kind)
        return len(codes) - 2 * minus

    def bundles(self, texts):
        """The bundle of each text's trigrams, None for a text without a letter; TEXTS texts are held at once."""
        for i in range(0, len(texts), TEXTS):
            part = [self.trigrams(t) for t in texts[i:i + TEXTS]]
            self.learn(self.np.concatenate(part))
            for codes in part:
                yield self.bundle(codes) if len(codes) else None


def learn_profiles(df: DataFrame, text_col: str, lang_col: str, dims: int = DIMS, seed: int = SEED) -> dict[str, list]:
    """Prototype of each language: the bundle of its texts' vectors, from every row with a language. A text's vector is
    the bundle of its trigrams, scaled to length UNIT and rounded, so a very long text counts as much as another.

    Each task bundles the rows it reads, one partial vector for each language; the partial sums are whole numbers and
    are added by a group-by on (language, dimension), so no task gathers a language's rows. The result (languages x
    dims numbers, at most MAX_LANGUAGES languages) comes to the driver. Null languages, null texts and texts without a
    letter teach nothing; no rows: no prototypes."""
    small_batches(df.sparkSession)

    def run(batches):
        import numpy as np

        space, sums = NgramSpace(dims, seed), {}
        for batch in batches:
            texts, langs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for v, lang in zip(space.bundles(texts), langs):
                if v is not None:
                    sums[lang] = sums.get(lang, 0) + np.rint(v * (UNIT / max(1.0, float(np.linalg.norm(v)))))
        for lang, total in sums.items():
            yield pa.RecordBatch.from_arrays([pa.array([lang] * dims), pa.array(np.arange(dims, dtype=np.int32)),
                                              pa.array(np.rint(total).astype(np.int64))], ["lang", "d", "v"])

    part = (df.where(F.col(lang_col).isNotNull() & F.col(text_col).isNotNull())
            .select(F.col(text_col).alias("text"), F.col(lang_col).cast("string").alias("lang"))
            .mapInArrow(run, "lang string, d int, v long"))
    rows = (part.groupBy("lang", "d").agg(F.sum("v").alias("v"))
            .groupBy("lang").agg(F.array_sort(F.collect_list(F.struct("d", "v"))).alias("p"))
            .select("lang", F.col("p.v").alias("p")).take(MAX_LANGUAGES + 1))
    if len(rows) > MAX_LANGUAGES:
        raise ValueError(f"more than {MAX_LANGUAGES} languages")
    return {r.lang: list(r.p) for r in sorted(rows, key=lambda r: r.lang) if any(r.p)}


def predict_language(df: DataFrame, id_cols: list[str | Column], text_col: str, profiles: dict[str, list],
                     dims: int = DIMS, seed: int = SEED) -> DataFrame:
    """id columns, lang_pred and score: the language whose prototype has the largest cosine with the bundle of the whole
    text's trigrams (ties: the smaller name), and that cosine (0 if negative).

    Null text, text without a letter, or no learned prototype: ``und``, 0. Only the text is an input. Rows repeat as
    they come; an empty table gives none; columns not named in id_cols are left out, so their names cannot clash."""
    spark = df.sparkSession
    small_batches(spark)
    schema = df.select(*id_cols).schema.add("lang_pred", "string").add("score", "double")
    model = spark.sparkContext.broadcast(profiles)

    def run(batches):
        import numpy as np

        space, names = NgramSpace(dims, seed), sorted(model.value)
        protos = np.array([model.value[n] for n in names], np.float64).reshape(len(names), dims)
        protos /= np.maximum(np.linalg.norm(protos, axis=1, keepdims=True), 1e-300)
        for batch in batches:
            pred, score = [], []
            for v in space.bundles(batch.column(batch.num_columns - 1).to_pylist()):
                if v is None or not names:
                    pred.append("und")
                    score.append(0.0)
                    continue
                near = protos @ v
                k = int(near.argmax())
                pred.append(names[k])
                score.append(min(1.0, max(0.0, float(near[k] / max(float(np.linalg.norm(v)), 1e-300)))))
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], pa.array(pred, pa.string()),
                                              pa.array(score, pa.float64())], schema.names)

    return (df.select(*id_cols, F.col(text_col).alias("__text"))
            .mapInArrow(run, schema))
