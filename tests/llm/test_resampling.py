import hashlib
import math
import re
import zlib
from collections import Counter

import pytest

from profitlens.llm import resampling
from profitlens.llm.queries import QUERIES
from llm_cases import LONG, SF, sorted_rows

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def buckets_of(text):
    words = WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))
    runs = [" ".join(words[i:i + n]) for n in (1, 2, 3) for i in range(len(words) - n + 1)]
    return len(words), [zlib.crc32(r.encode()) % 10000 for r in runs]


def brute(docs, target, percent=5):
    """Rows (doc_id, n_features, weight, score, rank) of (doc_id, text) and texts."""
    made = [(i, *buckets_of(t)) for i, t in docs]
    s, t = Counter(b for _, _, bs in made for b in bs), Counter(b for x in target for b in buckets_of(x)[1])
    S, T = sum(s.values()), sum(t.values())
    gain = {b: math.floor(1000 * math.log((t[b] + 1) * (S + 10000) / ((s[b] + 1) * (T + 10000)))) for b in range(10000)}
    rows = []
    for i, n, bs in made:
        h = int(hashlib.sha256(f"42:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        w = sum(gain[b] for b in bs)
        rows.append((i, len(bs), w, w + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    able = sorted((r for r in rows if r[4] >= 20), key=lambda r: (-r[3], r[0] is None, r[0] or 0, r[4]))
    drawn = able[:percent * len(able) // 100]
    rest = [r for r in rows if r[4] < 20] + able[len(drawn):]
    return [(*r[:4], k) for k, r in enumerate(drawn, 1)] + [(*r[:4], None) for r in rest]


def key(rows):
    return sorted(rows, key=lambda r: tuple((v is not None, v or 0) for v in r))


def test_whole_query(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    target = [r.text for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    df = QUERIES["op11_resampling"](spark, SF)
    assert df.dtypes == [(c, "bigint") for c in ("doc_id", "n_features", "weight", "score", "rank")]
    assert key(map(tuple, df.collect())) == key(brute(docs, target))


def test_odd_rows_and_empty_tables(spark, odd, empty):
    target = spark.createDataFrame([(LONG,), (None,), ("",)], "text string")
    cols = ["doc_id", "n_features", "weight", "score", "rank"]
    got = resampling.resample(odd, target, percent=50).select(*cols)
    docs = [(r.doc_id, r.text) for r in odd.collect()]
    assert key(map(tuple, got.collect())) == key(brute(docs, [LONG], 50))
    assert resampling.resample(empty, target).count() == 0
    got = resampling.resample(odd, target.limit(0), percent=100).select(*cols)
    assert key(map(tuple, got.collect())) == key(brute(docs, [], 100))


def test_pieces_of_a_long_text(monkeypatch):
    text = "Ab1 cd,é中 x " * 50 + "y" * 40 + " z"
    whole = buckets_of(text)
    for piece in (1, 7, 33, 10**6):
        monkeypatch.setattr(resampling, "PIECE", piece)
        made = list(resampling._features(10000, 3)(text.encode()))
        assert sum(n for n, _ in made) == whole[0]
        assert Counter(int(b) for _, m in made for b in m) == Counter(whole[1])


@pytest.mark.parametrize("k", [1, 2, 500, 1999, 3000, 3001])
def test_selection_by_medians(spark, k):
    """Many equal scores and ids, nulls: the k-th row of the whole order, by rounds of medians alone."""
    rows = [((i * 7919) % 13 if i % 3 else 5, None if i % 5 == 0 else i % 4, i) for i in range(3000)]
    order = [("score", "descending"), ("doc_id", "ascending"), ("row", "ascending")]
    df = spark.createDataFrame(rows, "score long, doc_id long, row long").repartition(7)
    got = resampling.cutoff(df, order, k, finish=1)
    whole = sorted(rows, key=lambda r: (-r[0], r[1] is None, r[1] or 0, r[2]))
    assert got == (dict(zip(("score", "doc_id", "row"), whole[k - 1])) if k <= len(whole) else None)


def test_copies_hold_a_third_of_the_rows(spark):
    """Equal rows without an id: drawn up to the cutoff, numbered without gaps."""
    words = " ".join(f"w{i}" for i in range(30))
    docs = [(None, words)] * 100 + [(i, words + f" v{i}") for i in range(200)]
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(5)
    target = spark.createDataFrame([(words,)], "text string")
    got = resampling.resample(df, target, percent=70, finish=8).drop("n_words")
    assert key(map(tuple, got.collect())) == key(brute(docs, [words], 70))
    assert sorted_rows(got.where("rank is not null").select("rank")) == sorted_rows(spark.range(1, 211))
