import math
import random
import re
from collections import Counter

import pytest

from profitlens.llm.search import ranked_search
from llm_cases import LONG

TERM = re.compile(r"[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+")


def terms(text):
    return [re.sub("[A-Z]", lambda m: m.group().lower(), w) for w in TERM.findall(text or "")]


def brute(docs, items, k=10):
    """Rows (item_id, rank, doc_id, score) of (doc_id, text) and (item_id, text), every document scored."""
    made = [(i, Counter(terms(t))) for i, t in docs]
    made = [(i, c, sum(c.values())) for i, c in made if c]
    N, L = len(made), sum(n for _, _, n in made)
    df = Counter(t for _, c, _ in made for t in c)
    wanted = {}
    for i, t in items:
        wanted.setdefault(i, Counter()).update(terms(t))
    out = []
    for item, q in wanted.items():
        scores = []
        for i, c, n in made:
            m = 100 - 75 + (75 * n * N) // L
            s = sum(f * math.floor(1000 * math.log((2 * N + 2) / (2 * df[t] + 1))) * ((10**9 * c[t]) // (1000 * c[t] + 8 * m))
                    for t, f in q.items() if t in c)
            if s > 0:
                scores.append((-s, i is None, i or 0, i))
        out += [(item, r, x[3], -x[0]) for r, x in enumerate(sorted(scores, key=lambda x: x[:3])[:k], 1)]
    return key(out)


def key(rows):
    return sorted((tuple(r) for r in rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1]))


def corpus(seed, n):
    """Skewed vocabulary, copies, very different lengths, terms in over half of the documents (negative weights)."""
    rng = random.Random(seed)
    word = lambda: f"T{min(int(rng.paretovariate(0.6)), 400)}"
    docs = [(i, " ".join(word() for _ in range(rng.choice([0, 1, 3, 20, 60, 200])))) for i in range(n)]
    docs += [(rng.choice([None, i, n + i]), docs[rng.randrange(n // 10)][1]) for i in range(n // 3)]
    items = [(i, " ".join(word() for _ in range(rng.choice([1, 2, 5, 30, 80])))) for i in range(25)]
    return docs, items + [(None, "t1 t2 t3 t50"), (3, "t7, t9"), (30, None), (31, "unknown"), (32, "")]


@pytest.mark.parametrize("bucket,blocks", [(7, 1 << 19), (64, 150), (8192, 1 << 19)])
def test_against_brute_force(spark, bucket, blocks):
    docs, items = corpus(bucket, 400)
    got = ranked_search(spark.createDataFrame(docs, "doc_id long, text string").repartition(5),
                        spark.createDataFrame(items, "item_id int, text string"), bucket=bucket, block_terms=blocks)
    assert got.dtypes == [("item_id", "int"), ("rank", "int"), ("doc_id", "bigint"), ("score", "bigint")]
    assert key(got.collect()) == brute(docs, items)


def test_equal_scores(spark):
    """A third of the rows are one text: the smallest ids, then rows without one."""
    docs = [(i if i % 2 else None, "one two three") for i in range(100)] + [(1000 + i, f"x{i} y{i % 7}") for i in range(200)]
    items = [(1, "three two"), (2, "y3"), (3, "Two")]
    got = ranked_search(spark.createDataFrame(docs, "doc_id long, text string").repartition(4),
                        spark.createDataFrame(items, "item_id long, text string"), k=60, bucket=16)
    assert key(got.collect()) == brute(docs, items, 60)


def test_pruning_skips_buckets_and_documents():
    """The bounds are at work: documents below them are never scored (their coordinates are not even read)."""
    import numpy as np
    import pyarrow as pa

    from profitlens.llm import search

    docs = [[(0, 900)], [(0, 800)], [(1, 900)], [(1, 10)], [(2, 5)]]
    batch = pa.RecordBatch.from_pydict({
        "row": list(range(5)), "doc_id": list(range(5)), "tids": pa.array([[t for t, _ in d] for d in docs], pa.list_(pa.int32())),
        "imps": pa.array([[v for _, v in d] for d in docs], pa.list_(pa.int32())),
        "norm": [float(np.sqrt(sum(v * v for _, v in d))) for d in docs]})
    run = search._searched([([0, 1], [100, 3])], [85_000], 1, 2)
    assert [r for b in run(iter([batch])) for r in b.to_pylist()] == [{"query": 0, "doc_id": 0, "score": 90_000, "row": 0}]
    assert list(search._searched([([0, 1], [100, 3])], [95_000], 1, 2)(iter([batch]))) == []


def test_odd_and_empty_tables(spark, odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    items = [(1, "One, two! seven"), (2, "x ZWÖLF große"), (3, LONG[:500]), (4, None)]
    bench = spark.createDataFrame(items, "item_id long, text string")
    assert key(ranked_search(odd, bench).collect()) == brute(rows, items)
    assert ranked_search(empty, bench).collect() == []
    assert ranked_search(odd, bench.limit(0)).collect() == []


def test_pieces_of_a_long_text(spark, monkeypatch):
    from profitlens.llm import search

    docs = [(1, "Ab cd,é中 x " * 40 + "y" * 30), (2, "x x x"), (3, "é")]
    monkeypatch.setattr(search, "PIECE", 9)
    got = search.ranked_search(spark.createDataFrame(docs, "doc_id long, text string"),
                               spark.createDataFrame([(1, "x é中 ab"), (2, "y" * 30)], "item_id long, text string"))
    assert key(got.collect()) == brute(docs, [(1, "x é中 ab"), (2, "y" * 30)])
