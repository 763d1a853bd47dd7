import random
import re

import pytest

from profitlens.llm.decontaminate import benchmark_hits
from llm_cases import LONG, SF

WORD = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def words(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m.group().lower(), text or ""))


def brute(docs, items, window=10):
    """Rows (doc_id, n_words, n_hit, items, spans) of (doc_id, text) and (item_id, text)."""
    wins = {}
    for i, t in items:
        w = words(t)
        n = min(window, len(w))
        for s in range(len(w) - n + 1 if n else 0):
            wins.setdefault(tuple(w[s:s + n]), set()).add("" if i is None else str(i))
    out = []
    for i, t in docs:
        w, hit, found = words(t), set(), set()
        for n in {len(k) for k in wins}:
            for s in range(len(w) - n + 1):
                if tuple(w[s:s + n]) in wins:
                    hit |= set(range(s, s + n))
                    found |= wins[tuple(w[s:s + n])]
        starts, ends = ([p for p in sorted(hit) if p - 1 not in hit], [p + 1 for p in sorted(hit) if p + 1 not in hit])
        out.append((i, len(w), len(hit), sorted(found), list(zip(starts, ends))))
    return key(out)


def key(rows):
    rows = [(r[0], r[1], r[2], list(r[3]), [tuple(s) for s in r[4]]) for r in rows]
    return sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1:]))


@pytest.mark.parametrize("shingle", [3, 5, 8])
def test_small_vocabulary(spark, shingle):
    """Many windows share their shingles; items shorter than a window or a shingle; overlapping occurrences."""
    rng = random.Random(shingle)
    text = lambda n: " ".join(rng.choice(["a", "B", "c3", "é", "x"]) + rng.choice([" ", ",", "-", ".\n"]) for _ in range(n))
    items = [(i, text(rng.choice([0, 1, 2, 3, 4, 5, 6, 7, 9, 12]))) for i in range(30)] + [(3, text(5)), (None, text(4)), (31, None)]
    items = [x for x in items if len(words(x[1])) > 1 or not words(x[1])]
    docs = [(i, text(rng.randrange(40))) for i in range(80)] + [(7, None), (None, ""), (None, text(30)), (5, text(20))]
    got = benchmark_hits(spark.createDataFrame(docs, "doc_id long, text string"),
                         spark.createDataFrame(items, "item_id long, text string"), window=6, shingle=shingle)
    want = brute(docs, items, 6)
    assert any(r[2] for r in want) and key(got.collect()) == want


def test_table_and_planted_copies(spark):
    docs = [(r.doc_id, r.text) for r in spark.read.parquet(f"{SF}/documents.parquet").collect()]
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{SF}/benchmark.parquet").collect()]
    copy = next(t for _, t in items if len(words(t)) > 20)
    docs += [(10**6 + i, f"start {copy.upper()} end") for i in range(50)]
    got = benchmark_hits(spark.createDataFrame(docs, "doc_id long, text string").repartition(6),
                         spark.createDataFrame(items, "item_id long, text string"))
    got = key(got.collect())
    assert got == brute(docs, items)
    assert all(r[2] == len(words(copy)) for r in got if r[0] is not None and r[0] >= 10**6)


def test_odd_and_empty_tables(spark, odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.collect()]
    items = [(1, "Seven. One two three, four five; six seven one"), (2, "x"), (3, "zwölf GROßE bären"), (4, LONG[-300:]), (None, "")]
    bench = spark.createDataFrame(items, "item_id int, text string")
    for shingle in (5, 7):
        assert key(benchmark_hits(odd, bench, shingle=shingle).collect()) == brute(rows, items)
    with pytest.raises(ValueError):
        benchmark_hits(odd, bench, shingle=4)
    assert benchmark_hits(empty, bench).count() == 0
    assert key(benchmark_hits(odd, bench.limit(0)).collect()) == brute(rows, [])


def test_without_broadcasts(spark):
    docs = [(i, " ".join(f"w{(i * 7 + j) % 50}" for j in range(30))) for i in range(60)]
    items = [(i, " ".join(f"w{(i * 3 + j) % 50}" for j in range(12 if i % 2 else 4))) for i in range(10)]
    before = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold",)}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        got = benchmark_hits(spark.createDataFrame(docs, "doc_id long, text string"),
                             spark.createDataFrame(items, "item_id long, text string"))
        assert key(got.collect()) == brute(docs, items)
        assert "Python" not in got._jdf.queryExecution().toString()
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
