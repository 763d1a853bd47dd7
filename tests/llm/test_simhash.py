import random
import re

import pytest
import xxhash

from profitlens.llm import simhash
from profitlens.llm.components import connected_components
from profitlens.llm.simhash import block_masks, keep_one, links_within, near_duplicates
from llm_cases import SF


def fingerprint(text):
    words = re.findall(r"[^\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))
    if not words:
        return 0
    shingles = [" ".join(words[i:i + 3]) for i in range(len(words) - 2)] or [" ".join(words)]
    h = [xxhash.xxh64_intdigest(s.encode(), seed=42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(x >> b & 1 for x in h) > len(h))


def roots(nodes, linked):
    up = {n: n for n in nodes}

    def find(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in linked:
        a, b = find(a), find(b)
        up[max(a, b)] = min(a, b)
    return {n: find(n) for n in nodes}


def close(values, distance=3):
    return [(a, b) for i, a in enumerate(values) for b in values[:i] if (a ^ b).bit_count() <= distance]


def brute(rows):
    fps = {}
    for doc_id, text in rows:
        fps.setdefault(fingerprint(text), []).append(doc_id)
    root = roots(list(fps), close(list(fps)))
    least = {}
    for f, ids in fps.items():
        for i in ids:
            least[root[f]] = i if least.get(root[f]) is None else min(least[root[f]], i if i is not None else least[root[f]])
    return sorted(((i, f"{f:016x}", least[root[f]]) for f, ids in fps.items() for i in ids), key=str)


def test_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(r.doc_id, r.text) for r in docs.select("doc_id", "text").collect()]
    got = near_duplicates(docs)
    assert sorted(map(tuple, got.collect()), key=str) == brute(rows)
    kept = [r.doc_id for r in keep_one(docs).collect()]
    assert sorted(kept) == sorted({c for _, _, c in brute(rows)})


def test_odd_rows(odd, empty):
    rows = [(r.doc_id, r.text) for r in odd.select("doc_id", "text").collect()]
    got = sorted(map(tuple, near_duplicates(odd).collect()), key=str)
    assert got == brute(rows)
    one = keep_one(odd)
    assert one.columns == odd.columns
    assert sorted(str(r.doc_id) for r in one.collect()) == sorted({str(c) for _, _, c in brute(rows)})
    assert near_duplicates(empty).count() == 0 and keep_one(empty).count() == 0


def test_masks_cover_every_close_pair():
    masks = block_masks(3, list(range(64)), 6)
    assert len(masks) == 20
    rng = random.Random(3)
    for _ in range(500):
        flip = sum(1 << b for b in rng.sample(range(64), rng.randint(0, 3)))
        assert any(not flip & m for m in masks)


@pytest.mark.parametrize("hot", [4096, 10])
def test_links_connect_all_close_pairs(spark, monkeypatch, hot):
    """Clusters of fingerprints, once with every bucket searched at once, once dealt out again."""
    monkeypatch.setattr(simhash, "HOT_BUCKET", hot)
    rng, values = random.Random(7), set()
    for _ in range(6):
        base = rng.getrandbits(64)
        for _ in range(60):
            values.add(base)
            base ^= sum(1 << b for b in rng.sample(range(64), rng.randint(1, 4)))
    values = sorted(values)
    signed = {v: v - (1 << 64) if v >> 63 else v for v in values}
    df = spark.createDataFrame([(s,) for s in signed.values()], "fp long")
    got = [tuple(r) for r in links_within(df, 3).distinct().collect()]
    assert all(((a ^ b) & (1 << 64) - 1).bit_count() <= 3 for a, b in got)
    mask = (1 << 64) - 1
    assert roots(values, [(a & mask, b & mask) for a, b in got]) == roots(values, close(values))


def test_components(spark):
    rng = random.Random(2)
    edges = [(rng.randint(0, 300), rng.randint(0, 300)) for _ in range(170)] + [(i, i + 1) for i in range(400, 460)]
    got = {r.node: r.root for r in connected_components(spark.createDataFrame(edges, "a long, b long")).collect()}
    want = roots({n for a, b in edges if a != b for n in (a, b)}, [e for e in edges if e[0] != e[1]])
    assert got == want
    assert connected_components(spark.createDataFrame([(1, 1)], "a long, b long")).count() == 0


def test_groups_without_or_with_one_id_each_keep_a_document(spark):
    """Unrelated texts whose ids are null or repeated all stay; copies still go."""
    from profitlens.llm.simhash import keep_one

    text = lambda i: " ".join(f"w{i}x{j}" for j in range(40))
    rows = [(None, text(i)) for i in range(6)] + [(7, text(i)) for i in range(10, 14)] + [
        (None, text(0)), (7, text(10)), (3, text(20)), (4, text(20)), (None, text(20)), (None, None)]
    got = keep_one(spark.createDataFrame(rows, "doc_id long, text string")).collect()
    want = [(None, text(i)) for i in range(6)] + [(7, text(i)) for i in range(10, 14)] + [(3, text(20)), (None, None)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))
