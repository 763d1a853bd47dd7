import numpy as np
import pytest

from profitlens.llm.nn_descent import nearest

SF1 = "/root/testdata/sf0.1"


def exact(rows, k=20):
    """rows: {id: vector} -> {query: [(id, score)]} for ids divisible by 20."""
    ids = sorted(rows)
    x = np.array([rows[i] for i in ids], np.float64)
    out = {}
    for q in ids:
        if q % 20 == 0:
            s = x @ np.asarray(rows[q], np.float64)
            order = sorted((-s[j], i) for j, i in enumerate(ids) if i != q)[:k]
            out[q] = [(i, -v) for v, i in order]
    return out


def result(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r.rank)):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r.rank == len(out[r.query_id])
    return out


def recall(got, want):
    return np.mean([len({i for i, _ in got.get(q, [])} & {i for i, _ in w}) / max(1, len(w)) for q, w in want.items()])


def test_recall_and_scores(spark):
    from pyspark.sql import functions as F

    df = spark.read.parquet(f"{SF1}/embeddings.parquet")
    rows = {r.vec_id: r.embedding for r in df.collect()}
    got = result(nearest(df, F.col("vec_id") % 20 == 0))
    want = exact(rows)
    assert set(got) == set(want) and all(len(v) == 20 for v in got.values())
    assert recall(got, want) >= 0.9
    for q, found in got.items():
        assert found == sorted(found, key=lambda e: (-e[1], e[0])) and q not in dict(found)
        for i, s in found:
            assert s == pytest.approx(float(np.dot(np.float64(rows[i]), np.float64(rows[q]))), abs=1e-12)


def test_copies_lengths_and_bad_vectors(spark):
    from pyspark.sql import functions as F

    rng = np.random.default_rng(0)
    rows = {i: [float(v) for v in rng.standard_normal(4) * (1 + i % 7)] for i in range(200)}
    hot = [10.0, 20.0, 30.0, 40.0]  # longer than the others: its copies are nearest to each other
    rows |= {i: hot for i in range(200, 300)}
    bad = [(300, None), (301, [0.0] * 4), (302, [1.0, None, 0.0, 0.0]), (303, [float("nan")] * 4),
           (304, [float("inf"), 0.0, 0.0, 1.0]), (320, None), (340, [0.0] * 4), (None, hot), (360, []), (380, [1.0])]
    data = [*rows.items(), *bad, (200, hot), (200, hot)]
    df = spark.createDataFrame(data, "vec_id long, embedding array<float>").withColumn("node", F.lit("clash"))
    got = result(nearest(df, F.col("vec_id") % 20 == 0))
    rows = {i: [float(np.float32(v)) for v in x] for i, x in rows.items()}
    want = exact(rows)
    assert set(got) == set(want)
    assert all([i for i, _ in got[q]] == [i for i, _ in want[q]] for q in range(200, 300, 20))
    assert recall(got, want) >= 0.9


def test_few_rows_and_none(spark):
    from pyspark.sql import functions as F

    df = spark.createDataFrame([(20, [1.0, 0.0]), (3, [0.5, 0.5]), (4, [-1.0, 0.0])], "vec_id long, embedding array<float>")
    assert result(nearest(df, F.col("vec_id") % 20 == 0)) == {20: [(3, 0.5), (4, -1.0)]}
    assert nearest(df.limit(0), F.col("vec_id") % 20 == 0).count() == 0
    assert nearest(df.where("vec_id = 20"), F.col("vec_id") % 20 == 0).count() == 0


def test_heavy_tailed_lengths(spark):
    """One vector 10,000 times as long as the others, and some in between, leave the neighbours of all findable."""
    from pyspark.sql import functions as F

    rng = np.random.default_rng(5)
    v = rng.standard_normal((3000, 32))
    v /= np.linalg.norm(v, axis=1, keepdims=True)
    v[0] *= 10_000
    v[1:30] *= np.exp(rng.uniform(0, 6, 29))[:, None]
    df = spark.createDataFrame([(i, x.tolist()) for i, x in enumerate(v)], "vec_id long, embedding array<double>")
    got = {}
    for r in nearest(df, F.col("vec_id") % 60 == 31).collect():
        got.setdefault(r.query_id, set()).add(r.vec_id)
    sims = v @ v.T
    np.fill_diagonal(sims, -np.inf)
    found = [len(got[q] & set(np.argsort(-sims[q])[:20].tolist())) / 20 for q in range(31, 3000, 60)]
    assert len(got) == 50 and np.mean(found) > 0.85, np.mean(found)
