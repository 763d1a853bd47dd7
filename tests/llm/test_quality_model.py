import numpy as np

from profitlens.llm.quality_model import BUCKETS, Subwords, learn_quality, score_quality
from profitlens.llm.queries import op9_quality_model
from llm_cases import SF, SF01


def test_features_are_those_of_the_words():
    s = Subwords()
    one = lambda text: np.concatenate(list(s.features(text)))
    a, b, both = one("alpha"), one("beta"), one("alpha  \n beta")
    assert sorted(both) == sorted([*a, *b])
    # the word, and the 3- and 4-grams of " alpha "
    assert len(a) == 1 + 5 + 4 and 0 <= a.min() <= a.max() < BUCKETS
    assert len(one("alpha alpha")) == 2 * len(a) + 1
    assert sorted(one("a " * 9)) == sorted(np.concatenate([np.tile(one("a"), 9), one("b b")[2:3].repeat(8)]))
    assert list(s.features(None)) == list(s.features(" \n ")) == []


def test_chunks_make_whole_texts(monkeypatch):
    from profitlens.llm import quality_model

    text = " ".join(f"w{i}" for i in range(500))
    whole = np.concatenate(list(Subwords().features(text)))
    monkeypatch.setattr(quality_model, "CHUNK_WORDS", 7)
    assert sorted(np.concatenate(list(Subwords().features(text)))) == sorted(whole)


def test_held_out_rows(spark):
    got = op9_quality_model(spark, SF01)
    labels = spark.read.parquet(f"{SF01}/labels.parquet")
    rows = got.join(labels, "doc_id").where("held_out").select("score", "predicted", "quality").collect()
    good, bad = ([r.score for r in rows if r.quality == k] for k in (1, 0))
    auc = sum((g > b) + 0.5 * (g == b) for g in good for b in bad) / len(good) / len(bad)
    assert auc > 0.85
    assert sum(r.predicted for r in rows if r.quality == 1) >= 0.95 * len(good)
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.3) for r in got.collect())
    assert got.count() == spark.read.parquet(f"{SF01}/documents.parquet").count()


def test_odd_rows(spark, odd, empty):
    docs, labels = (spark.read.parquet(f"{SF}/{t}.parquet") for t in ("documents", "labels"))
    model = learn_quality(docs, labels, lambda doc_id: doc_id >= 0, limit=40)
    rows = score_quality(odd, ["doc_id"], "text", model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    by = {r.doc_id: r.score for r in rows}
    assert by[3] == by[4] == by[5] and abs(by[1] - by[2]) < 1e-12
    assert score_quality(empty, ["doc_id"], "text", model).count() == 0
    assert learn_quality(docs, labels.limit(0), lambda doc_id: doc_id >= 0) is None
    assert {r.score for r in score_quality(odd, ["doc_id"], "text", None).collect()} == {0.5}
