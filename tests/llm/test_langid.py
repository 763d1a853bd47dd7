import numpy as np

from profitlens.llm.langid import DIMS, NgramSpace, learn_profiles, predict_language
from profitlens.llm.queries import op4_langid
from llm_cases import SF01


def test_held_out_accuracy(spark):
    got = op4_langid(spark, SF01)
    docs = spark.read.parquet(f"{SF01}/documents.parquet").select("doc_id", "lang", "text")
    rows = got.join(docs, "doc_id").where("held_out and lang_pred <> 'und'").collect()
    assert got.count() == docs.count()
    assert len(rows) > 200
    assert sum(r.lang_pred == r.lang for r in rows) >= 0.98 * len(rows)
    assert all(0 <= r.score <= 1 for r in rows)


def test_binding_permutes_and_multiplies():
    s = NgramSpace()
    codes = s.trigrams("ab")  # " ab", "ab "
    s.learn(codes)
    a, b, gap = s.letter(ord("a")), s.letter(ord("b")), s.letter(32)
    want = np.roll(gap, 2) * np.roll(a, 1) * b + np.roll(a, 2) * np.roll(b, 1) * gap
    assert len(codes) == 2 and (s.bundle(codes) == want).all()


def test_bundle_is_the_same_beyond_the_cache(monkeypatch):
    from profitlens.llm import langid

    text = "the quick brown fox jumps over the lazy dog " * 3
    s = NgramSpace()
    codes = s.trigrams(text)
    s.learn(codes)
    whole = s.bundle(codes)
    monkeypatch.setattr(langid, "CACHED_NGRAMS", 5)
    t = NgramSpace()
    t.learn(codes)
    assert len(t.codes) == 5 and (t.bundle(codes) == whole).all()


def test_odd_rows(odd):
    profiles = learn_profiles(odd, "text", "lang")
    assert set(profiles) <= {"en", "de", "fr"} and all(len(p) == DIMS for p in profiles.values())
    rows = predict_language(odd, ["doc_id"], "text", profiles).collect()
    assert len(rows) == odd.count()
    by = {r.doc_id: r for r in rows}
    assert [by[i].lang_pred for i in (3, 4, 5, 8)] == ["und"] * 4 and by[3].score == 0
    assert by[9].lang_pred == "de" and by[1].lang_pred == "en"


def test_nothing_learned_and_empty_tables(odd, empty):
    assert learn_profiles(empty, "text", "lang") == {}
    assert {r.lang_pred for r in predict_language(odd, ["doc_id"], "text", {}).collect()} == {"und"}
    assert predict_language(empty, ["doc_id"], "text", {}).count() == 0


def test_memory_of_a_task_is_small():
    """Thousands of different trigrams, long vectors: neither the table nor a batch's work takes tens of MB."""
    import random
    import tracemalloc

    rng = random.Random(3)
    texts = ["".join(chr(0x4E00 + rng.randrange(300)) for _ in range(20)) for _ in range(400)] + [None, "12"]
    s = NgramSpace(2048)
    tracemalloc.start()
    s.learn(np.concatenate([s.trigrams(t) for t in texts]))
    bundles = [s.bundle(s.trigrams(t)) for t in texts[:5]]
    peak = tracemalloc.get_traced_memory()[1]
    tracemalloc.stop()
    assert len(s.codes) > 6000 and peak < 16 << 20
    got = list(NgramSpace(2048).bundles(texts))
    assert got[-2:] == [None, None] and all((a == b).all() for a, b in zip(got, bundles))
