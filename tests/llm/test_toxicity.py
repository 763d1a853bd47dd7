import random

import pytest

from profitlens.llm.queries import op6_toxicity
from profitlens.llm.toxicity import FEATURES, LexiconAutomaton, Scorer, edits_allowed, learn_toxicity, score_toxicity
from llm_cases import SF

SF1 = "/root/testdata/sf0.1"


def distance(a, b):
    row = list(range(len(b) + 1))
    for i, x in enumerate(a, 1):
        row, old = [i], row
        for j, y in enumerate(b, 1):
            row.append(min(row[-1] + 1, old[j] + 1, old[j - 1] + (x != y)))
    return row[-1]


def nearest(word, terms):
    found = []
    for t in terms:
        if t.endswith("*"):
            if word.startswith(t[:-1]):
                found.append((0, t))
        elif distance(word, t) <= edits_allowed(t):
            found.append((distance(word, t), t))
    return (min(found)[1], min(found)[0]) if found else None


@pytest.mark.parametrize("cache", [200_000, 3])
def test_automaton_against_edit_distance(monkeypatch, cache):
    from profitlens.llm import toxicity

    monkeypatch.setattr(toxicity, "CACHE", cache)
    rng = random.Random(4)
    terms = {t: 1.0 for t in ("loser", "losers", "moron", "scum", "pathetic", "disgusting", "réeux*", "aba", "ababab",
                              "bab*", "worthless", "idiot")}
    automaton = LexiconAutomaton(terms)
    words = list(t.strip("*") for t in terms) + ["", "a", "zzz", "réeuxment", "babylon", "l0ser", "looser", "disgustng"]
    for _ in range(1500):
        w = list(rng.choice(words))
        for _ in range(rng.randint(0, 3)):
            at = rng.randint(0, len(w))
            w[at:at + rng.randint(0, 1)] = rng.choice(["", "a", "b", "o", "s", "ss"])
        words.append("".join(w))
    for w in words:
        assert automaton.match(w) == nearest(w, terms), w


def test_context_separates_quotation_from_abuse():
    s = Scorer({"moron": 4.0, "idiot": 3.0})
    strength = FEATURES.index("strength")
    abuse = s.features("you moron you are an idiot")
    quoted = s.features('the word "moron" is an insult')
    typo = s.features("you morron")
    assert abuse[strength] > quoted[strength] > 0 and quoted[FEATURES.index("quoted")] > 0
    assert 0 < typo[strength] < s.features("you moron")[strength]
    assert abuse[FEATURES.index("crowd")] > 0 == s.features("you moron")[FEATURES.index("crowd")]
    assert s.features(None) == s.features("") == s.features("a clean text") == [0.0] * len(FEATURES)


def test_held_out_rows(spark):
    """On the table with enough labelled rows (some 3,200 to learn from, 800 held out)."""
    got = op6_toxicity(spark, SF1)
    labels = spark.read.parquet(f"{SF1}/labels.parquet")
    rows = got.join(labels, "doc_id").where("held_out").select("score", "predicted", "toxic").collect()
    toxic, clean = ([r for r in rows if r.toxic == k] for k in (1, 0))
    auc = sum((t.score > c.score) + 0.5 * (t.score == c.score) for t in toxic for c in clean) / len(toxic) / len(clean)
    assert auc > 0.95 and sum(r.predicted for r in clean) <= 0.01 * len(clean)
    assert got.count() == spark.read.parquet(f"{SF1}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == int(r.score >= 0.5) for r in got.collect())


def test_odd_rows(spark, odd, empty):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    labels = spark.read.parquet(f"{SF}/labels.parquet")
    model = learn_toxicity(docs, labels, lambda doc_id: doc_id >= 0)
    rows = score_toxicity(odd, ["doc_id"], "text", model).collect()
    assert len(rows) == odd.count() and all(0 <= r.score <= 1 for r in rows)
    assert score_toxicity(empty, ["doc_id"], "text", model).count() == 0
    nothing = learn_toxicity(docs, labels.limit(0), lambda doc_id: doc_id >= 0)
    assert nothing[0] == {} and {r.score for r in score_toxicity(odd, ["doc_id"], "text", nothing).collect()} == {0.5}
    odd_labels = spark.createDataFrame([(1, 1), (1, None), (None, 1), (2, 0), (77, 1), (9, 5)], "doc_id long, toxic int")
    learn_toxicity(odd, odd_labels, lambda doc_id: doc_id >= 0)


def test_learned_words_are_found_misspelled(spark):
    """Words stay in the lexicon beside their stems, so that held-out texts with a slip in the first letters score."""
    terms = {"worthless": "wothless", "pathetic": "pahetic", "idiot": "idot", "moron": "mron", "trash": "tash"}
    rng, plain = random.Random(3), [f"{a}{b}" for a in ("table", "river", "garden", "window") for b in ("", "s", "side")]
    text = lambda *more: " ".join([*rng.choices(plain, k=15), *more, *rng.choices(plain, k=15)])
    rows = [(i, text(list(terms)[i % 5]) if i < 100 else text(), int(i < 100)) for i in range(300)]
    known = spark.createDataFrame(rows, "doc_id long, text string, toxic int")
    model = learn_toxicity(known.drop("toxic"), known.drop("text"), lambda doc_id: doc_id >= 0)
    assert set(terms) <= set(model[0])
    new = [(1000 + i, text(slip)) for i, slip in enumerate(terms.values())] + [(2000 + i, text()) for i in range(5)]
    out = score_toxicity(spark.createDataFrame(new, "doc_id long, text string"), ["doc_id"], "text", model).collect()
    assert all((r.score > 0.5) == (r.doc_id < 2000) for r in out), out


def test_sample_is_bounded_though_an_id_repeats(spark):
    from profitlens.llm.quality_model import learn_quality, training_sample
    from profitlens.llm.toxicity import labelled_sample

    docs = spark.createDataFrame([(1, f"text {i}") for i in range(500)] + [(2, "b"), (2, None), (3, None), (None, "x")],
                                 "doc_id long, text string")
    labels = spark.createDataFrame([(1, 1, 1), (1, 1, 1), (2, 0, 0), (3, 0, 0), (None, 1, 1)], "doc_id long, toxic int, quality int")
    got = sorted((r.doc_id, r.toxic) for r in labelled_sample(docs, labels, lambda c: c.isNotNull()).collect())
    assert got == [(1, 1), (2, 0), (3, 0)]
    assert learn_quality(docs, labels, lambda c: c.isNotNull()) is not None
    assert len(training_sample(docs.withColumn("quality", docs.doc_id % 2), "doc_id", "text", "quality", 100)) == 100
