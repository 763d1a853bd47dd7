import corpus_pipeline as pipeline
from profitlens.llm.mixing import mix_documents
from profitlens.llm.quality_rules import line_frequency_rules
from llm_cases import SF


def test_stages_one_after_another(spark):
    """Each stage on what its predecessor kept, against the brute-force versions of the operators."""
    import hashlib

    import test_quality_rules
    import test_simhash

    docs = spark.read.parquet(f"{SF}/documents.parquet")
    steps, cur = {}, docs
    for name, stage in pipeline.STAGES:
        cur = pipeline.staged(stage(spark, cur, SF), f"test-{name}")
        steps[name] = cur
        if name != "bpe":
            assert cur.columns == docs.columns and cur.dtypes == docs.dtypes
    ids = lambda df: {r.doc_id for r in df.select("doc_id").collect()}
    first = steps["language_id"]
    assert ids(first) == ids(docs)  # every document of the table has a language
    rows = [(r.doc_id, r.text, r.source) for r in first.collect()]
    assert ids(steps["quality_rules"]) == {r[0] for r in test_quality_rules.brute(rows) if r[8]}
    rows = [(r.doc_id, r.text) for r in steps["quality_rules"].collect()]
    assert ids(steps["simhash_dedup"]) == {c for _, _, c in test_simhash.brute(rows)}
    taken = mix_documents(steps["simhash_dedup"])
    assert steps["mixing"].count() == taken.count() and ids(steps["mixing"]) == ids(taken)
    texts = sorted((r.doc_id, hashlib.sha256(r.text.encode()).hexdigest()) for r in steps["mixing"].collect())
    assert sorted((r.doc_id, r.decoded_sha256) for r in steps["bpe"].collect()) == texts
    assert line_frequency_rules(first).count() == first.count()
    assert pipeline.run(spark, SF).count() == len(texts)


def test_stages_on_odd_and_empty_tables(spark, odd, empty):
    for docs in (odd, empty):
        cur = docs
        for name, stage in pipeline.STAGES:
            cur = pipeline.staged(stage(spark, cur, SF), f"test-{name}")
            if name != "bpe":
                assert cur.columns == docs.columns
    assert {r.doc_id for r in pipeline.language_id(spark, odd, SF).collect()} & {3, 4, 5, 8} == set()


def test_unlearned_scripts_go_and_known_texts_stay(spark):
    import random

    rng = random.Random(7)
    scripts = [(0x430, 32), (0x3B1, 24), (0x4E00, 3000), (0x627, 28), (0x5D0, 27)]  # Cyrillic, Greek, CJK, Arabic, Hebrew
    word = lambda first, n: "".join(chr(first + rng.randrange(n)) for _ in range(rng.randint(2, 8)))
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    rows = [(10**6 + 100 * i + j, " ".join(word(*s) for _ in range(200)), None, "x", 1)
            for i, s in enumerate(scripts) for j in range(20)]
    other = spark.createDataFrame(rows, docs.schema)
    kept = {r.doc_id for r in pipeline.language_id(spark, docs.unionByName(other), SF).select("doc_id").collect()}
    assert kept == {r.doc_id for r in docs.select("doc_id").collect()}
