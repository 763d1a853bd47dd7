import re
from collections import Counter, defaultdict

from profitlens.llm.quality_rules import apply_line_rules, line_frequency_rules, repeated_words
from llm_cases import SF

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def norm(line):
    return re.sub(r"\d", "0", " ".join(WORD.findall(line)).lower())


def brute(rows, min_docs=10, share=5, left=50):
    """rows: (doc_id, text, host)"""
    have, texts = defaultdict(set), defaultdict(set)
    for _, text, host in rows:
        texts[host or ""].add(text or "")
        for line in (text or "").split("\n"):
            if WORD.search(line):
                have[host or "", norm(line)].add(text)
    bad = {k for k, v in have.items() if len(v) > min_docs and 100 * len(v) > share * len(texts[k[0]])}
    out = []
    for doc_id, text, host in rows:
        text = text or ""
        words, lines = WORD.findall(text), [x for x in text.split("\n") if WORD.search(x)]
        windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
        twice = Counter(windows)
        repeat = len({i + j for i, w in enumerate(windows) if twice[w] > 1 for j in range(3)})
        gone = sum(len(WORD.findall(x)) for x in lines if (host or "", norm(x)) in bad)
        failed = len(words) < 50 or 100 * repeat > 50 * len(words)
        out.append((doc_id, len(words), sum(map(len, words)), sum(c in "#*$%&|<>" for c in text),
                    len(lines) - len(set(lines)), repeat, failed, gone,
                    not failed and 100 * (len(words) - gone) >= left * len(words)))
    return sorted(out, key=str)


COLS = ["doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed", "removed_words",
        "kept"]


def check(df, **limits):
    rows = [tuple(r) for r in df.select("doc_id", "text", "source").collect()]
    names = {"min_docs": "min_docs", "max_share_pct": "share", "min_left_pct": "left"}
    got = sorted(map(tuple, line_frequency_rules(df, **limits).select(*COLS).collect()), key=str)
    assert got == brute(rows, **{names[k]: v for k, v in limits.items()})
    return got


def test_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    check(docs)
    got = check(docs.withColumn("source", docs.source.substr(1, 3)), min_docs=2, max_share_pct=1, min_left_pct=90)
    assert any(r[7] for r in got) and len({r[8] for r in got}) == 2


def boilerplate(spark):
    # digits are normalised away, so words differ by letters
    own = lambda i: " ".join(f"{chr(97 + i % 26)}{chr(97 + i // 26)}x{'y' * j}" for j in range(60))
    rows = [(i, "Share  THIS page 24 times\n" + own(i), "h") for i in range(30)]
    rows += [(100 + i, ("share this page 57 times\n" * 20) + own(200 + i)[:150], "h") for i in range(5)]
    rows += [(200 + i, own(500), "h") for i in range(40)]  # exact copies: one document
    return spark.createDataFrame(rows, "doc_id long, text string, source string")


def test_frequent_lines_go_and_depleted_documents_with_them(spark):
    df = boilerplate(spark)
    check(df)
    kept = {r.doc_id: r.text for r in apply_line_rules(df).collect()}
    assert set(kept) == {*range(30), *range(200, 240)}
    assert kept[3] == " ".join(f"dax{'y' * j}" for j in range(60))


def test_odd_rows(odd, empty):
    check(odd)
    check(odd, min_docs=0, max_share_pct=0)
    kept = apply_line_rules(odd)
    assert kept.columns == odd.columns
    assert sorted(str(r.doc_id) for r in kept.collect()) == sorted(
        str(r[0]) for r in brute([tuple(r) for r in odd.select("doc_id", "text", "source").collect()]) if r[8])
    assert line_frequency_rules(empty).count() == 0 and apply_line_rules(empty).count() == 0


def test_repeated_words():
    assert repeated_words("a b c a b c x".split()) == 6
    assert repeated_words("a a a a".split()) == 4
    assert repeated_words("a b c d".split()) == repeated_words([]) == repeated_words(["a"]) == 0


def test_rows_without_an_id_are_not_paired(spark):
    """Every row is decided by itself: no id, repeated ids, equal rows; as many rows are written as there are."""
    name = lambda i: "".join("abcdefghij"[int(c)] for c in str(i))
    good = [" ".join(f"w{name(i)}x{name(j)}" for j in range(60)) for i in range(300)]
    rows = [(None, t, "s") for t in good] + [(7, t, "s") for t in good[:40]] + [(None, "short", "s")] * 50
    rows += [(None, good[0], "s")] * 30
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string").repartition(4)
    kept = apply_line_rules(docs)
    assert sorted((r.doc_id or 0, r.text) for r in kept.collect()) == sorted(
        (r[0] or 0, r[1]) for r in rows if r[1] != "short")
    plan = kept._jdf.queryExecution().optimizedPlan().toString()
    assert "__row" in plan and "<=>" not in plan  # joined by the rows' own numbers
