import hashlib
import re
from collections import defaultdict

from pyspark.sql import functions as F

from profitlens.llm import mixing
from profitlens.llm.mixing import apply_mix, mix, mix_documents, tree_budgets, water_fill
from llm_cases import SF


def fill(budget, kids):
    """kids: {name: (weight, capacity)} -> shares, by the definition: shortages go round among the siblings."""
    full = {k for k, (w, _) in kids.items() if w <= 0}
    while True:
        left = max(0, budget - sum(kids[k][1] for k in full if kids[k][0] > 0))
        total = sum(w for k, (w, _) in kids.items() if k not in full)
        more = {k for k, (w, c) in kids.items() if k not in full and c * total <= left * w}
        if not more:
            return {k: (0 if w <= 0 else c if k in full else left * w // total) for k, (w, c) in kids.items()}
        full |= more


def tree(budget, leaves, weights):
    """leaves: {path: capacity}; weights: path -> weight."""
    budgets = {(): budget}
    for i in range(len(next(iter(leaves)))):
        kids = defaultdict(dict)
        for path in {p[:i + 1] for p in leaves}:
            kids[path[:i]][path] = (weights(path), sum(c for p, c in leaves.items() if p[:i + 1] == path))
        budgets = {k: v for up, own in kids.items() for k, v in fill(budgets[up], own).items()}
    return budgets


def prefix(docs, sizes, budgets, seed=7):
    """docs: (doc_id, path, tokens) -> (doc_id, *path, tokens, epoch, take), reading epochs one after another."""
    out = []
    for path, size in sizes.items():
        left, epoch = budgets[path], 0
        while left > 0 and size:
            own = sorted(((hashlib.md5(f"{seed}:{epoch}:{'' if d is None else d}".encode()).hexdigest(), str(d), n, d)
                          for d, p, n in docs if p == path and n))
            for _, _, n, d in own:
                if left <= 0:
                    break
                out.append((d, *path, n, epoch, min(n, left)))
                left -= n
            epoch += 1
    return sorted(out, key=str)


def brute(rows, pct=50, epochs=3):
    docs, sizes = [], defaultdict(int)
    for doc_id, text, lang, source in rows:
        number = re.search(r"([0-9]{1,9})$", source or "")
        path = (mixing.DOMAINS[int(number[1]) % 4] if number else "other", lang or "und", source or "unknown")
        n = len(re.findall(r"[^\x20\x09-\x0D]+", text or ""))
        docs.append((doc_id, path, n))
        sizes[path] += n
    weights = lambda p: (mixing.DOMAIN_WEIGHTS, mixing.LANG_WEIGHTS, {})[len(p) - 1].get(
        p[-1], 1 if len(p) == 3 else mixing.OTHER_WEIGHT)
    budgets = tree(sum(sizes.values()) * pct // 100, {p: c * epochs for p, c in sizes.items()}, weights)
    return prefix(docs, sizes, budgets)


COLS = ["doc_id", "domain", "lang", "source", "tokens", "epoch", "take_tokens"]


def rows_of(df):
    return [tuple(r) for r in df.select("doc_id", "text", "lang", "source").collect()]


def test_against_brute_force(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = sorted(map(tuple, mix_documents(docs).select(*COLS).collect()), key=str)
    assert got == brute(rows_of(docs))
    assert {r[5] for r in got} >= {0, 1}


def test_budget_beyond_the_corpus(spark):
    docs = spark.read.parquet(f"{SF}/documents.parquet")
    got = sorted(map(tuple, mix_documents(docs, budget_pct=250).select(*COLS).collect()), key=str)
    assert got == brute(rows_of(docs), pct=250)


def test_shortages_go_to_siblings_before_ancestors(spark):
    leaves = {("a", "x"): 10, ("a", "y"): 1000, ("b", "x"): 1000, ("b", "y"): 1000}
    df = spark.createDataFrame([(*k, v) for k, v in leaves.items()], "l0 string, l1 string, capacity long")
    got = lambda total: {(r.l0, r.l1): r.budget for r in tree_budgets(
        df, ["l0", "l1"], [F.lit(1), F.lit(1)], F.lit(total)).collect()}
    # a.x gives 10 of its 50; a.y takes the rest, b gets no more than its weight
    assert got(200) == {("a", "x"): 10, ("a", "y"): 90, ("b", "x"): 50, ("b", "y"): 50}
    # a is used up: the shortage goes to b
    assert got(2500) == {("a", "x"): 10, ("a", "y"): 1000, ("b", "x"): 745, ("b", "y"): 745}
    assert got(2500) == tree(2500, leaves, lambda p: 1)


def test_water_fill_with_zero_weights_and_capacities(spark):
    kids = {"a": (0, 50), "b": (3, 0), "c": (1, 7), "d": (2, 100)}
    df = spark.createDataFrame([(0, 60, k, w, c) for k, (w, c) in kids.items()],
                               "p int, budget long, k string, weight long, capacity long")
    assert {r.k: r.share for r in water_fill(df, ["p"]).collect()} == fill(60, kids) == {"a": 0, "b": 0, "c": 7, "d": 53}


def test_odd_rows(odd, empty):
    got = sorted(map(tuple, mix_documents(odd).select(*COLS).collect()), key=str)
    assert got == brute(rows_of(odd))
    mixed = apply_mix(odd)
    assert mixed.columns == odd.columns
    count = lambda t: len(re.findall(r"[^\x20\x09-\x0D]+", t))
    cut = {r[0] for r in got if r[6] < r[4]}
    for r in mixed.collect():
        assert r.n_chars == len(r.text)
        assert r.doc_id in cut or count(r.text) in {g[4] for g in got if g[0] == r.doc_id}
    assert sum(count(r.text) for r in mixed.select("text").collect()) >= sum({(g[0], g[5]): g[6] for g in got}.values())
    assert mix_documents(empty).count() == 0 and apply_mix(empty).count() == 0


def test_one_leaf_takes_whole_epochs_and_a_prefix(spark):
    docs = spark.createDataFrame([(i, "s", i % 5) for i in range(100)], "doc_id long, s string, tokens long")
    rows = mix(docs, ["s"], [F.lit(1)], F.lit(450), max_epochs=3).collect()
    assert sum(r.take_tokens for r in rows) == 450
    by = defaultdict(int)
    for r in rows:
        by[r.epoch] += r.take_tokens
    assert dict(by) == {0: 200, 1: 200, 2: 50}
    assert sum(r.take_tokens < r.tokens for r in rows) <= 1


def test_rows_without_an_id_keep_the_budget(spark):
    """Different texts of as many words without an id, and equal rows: the mix and its documents have the same tokens."""
    from profitlens.llm.mixing import apply_mix, mix_documents

    rows = [(None, " ".join(f"w{i}_{j}" for j in range(100)), "en", "src1") for i in range(200)]
    rows += [(5, " ".join(f"v{j}" for j in range(100)), "en", "src1")] * 100
    rows += [(i, f"a b {i}", "de", "src2") for i in range(30)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, lang string, source string").repartition(3)
    want = mix_documents(docs).agg({"take_tokens": "sum", "doc_id": "count"}).first()["sum(take_tokens)"]
    got = apply_mix(docs).collect()
    assert sum(len(r.text.split()) for r in got) == want and len(got) == mix_documents(docs).count()
