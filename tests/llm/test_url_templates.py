import re

from pyspark.sql import functions as F

from profitlens.llm.queries import URL_RULES, op5_url_templates
from profitlens.llm.url_templates import MIN_PURITY, PRIOR, alike_branches, judge_urls
from llm_cases import SF01


def parts(url):
    if url is None or "://" not in url:
        return "", ""
    rest = url.split("://", 1)[1]
    host = re.match(r"[^/?#]*", rest)[0]
    return "".join(chr(ord(c) + 32) if "A" <= c <= "Z" else c for c in host), re.match(r"[^?#]*", rest[len(host):])[0]


def rule_of(host, path):
    fits = [(len(t), t, v) for v, t in URL_RULES
            if (host == t.split("/")[0] or host.endswith("." + t.split("/")[0])) and path.startswith(t[t.index("/"):])]
    return max(fits)[1:] if fits else (None, None)


def test_hosts_paths_and_rules(spark):
    urls = [None, "", "no scheme", "http://", "http://A.Example.ORG", "https://x.org/es/1?q#f", "http://example.org/es/9",
            "http://example.org/en/12/a", "http://example.org/en/21", "http://a.b.com/fr/x", "http://com/de/y?z",
            "http://notcom/de/", "http://xcom/de/", "http://É.com/de/1", "http://h.net?x=://y/z", "a://b://c/d",
            "http://x.org/line\nbreak?q", "http://u:p@x.com:80/de/1/2/3/4/5/6", "HTTP://Ü.Net/A/%20/"]
    df = spark.createDataFrame(list(enumerate(urls)), "page_id long, url string").withColumn("host", F.lit("clash"))
    got = {r.page_id: r for r in judge_urls(df, URL_RULES).collect()}
    assert len(got) == len(urls)
    for i, url in enumerate(urls):
        host, path = parts(url)
        rule, verdict = rule_of(host, path)
        assert (got[i].host, got[i].path, got[i].rule) == (host, path, rule)
        assert got[i].verdict == (verdict or got[i].verdict) and got[i].verdict in ("allow", "block")


def pages(spark, groups):
    rows, i = [], 0
    for url, n in groups:
        for _ in range(n):
            rows.append((i, url.format(i=i)))
            i += 1
    return spark.createDataFrame(rows, "page_id long, url string")


def test_templates_of_a_host(spark):
    """Digits, and segments of many rarely repeated values, become wildcards; purity comes from labelled urls."""
    df = pages(spark, [("http://h.com/de/{i}", 40), ("http://h.com/fr/{i}", 40), ("http://h.com/en/{i}", 5),
                       ("http://h.com/post/title-x{i}y/read", 1)])
    df = df.unionByName(spark.createDataFrame(
        [(1000 + k, f"http://h.com/post/{'abcdefghijklmnop'[k]}word/read") for k in range(16)], "page_id long, url string"))
    got = {(r.template, r.verdict, r.rule) for r in judge_urls(df, URL_RULES).collect()}
    assert ("/de/{n}", "block", "com/de/") in got and ("/fr/{n}", "allow", "com/fr/") in got
    assert ("/en/{n}", "allow", None) in got
    assert ("/post/*/read", "allow", None) in got


def test_purity_is_smoothed_and_blocks(spark):
    """A host whose labelled urls are nearly all blocked loses its unlabelled templates too; the figures are exact."""
    df = pages(spark, [("http://bad.com/de/{i}", 30), ("http://bad.com/shop", 3), ("http://good.org/a", 60)])
    rows = judge_urls(df, URL_RULES).collect()
    prior = 61 / 92
    host = PRIOR * prior / (30 + PRIOR)  # /shop has no labels of its own
    shop = [r for r in rows if r.path == "/shop"]
    assert {r.verdict for r in shop} == {"block"} and abs(shop[0].purity - host) < 1e-12 < MIN_PURITY
    assert {r.verdict for r in rows if r.host == "good.org"} == {"allow"}


def test_similar_branches_are_merged(spark):
    """Labelled siblings with about the same share become one branch; one that differs stays."""
    rules = [("allow", f"h.com/{x}/ok") for x in "abc"] + [("block", f"h.com/{x}/no") for x in "abc"] + [
        ("block", "h.com/z/")]
    df = pages(spark, [(f"http://h.com/{x}/{y}", n) for x in "abc" for y, n in (("ok", 20), ("no", 20))] + [
        ("http://h.com/z/no", 60)])
    got = {r.template for r in judge_urls(df, rules).collect()}
    assert any(t.startswith("/~") for t in got) and any(t.startswith("/z") for t in got)


def alike_by_hand(shares):
    """{name: (allowed, blocked)} parted until each group's members are alike."""
    from math import sqrt

    def side(a, b, pool):
        n, z = a + b, 1.96
        mid, reach = a / n + z * z / (2 * n), z * sqrt(a / n * (1 - a / n) / n + z * z / (4 * n * n))
        lo, hi = (mid - reach) / (1 + z * z / n), (mid + reach) / (1 + z * z / n)
        return 1 if a / n > pool and lo > pool else -1 if a / n < pool and hi < pool else 0

    groups, out = [dict(shares)], []
    while groups:
        g = groups.pop()
        pool = sum(a for a, _ in g.values()) / sum(a + b for a, b in g.values())
        parts = {s: {k: v for k, v in g.items() if side(*v, pool) == s} for s in (-1, 0, 1)}
        if parts[-1] or parts[1]:
            groups += [x for x in parts.values() if x]
        else:
            out.append(frozenset(g))
    return set(out)


def test_branches_are_merged_by_likeness(spark):
    """Siblings are parted until all of a group are alike, whatever side of one half they lie on."""
    shares = {"p0": (0, 1000), "p1": (0, 7), "p40": (400, 600), "p41": (410, 590), "p55": (550, 450), "p99": (990, 10),
              "all": (1000, 0), "few": (1, 1), "one": (1, 0)}
    rows = [("h", "", k, a, b) for k, (a, b) in shares.items()] + [("i", "", k, *shares["p40"]) for k in "xyz"]
    kids = spark.createDataFrame(rows, "host string, template string, seg string, a long, b long")
    got = {}
    for r in alike_branches(kids).collect():
        got.setdefault((r.host, r.kind), []).append(r)
    assert {frozenset(x.seg for x in v) for (h, _), v in got.items() if h == "h"} == alike_by_hand(shares)
    assert all(len(v) == x.members for v in got.values() for x in v)
    of = {x.seg: k for k, v in got.items() for x in v}
    assert of["p40"] == of["p41"] != of["p0"] and of["p55"] != of["all"]
    assert of["x"] == of["y"] == of["z"] == ("i", "~")
    assert alike_branches(kids.limit(0)).count() == 0


def test_a_branch_of_two_fifths_is_not_merged_with_a_blocked_one(spark):
    rules = [("allow", "h.com/a/ok"), ("block", "h.com/a/no"), ("block", "h.com/z/no")]
    df = pages(spark, [("http://h.com/a/ok", 400), ("http://h.com/a/no", 600), ("http://h.com/z/no", 1000),
                       ("http://h.com/a/else", 1), ("http://h.com/z/else", 1)])
    got = {r.path: (r.verdict, r.template) for r in judge_urls(df, rules).collect()}
    assert got["/a/else"] == ("allow", "/a/else") and got["/z/else"] == ("block", "/z/else")


def test_long_shared_runs_are_passed_at_once(spark):
    """Two urls that share a thousand segments need two levels; purity is that of a step for each segment."""
    run = "/".join(f"{chr(97 + i % 26)}" for i in range(1000))
    df = pages(spark, [(f"http://h.com/{run}/x", 3), (f"http://h.com/{run}/y", 2), (f"http://h.com/{run}", 1),
                       ("http://bad.com/de/p/q", 2), ("http://bad.com/de/p/r", 1)])
    got = {r.path: r for r in judge_urls(df, URL_RULES).collect()}
    assert got[f"/{run}/x"].template == f"/{run}/x" and got[f"/{run}"].template == f"/{run}"
    assert got[f"/{run}/x"].purity == 0.5
    p = 1 / 5  # nothing allowed, three blocked: the whole table, the host, /de, /p, then q and r, which are alike
    for labels in (3, 3, 3, 3):
        p = PRIOR * p / (labels + PRIOR)
    assert got["/de/p/q"].template == got["/de/p/r"].template == "/de/p/~"
    assert abs(got["/de/p/q"].purity - p) < 1e-12 and got["/de/p/r"].purity == got["/de/p/q"].purity


def test_whole_table(spark):
    df = spark.read.parquet(f"{SF01}/pages.parquet")
    got = op5_url_templates(spark, SF01).collect()
    urls = {r.page_id: r.url for r in df.select("page_id", "url").collect()}
    assert sorted(r.page_id for r in got) == sorted(urls)
    for r in got:
        host, path = parts(urls[r.page_id])
        rule, verdict = rule_of(host, path)
        assert (r.host, r.path, r.rule) == (host, path, rule) and (verdict is None or r.verdict == verdict)


def test_empty_table_and_repeated_rows(spark):
    df = spark.createDataFrame([(1, "http://a.com/de/1")] * 3 + [(None, "http://b.net/")], "page_id long, url string")
    got = judge_urls(df, URL_RULES).collect()
    assert len(got) == 4 and sum(r.verdict == "block" for r in got) == 3
    assert judge_urls(df.limit(0), URL_RULES).count() == 0


def test_deep_paths_are_judged_by_their_whole_template(spark):
    """What differs in the fifth segment is judged apart; a path of hundreds of segments keeps all of them."""
    rules = [("block", "h.com/a/b/c/spam/1"), ("allow", "h.com/a/b/c/news/1")]
    df = pages(spark, [("http://h.com/a/b/c/spam/1/x/y{i}", 40), ("http://h.com/a/b/c/news/1/x/y{i}", 40),
                       ("http://h.com/a/b/c/spam/2/x/y{i}", 5), ("http://h.com/a/b/c/news/2/x/y{i}", 5),
                       ("http://h.com/" + "/".join(["s"] * 300), 1)])
    rows = judge_urls(df, rules).collect()
    assert len(rows) == 91 and {r.verdict for r in rows if "/spam/" in r.path} == {"block"}
    assert {r.verdict for r in rows if "/news/" in r.path} == {"allow"}
    assert "/a/b/c/spam/{n}/x/y{n}" in {r.template for r in rows}
    assert "/" + "/".join(["s"] * 300) in {r.template for r in rows}
