"""URL filter: rules by host and path, and a tree of path templates for each host."""

from __future__ import annotations

import functools

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from profitlens.llm._common import join_on, staged

MAX_CHILDREN = 10   # a segment is variable if its place has more values than this
MIN_SUPPORT = 4     # and fewer pages for a value, in the mean, than this
ALIKE_Z = 1.96      # branches are alike if the 95 % interval of each one's allowed share holds the share of all of them
PRIOR = 4.0         # labels' worth of the parent's purity in a template's
MIN_PURITY = 0.35   # templates with a smaller share of allowed urls are rejected

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
PARTS = r"(?s)^.*?://([^/?#]*)([^?#]*)"


def host_of(url: Column) -> Column:
    """After the first ``://`` up to ``/``, ``?``, ``#`` or the end, A-Z lower-cased; empty for null or no ``://``."""
    return F.translate(F.coalesce(F.regexp_extract(url, PARTS, 1), F.lit("")), UPPER, LOWER)


def path_of(url: Column) -> Column:
    """What follows the host, up to ``?``, ``#`` or the end; empty for null or no ``://``."""
    return F.coalesce(F.regexp_extract(url, PARTS, 2), F.lit(""))


def first_rule(host: Column, path: Column, rules: list[tuple[str, str]]) -> tuple[Column, Column]:
    """(rule, its verdict) of the longest rule that fits, else nulls. rules: (verdict, host/path)."""
    rule, verdict = F.lit(None).cast("string"), F.lit(None).cast("string")
    for kind, text in sorted(rules, key=lambda r: len(r[1])):
        own, _, rest = text.partition("/")
        fits = ((host == own) | host.endswith("." + own)) & path.startswith("/" + rest)
        rule, verdict = F.when(fits, text).otherwise(rule), F.when(fits, kind).otherwise(verdict)
    return rule, verdict


def shape_of(path: Column) -> Column:
    """The path with what varies by its form generalised: long hexadecimal runs to {h}, runs of digits to {n}."""
    segments = F.filter(F.split(path, "/"), lambda s: s != "")
    return F.transform(segments, lambda s: F.regexp_replace(F.regexp_replace(
        s, r"(?i)[0-9a-f]{8}[0-9a-f-]{8,}", "{h}"), r"[0-9]+", "{n}"))


def _side() -> Column:
    """Where a branch lies beside its group (pa allowed of pa + pb): + or - if the Wilson interval of its allowed share
    (a of a + b) lies above or below the group's share, else =."""
    n, share, pool = F.col("a") + F.col("b"), F.col("a") / (F.col("a") + F.col("b")), F.col("pa") / (F.col("pa") + F.col("pb"))
    middle = share + ALIKE_Z**2 / (2 * n)
    reach = ALIKE_Z * F.sqrt(share * (1 - share) / n + ALIKE_Z**2 / (4 * n * n))
    there = pool * (1 + ALIKE_Z**2 / n)
    return (F.when((share > pool) & (middle - reach > there), "+")
            .when((share < pool) & (middle + reach < there), "-").otherwise("="))


def alike_branches(kids: DataFrame) -> DataFrame:
    """kids: labelled siblings (host, template, seg, a, b). Returns host, template, seg, the kind that a branch belongs to
    and the kind's number of members.

    Siblings start as one group. A group in which some branch's share differs from the group's is parted into the branches
    below, about and above it, until every group's branches are alike; a branch of few labels stays in the middle, since it
    can't be told from the group. A parted group has two parts or more, since not all
    shares can lie on one side of their mean; so this ends. Groups are compared by their sums: no sort, no window and no
    pairs of siblings."""
    of, settled = ["host", "template", "kind"], []
    cur = kids.select("host", "template", "seg", "a", "b", F.lit("~").alias("kind"))
    while True:
        pool = cur.groupBy(*of).agg(F.sum("a").alias("pa"), F.sum("b").alias("pb"), F.count("*").alias("members"))
        cur = join_on(cur, pool, of).withColumn("side", _side()).drop("pa", "pb")
        odd = cur.groupBy(*of).agg(F.max(F.col("side") != "=").alias("odd"))
        cur = staged(join_on(cur, odd, of), "url-kinds")
        settled.append(cur.where(~F.col("odd")).select("host", "template", "seg", "kind", "members"))
        cur = cur.where("odd").select("host", "template", "seg", "a", "b", F.concat("kind", "side").alias("kind"))
        if cur.isEmpty():
            return functools.reduce(DataFrame.unionByName, settled)


def _smoothed(parent: Column, a: str = "a", b: str = "b") -> Column:
    return (F.col(a) + PRIOR * parent) / (F.col(a) + F.col(b) + PRIOR)


def _shared_run(cur: DataFrame) -> DataFrame:
    """Move every row over the segments that all shapes of its place begin with: they have no siblings, so each becomes a
    node of its own with the place's labels. What all shapes share is what the smallest and the largest share."""
    place = ["host", "template"]
    rest = F.slice("shape", F.col("depth") + 1, F.greatest(F.size("shape"), F.lit(1)))
    runs = cur.withColumn("rest", rest).groupBy(*place).agg(
        F.min("rest").alias("lo"), F.max("rest").alias("hi"), F.sum("a").alias("pa"), F.sum("b").alias("pb"))
    same = F.array_position(F.zip_with("lo", "hi", lambda x, y: x.eqNullSafe(y)), False)
    runs = runs.select(*place, "pa", "pb", F.when(same > 0, F.slice("lo", F.lit(1), (same - 1).cast("int")))
                       .otherwise(F.col("lo")).alias("run"))
    return join_on(cur, runs, place).select(
        "host", "shape", "a", "b", "n", (F.col("depth") + F.size("run")).alias("depth"),
        F.aggregate("run", F.col("purity"), lambda p, s: _smoothed(p, "pa", "pb")).alias("purity"),
        F.concat("template", F.when(F.size("run") > 0, F.concat(F.lit("/"), F.array_join("run", "/")))
                 .otherwise("")).alias("template"))


def template_purity(pages: DataFrame) -> DataFrame:
    """pages: host, shape (array of segments), label (1 allowed, 0 blocked, null unknown). Returns a row for each
    (host, shape) with its template and purity, the smoothed share of allowed urls.

    Pages are counted by (host, shape) first, so the tree is built from counts. Level by level, a place with many rarely
    repeated values becomes the wildcard ``*``, and labelled siblings that are statistically alike become one branch
    (``~`` and the sides on which it lay), if two or more are of a kind; see ``alike_branches``. Siblings without labels
    have no share that could be compared: they stay apart and take their parent's purity. A node's purity is
    (allowed + PRIOR * purity of its parent) / (labels + PRIOR); a host's parent is the whole table, whose prior is one
    allowed and one blocked url. So a template without labels takes its parent's purity; a host without any is not held to
    be worse than one half. The tree is as deep as the paths, but a run of segments that all shapes of a place share is
    passed in one step: the steps grow with the forks along a path, not with its length."""
    label, place = F.col("label"), ["host", "template"]
    cur = pages.groupBy("host", "shape").agg(
        F.count("*").alias("n"), F.coalesce(F.sum(label), F.lit(0)).cast("long").alias("a"),
        F.coalesce(F.sum(1 - label), F.lit(0)).cast("long").alias("b"))
    cur = staged(cur, "url-shapes")
    whole = cur.agg(F.coalesce(F.sum("a"), F.lit(0)).alias("a"), F.coalesce(F.sum("b"), F.lit(0)).alias("b")).first()
    prior = (whole.a + 1.0) / (whole.a + whole.b + 2.0)
    hosts = cur.groupBy("host").agg(F.sum("a").alias("a"), F.sum("b").alias("b"))
    hosts = hosts.select("host", F.when(F.col("a") + F.col("b") > 0, _smoothed(F.lit(prior)))
                         .otherwise(F.lit(max(prior, 0.5))).alias("purity"))
    cur = join_on(cur, hosts, ["host"]).withColumns({"template": F.lit(""), "depth": F.lit(0)})
    cur, finished = staged(cur, "url-level"), []
    while True:
        cur = _shared_run(cur).withColumn("done", F.size("shape") <= F.col("depth"))
        cur = staged(cur.withColumn("seg", F.when(~F.col("done"), F.get("shape", F.col("depth"))).otherwise("")), "url-runs")
        finished.append(cur.where("done").select("host", "shape", "template", "purity"))
        if cur.where(~F.col("done")).isEmpty():
            return functools.reduce(DataFrame.unionByName, finished)
        kids = cur.groupBy(*place, "seg").agg(*[F.sum(c).alias(c) for c in "nab"], F.min("purity").alias("parent"))
        alls = kids.groupBy(*place).agg(F.count("*").alias("values"), F.sum("n").alias("pages"))
        wild = (F.col("values") > MAX_CHILDREN) & (F.col("pages") < MIN_SUPPORT * F.col("values"))
        kids = staged(join_on(kids, alls, place).where("seg != ''").withColumn("wild", wild), "url-kids")
        kinds = alike_branches(kids.where(~F.col("wild") & (F.col("a") + F.col("b") > 0)))
        token = F.when(F.col("wild"), "*").when(F.col("members") > 1, F.col("kind")).otherwise(F.col("seg"))
        kids = join_on(kids, kinds, [*place, "seg"], "left").select(*place, "seg", "a", "b", "parent", token.alias("token"))
        nodes = kids.groupBy(*place, "token").agg(F.sum("a").alias("a"), F.sum("b").alias("b"), F.min("parent").alias("parent"))
        nodes = nodes.select(*place, "token", _smoothed(F.col("parent")).alias("next"))
        step = join_on(kids.select(*place, "seg", "token"), nodes, [*place, "token"])
        cur = join_on(cur.where(~F.col("done")), step, [*place, "seg"])
        cur = staged(cur.select("host", "shape", "n", "a", "b", F.col("next").alias("purity"), (F.col("depth") + 1).alias("depth"),
                                F.concat("template", F.lit("/"), "token").alias("template")), "url-level")


def judge_urls(pages: DataFrame, rules: list[tuple[str, str]], id_col: str = "page_id", url_col: str = "url") -> DataFrame:
    """page_id, host, path, rule, verdict, template and purity for every row: the verdict of the longest rule that fits,
    else ``block`` if the purity of the url's template is below MIN_PURITY, else ``allow``. Urls that a rule fits are
    the labelled ones.

    Null urls, and those without ``://``, have an empty host and path and share one template. Repeated rows each get the
    verdict; null ids pass; no labelled url: purity 0.5, all allowed. Empty table: no rows. Other columns aren't read."""
    own = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).cast("string").alias("url"))
    own = own.select("page_id", host_of(F.col("url")).alias("host"), path_of(F.col("url")).alias("path"))
    rule, verdict = first_rule(F.col("host"), F.col("path"), rules)
    own = own.select("*", rule.alias("rule"), verdict.alias("ruled"), shape_of(F.col("path")).alias("shape"))
    own = staged(own.withColumn("label", F.when(F.col("ruled") == "allow", 1).when(F.col("ruled") == "block", 0)),
                 "url-pages")
    purity = template_purity(own)
    learned = F.when(F.col("purity") < MIN_PURITY, "block").otherwise("allow")
    return own.join(purity, ["host", "shape"]).select(
        "page_id", "host", "path", "rule", F.coalesce("ruled", learned).alias("verdict"), "template", "purity")
