"""DuckDB SQL of the operators that SQL can express, over the whole tables."""

from __future__ import annotations

WORD = r"[^\x20\x09-\x0D]+"

# ---- op8: quality rules (limits as in production: over 10 documents and 5 % of a host's, half the words left)

QUALITY = rf"""
WITH d AS (
  SELECT row_number() OVER () AS r, doc_id, COALESCE(text, '') AS text, COALESCE(source, '') AS host FROM documents),
w AS (SELECT r, doc_id, host, text, regexp_extract_all(text, '{WORD}') AS words FROM d),
lines AS (
  SELECT r, host, text, line, regexp_extract_all(line, '{WORD}') AS ws
  FROM (SELECT r, host, text, unnest(string_split(text, chr(10))) AS line FROM d) t
  WHERE regexp_matches(line, '{WORD}')),
normal AS (
  SELECT r, host, text, line, len(ws) AS n, lower(regexp_replace(array_to_string(ws, ' '), '[0-9]', '0', 'g')) AS norm
  FROM lines),
dup AS (SELECT r, count(*) - count(DISTINCT line) AS n FROM normal GROUP BY r),
win AS (
  SELECT r, i, words[i] AS a, words[i + 1] AS b, words[i + 2] AS c
  FROM (SELECT r, words, unnest(range(1, len(words) - 1)) AS i FROM w) t),
twice AS (SELECT r, i, count(*) OVER (PARTITION BY r, a, b, c) AS k FROM win),
repeats AS (
  SELECT r, count(DISTINCT p) AS n FROM (
    SELECT r, unnest([i, i + 1, i + 2]) AS p FROM twice WHERE k > 1) t GROUP BY r),
hosts AS (SELECT host, count(DISTINCT text) AS texts FROM d GROUP BY host),
frequent AS (
  SELECT n.host, n.norm FROM normal n JOIN hosts h ON n.host = h.host GROUP BY n.host, n.norm, h.texts
  HAVING count(DISTINCT n.text) > 10 AND count(DISTINCT n.text) * 100 > h.texts * 5),
gone AS (
  SELECT n.r, sum(n.n) AS k FROM normal n JOIN frequent f ON n.host = f.host AND n.norm = f.norm GROUP BY n.r),
counts AS (
  SELECT w.doc_id, CAST(len(words) AS BIGINT) AS n_words,
         CAST(COALESCE(list_sum(list_transform(words, lambda x: length(x))), 0) AS BIGINT) AS word_chars,
         CAST(length(text) - length(regexp_replace(text, '[#*$%&|<>]', '', 'g')) AS BIGINT) AS n_symbols,
         CAST(COALESCE(dup.n, 0) AS BIGINT) AS n_dup_lines,
         CAST(COALESCE(repeats.n, 0) AS BIGINT) AS n_repeat_words,
         CAST(COALESCE(gone.k, 0) AS BIGINT) AS removed_words
  FROM w LEFT JOIN dup USING (r) LEFT JOIN repeats USING (r) LEFT JOIN gone USING (r)),
base AS (SELECT *, n_words < 50 OR 100 * n_repeat_words > 50 * n_words AS base_failed FROM counts)
SELECT doc_id, n_words, word_chars, n_symbols, n_dup_lines, n_repeat_words, base_failed, removed_words,
       NOT base_failed AND (n_words - removed_words) * 100 >= n_words * 50 AS kept
FROM base
"""

# ---- op1: mixing


def _level(i: int, levels: list[str], weight: str) -> str:
    """Budgets of one level: a child is full if what its siblings with smaller ratios of capacity to weight leave over,
    shared by weight among it and the others, reaches its capacity."""
    own, up = ", ".join(levels[:i + 1]), ", ".join(["root", *levels[:i]])
    by = f"PARTITION BY {up}"
    return f"""
n{i} AS (
  SELECT l.root, {', '.join('l.' + c for c in levels[:i + 1])}, sum(l.capacity)::BIGINT AS capacity,
         CAST({weight} AS BIGINT) AS weight
  FROM leaves l GROUP BY l.root, {', '.join('l.' + c for c in levels[:i + 1])}),
r{i} AS (SELECT n.*, p.budget, n.capacity / n.weight AS ratio FROM n{i} n JOIN b{i} p USING ({up})),
s{i} AS (
  SELECT *, COALESCE(sum(capacity) OVER ({by} ORDER BY ratio RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW), 0)
            - sum(capacity) OVER ({by}, ratio) AS lower_caps,
         sum(weight) OVER ({by} ORDER BY ratio DESC RANGE BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS open_weight
  FROM r{i}),
f{i} AS (SELECT *, capacity * open_weight <= greatest(budget - lower_caps, 0) * weight AS is_full FROM s{i}),
b{i + 1} AS (
  SELECT root, {own}, CASE WHEN is_full THEN capacity ELSE
         greatest(budget - COALESCE(sum(capacity) FILTER (WHERE is_full) OVER ({by}), 0), 0) * weight
         // sum(weight) FILTER (WHERE NOT is_full) OVER ({by}) END AS budget
  FROM f{i}),"""


def _case(col: str, table: dict[str, int], other: int) -> str:
    return f"CASE {col} " + " ".join(f"WHEN '{k}' THEN {v}" for k, v in table.items()) + f" ELSE {other} END"


def _mixing() -> str:
    levels = ["domain", "lang", "source"]
    domain = _case("domain", {"web": 40, "books": 30, "news": 20, "forum": 10}, 5)
    lang = _case("lang", {"en": 50, "de": 20, "fr": 20, "es": 10}, 5)
    return rf"""
WITH t AS (
  SELECT doc_id, regexp_extract(COALESCE(source, ''), '([0-9]{{1,9}})$', 1) AS number, COALESCE(lang, 'und') AS lang,
         COALESCE(source, 'unknown') AS source,
         CAST(len(regexp_extract_all(COALESCE(text, ''), '{WORD}')) AS BIGINT) AS tokens FROM documents),
docs AS (
  SELECT doc_id, CASE WHEN number = '' THEN 'other' ELSE ['web', 'news', 'books', 'forum'][CAST(number AS BIGINT) % 4 + 1]
         END AS domain, lang, source, tokens FROM t),
leaves AS (SELECT 0 AS root, domain, lang, source, sum(tokens)::BIGINT AS size, sum(tokens)::BIGINT * 3 AS capacity
           FROM docs GROUP BY domain, lang, source),
b0 AS (SELECT root, sum(capacity)::BIGINT // 3 * 50 // 100 AS budget FROM leaves GROUP BY root),
{_level(0, levels, domain)}{_level(1, levels, lang)}{_level(2, levels, '1')}
plan AS (SELECT domain, lang, source, CAST(budget // size AS INTEGER) AS whole, budget % size AS rest
         FROM leaves JOIN b3 USING (root, domain, lang, source) WHERE size > 0),
own AS (SELECT * FROM docs JOIN plan USING (domain, lang, source) WHERE tokens > 0),
whole AS (SELECT doc_id, domain, lang, source, tokens, CAST(unnest(range(0, whole)) AS INTEGER) AS epoch,
                 tokens AS take_tokens FROM own),
part AS (
  SELECT *, sum(tokens) OVER (PARTITION BY domain, lang, source
            ORDER BY md5('7:' || whole || ':' || COALESCE(CAST(doc_id AS VARCHAR), '')), doc_id, tokens
            ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) - tokens AS place FROM own)
SELECT doc_id, domain, lang, source, tokens, epoch, take_tokens FROM whole
UNION ALL
SELECT doc_id, domain, lang, source, tokens, whole AS epoch, CAST(least(tokens, rest - place) AS BIGINT) AS take_tokens
FROM part WHERE place < rest
"""


# ---- op5: URL templates

RULES = [("allow", "org/"), ("block", "example.org/es/"), ("block", "example.org/en/1"), ("allow", "com/fr/"),
         ("block", "com/de/")]
Z2 = "3.8416e0"


def _urls() -> str:
    rule, verdict = "", ""
    for kind, text in sorted(RULES, key=lambda r: -len(r[1])):
        host, rest = text.split("/", 1)
        fits = f"WHEN (host = '{host}' OR ends_with(host, '.{host}')) AND starts_with(path, '/{rest}') THEN "
        rule, verdict = rule + fits + f"'{text}' ", verdict + fits + f"'{kind}' "
    sql = rf"""
WITH RECURSIVE parts AS (
  SELECT page_id, translate(COALESCE(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 1), ''),
                            'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         COALESCE(regexp_extract(url, '(?s)^.*?://([^/?#]*)([^?#]*)', 2), '') AS path FROM pages),
ruled AS (
  SELECT *, CASE {rule}END AS rule, CASE {verdict}END AS ruled,
         list_transform(list_filter(string_split(path, '/'), lambda s: s <> ''), lambda s: regexp_replace(regexp_replace(
           s, '(?i)[0-9a-f]{{8}}[0-9a-f-]{{8,}}', '{{h}}', 'g'), '[0-9]+', '{{n}}', 'g')) AS segs FROM parts),
own AS (SELECT *, CASE WHEN len(segs) <= 4 THEN segs ELSE list_append(segs[1:3], '**') END AS shape FROM ruled),
shapes AS (
  SELECT host, shape, count(*) AS n, count(*) FILTER (WHERE ruled = 'allow') AS a,
         count(*) FILTER (WHERE ruled = 'block') AS b FROM own GROUP BY host, shape),
prior AS (SELECT (COALESCE(sum(a), 0) + 1e0) / (COALESCE(sum(a), 0) + COALESCE(sum(b), 0) + 2e0) AS p FROM shapes),
hosts AS (
  SELECT host, CASE WHEN sum(a) + sum(b) > 0 THEN (sum(a) + 4e0 * p) / (sum(a) + sum(b) + 4e0) ELSE greatest(p, 0.5e0)
         END AS purity FROM shapes, prior GROUP BY host, p),
t0 AS (SELECT s.*, h.purity, '' AS template FROM shapes s JOIN hosts h USING (host)),"""
    for i in range(4):
        sql += f"""
l{i} AS (SELECT *, COALESCE(shape[{i + 1}], '') AS seg FROM t{i}),
k{i} AS (SELECT host, template, seg, sum(n) AS n, sum(a) AS a, sum(b) AS b, min(purity) AS parent FROM l{i}
         GROUP BY host, template, seg),
w{i} AS (SELECT *, a + b AS m, a / (a + b) AS share FROM k{i}),
v{i} AS (
  SELECT *, vals > 10 AND pages < 4 * vals AS wild FROM (
    SELECT *, count(*) OVER p AS vals, sum(n) OVER p AS pages FROM w{i} WINDOW p AS (PARTITION BY host, template)) t),
c{i}(host, template, seg, a, b, kind, r) AS (
  SELECT host, template, seg, a, b, '~', 0 FROM v{i} WHERE seg <> '' AND NOT wild AND m > 0
  UNION ALL
  SELECT host, template, seg, a, b, kind || side, r + 1 FROM (
    SELECT *, max(CAST(side <> '=' AS INT)) OVER (PARTITION BY host, template, kind) AS odd FROM (
      SELECT *, CASE
        WHEN share > pool AND share + {Z2} / (2 * m) - 1.96e0 * sqrt(share * (1 - share) / m + {Z2} / (4 * m * m))
             > pool * (1 + {Z2} / m) THEN '+'
        WHEN share < pool AND share + {Z2} / (2 * m) + 1.96e0 * sqrt(share * (1 - share) / m + {Z2} / (4 * m * m))
             < pool * (1 + {Z2} / m) THEN '-' ELSE '=' END AS side FROM (
        SELECT *, a + b AS m, a / (a + b) AS share,
               sum(a) OVER (PARTITION BY host, template, kind) / sum(a + b) OVER (PARTITION BY host, template, kind) AS pool
        FROM c{i}) t1) t2) t3 WHERE odd = 1),
e{i} AS (
  SELECT *, count(*) OVER (PARTITION BY host, template, kind) AS members FROM (
    SELECT host, template, seg, arg_max(kind, r) AS kind FROM c{i} GROUP BY host, template, seg) t),
k2{i} AS (
  SELECT v.*, CASE WHEN v.seg = '' THEN '' WHEN wild THEN '*' WHEN members > 1 THEN kind ELSE v.seg END AS token
  FROM v{i} v LEFT JOIN e{i} e ON v.host = e.host AND v.template = e.template AND v.seg = e.seg),
g{i} AS (
  SELECT host, template, token, CASE WHEN token = '' THEN min(parent) ELSE
         (sum(a) + 4e0 * min(parent)) / (sum(a) + sum(b) + 4e0) END AS next FROM k2{i} GROUP BY host, template, token),
t{i + 1} AS (
  SELECT l.host, l.shape, l.n, l.a, l.b, g.next AS purity,
         CASE WHEN k.token = '' THEN l.template ELSE l.template || '/' || k.token END AS template
  FROM l{i} l JOIN k2{i} k USING (host, template, seg)
  JOIN g{i} g ON g.host = k.host AND g.template = k.template AND g.token = k.token),"""
    return sql + """
done AS (SELECT * FROM t4)
SELECT o.page_id, o.host, o.path, o.rule,
       COALESCE(o.ruled, CASE WHEN d.purity < 0.35e0 THEN 'block' ELSE 'allow' END) AS verdict, d.template, d.purity
FROM own o JOIN done d ON o.host = d.host AND o.shape = d.shape
"""

# ---- op12: benchmark decontamination (windows of 10 words, shorter items whole)

_LOWERED = "translate(COALESCE(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz')"
_WORDS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x60\x7B-\x7F]+')"

DECONTAMINATION = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_WORDS} AS w FROM documents),
b AS (SELECT COALESCE(CAST(item_id AS VARCHAR), '') AS item, {_WORDS} AS w FROM benchmark),
win AS (
  SELECT DISTINCT item, n, array_to_string(w[s + 1:s + n], ' ') AS win
  FROM (SELECT item, w, least(len(w), 10) AS n, unnest(range(len(w) - least(len(w), 10) + 1)) AS s
        FROM b WHERE len(w) > 0) t),
own AS (
  SELECT r, s, n, array_to_string(w[s + 1:s + n], ' ') AS win
  FROM (SELECT r, w, n, unnest(range(len(w) - n + 1)) AS s
        FROM d, (SELECT DISTINCT n FROM win) l WHERE len(w) >= n) t),
occ AS (SELECT r, s, n, item FROM own JOIN win USING (n, win)),
hit AS (SELECT r, count(DISTINCT p) AS k FROM (SELECT r, unnest(range(s, s + n)) AS p FROM occ) t GROUP BY r),
items AS (
  SELECT r, count(DISTINCT item) AS k, sha256(array_to_string(list_sort(list(DISTINCT item)), ',')) AS sha
  FROM occ GROUP BY r)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, CAST(COALESCE(hit.k, 0) AS BIGINT) AS n_hit,
       CAST(COALESCE(items.k, 0) AS BIGINT) AS n_items, COALESCE(items.sha, sha256('')) AS items_sha256,
       COALESCE(hit.k, 0) > 0 AS contaminated
FROM d LEFT JOIN hit USING (r) LEFT JOIN items USING (r)
"""

# ---- op13: ranked lexical search (10 best of each item)

_TERMS = rf"regexp_extract_all({_LOWERED}, '[^\x00-\x2F\x3A-\x40\x5B-\x60\x7B-\x7F]+')"

SEARCH = f"""
WITH d AS (SELECT row_number() OVER () AS r, doc_id, {_TERMS} AS w FROM documents),
tf AS (SELECT r, term, count(*) AS tf FROM (SELECT r, unnest(w) AS term FROM d) t GROUP BY r, term),
total AS (SELECT count(*) AS n, sum(len(w)) AS l FROM d WHERE len(w) > 0),
size AS (SELECT r, doc_id, CAST(25 + (75 * len(w) * n) // l AS BIGINT) AS m FROM d, total WHERE len(w) > 0),
weight AS (
  SELECT term, CAST(floor(1000 * ln((2 * any_value(n) + 2) / (2 * count(*) + 1))) AS BIGINT) AS w
  FROM tf, total GROUP BY term),
item AS (
  SELECT item_id, term, count(*) AS k FROM (SELECT item_id, unnest({_TERMS}) AS term FROM benchmark) t
  GROUP BY item_id, term),
scored AS (
  SELECT item_id, doc_id, r, CAST(sum(k * w * ((1000000000 * tf) // (1000 * tf + 8 * m))) AS BIGINT) AS score
  FROM item JOIN weight USING (term) JOIN tf USING (term) JOIN size USING (r) GROUP BY item_id, doc_id, r),
placed AS (
  SELECT *, row_number() OVER (PARTITION BY item_id ORDER BY score DESC, doc_id NULLS LAST, r) AS rank
  FROM scored WHERE score > 0)
SELECT item_id, CAST(rank AS INTEGER) AS rank, doc_id, score FROM placed WHERE rank <= 10
"""


ORACLE_SQL: dict[str, str] = {
    "op1_mixing": _mixing(),
    "op5_url_templates": _urls(),
    "op12_decontamination": DECONTAMINATION,
    "op13_search": SEARCH,
    "op8_quality_rules": QUALITY,
}
