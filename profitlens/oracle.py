"""DuckDB oracle: for every registered query, an equivalent SQL text over the
driver's pre-registered tables.

The facts are derived by the same binding rules as ``sources/testdata.py``
(written here independently in SQL). Money is DECIMAL in the CTEs and leaves
as DOUBLE; ratios are DOUBLE quotients with explicit zero-division CASEs.
Double -> DECIMAL conversions go through the shortest decimal text, which is
how Spark casts a double to a decimal.
"""

from __future__ import annotations

from collections.abc import Sequence

# The white space characters below U+3001.
WHITESPACE = "".join(map(chr, (9, 10, 11, 12, 13, 28, 29, 30, 31, 32, 133, 160, 5760, *range(8192, 8203), 8232, 8233,
                               8239, 8287, 12288)))
SENT = "'__UNALLOCATED__'"
MODULE_NAMES = {"0": "新鲜食材", "1": "美食", "2": "粮油", "3": "日化", "4": "百货"}
OI_EXCLUDE = "装卸|搬运"
DISABLED = "删除禁用"
FRESH = "新鲜食材|美食"
MODULES = ("1", "2", "3")
DAYS = 31


def _q(s: str) -> str:
    return "'" + s.replace("'", "''") + "'"


def _in(vals: Sequence[str]) -> str:
    return "(" + ", ".join(_q(v) for v in vals) + ")"


def _module_id(brand: str) -> str:
    return f"CAST(TRY_CAST(split_part({brand}, '#', 2) AS INTEGER) % 5 AS VARCHAR)"


def _module_name(brand: str) -> str:
    whens = " ".join(f"WHEN {_q(k)} THEN {_q(v)}" for k, v in MODULE_NAMES.items())
    return f"CASE {_module_id(brand)} {whens} END"


def _d(c: str, alias: str | None = None) -> str:
    return f"CAST({c} AS DOUBLE) AS {alias or c}"


def _ratio(n: str, d: str, mode: str = "inf_to_zero", fill: float | None = None) -> str:
    nd, dd = f"CAST({n} AS DOUBLE)", f"CAST({d} AS DOUBLE)"
    if mode == "inf_to_zero":
        r = (f"(CASE WHEN ({n}) IS NULL OR ({d}) IS NULL THEN NULL WHEN {dd} <> 0 THEN {nd} / {dd} "
             f"WHEN {nd} <> 0 THEN 0.0 ELSE NULL END)")
    else:
        r = f"(CASE WHEN {dd} <> 0 THEN {nd} / {dd} ELSE NULL END)"
    if fill is not None:
        r = f"COALESCE({r}, {float(fill)})"
    return r


def _round2(c: str) -> str:
    """Half-even to cents of the printed value, as DOUBLE."""
    return f"CAST(round_even(CAST(CAST({c} AS VARCHAR) AS DECIMAL(38,10)), 2) AS DOUBLE)"


def _not_match(c: str, pat: str) -> str:
    return f"NOT COALESCE(regexp_matches({c}, {_q(pat)}), FALSE)"


def _match(c: str, pat: str) -> str:
    return f"COALESCE(regexp_matches({c}, {_q(pat)}), FALSE)"


def _dec_text(expr: str, t: str) -> str:
    return f"CAST(CAST({expr} AS VARCHAR) AS {t})"


def _nn(cols: Sequence[str], alias: str = "") -> str:
    a = f"{alias}." if alias else ""
    return " AND ".join(f"{a}{c} IS NOT NULL" for c in cols) if cols else "TRUE"


def _uniq(cols):
    out = []
    for c in cols:
        if c not in out:
            out.append(c)
    return out


NS = "CAST(price * (1 - CAST(l_discount AS DECIMAL(4,2))) AS DECIMAL(18,4))"
COST = "CAST(price * 0.97 AS DECIMAL(18,4))"
CODES = ("p_brand AS category_id, CAST(c_nationkey AS VARCHAR) AS store_id, o_orderpriority AS channel, "
         "CAST(l_partkey AS VARCHAR) AS sku_id, p_name AS sku_name, CAST(l_suppkey AS VARCHAR) AS supplier_id, "
         "s_name AS supplier_name")

BINDING = f"""
lb AS (
  SELECT l.l_partkey, l.l_suppkey, l.l_linenumber, l.l_quantity, l.l_discount, l.l_tax,
         l.l_returnflag, l.l_linestatus, l.l_shipdate, o.o_orderpriority, c.c_nationkey, c.c_mktsegment,
         p.p_name, p.p_brand, p.p_retailprice, p.p_size, s.s_name,
         CAST(l.l_extendedprice AS DECIMAL(18,2)) AS price
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN part p ON l.l_partkey = p.p_partkey
  LEFT JOIN supplier s ON l.l_suppkey = s.s_suppkey
),
sales AS (
  SELECT {CODES}, CAST(l_shipdate AS DATE) AS biz_date,
         {NS} AS net_sales, {COST} AS cost,
         CAST(l_quantity AS DECIMAL(18,4)) AS qty,
         CAST({NS} - {COST} AS DECIMAL(18,4)) AS gross_margin,
         CAST(price * CAST(l_discount AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS discount_net,
         CAST(price * 0.01 AS DECIMAL(18,4)) AS price_comp,
         CAST(CAST(l_quantity AS DECIMAL(18,2)) * 0.10 AS DECIMAL(18,4)) AS shrink,
         CAST(1 AS DECIMAL(18,4)) AS footfall,
         CAST(price AS DECIMAL(18,4)) AS net_sales_pre_discount,
         CAST({NS} - {COST} AS DECIMAL(18,4)) AS system_margin
  FROM lb WHERE l_returnflag <> 'A' AND p_brand <> 'Brand#25' AND l_suppkey % 10 <> 3
),
coupon AS (
  SELECT {CODES}, CAST(l_shipdate AS DATE) AS biz_date,
         {_module_name('p_brand')} AS department,
         c_mktsegment AS coupon_type_id, 'coupon ' || lower(c_mktsegment) AS coupon_type_name,
         CAST(price * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,4)) AS coupon_cost,
         CAST(CAST(price * CAST(l_tax AS DECIMAL(4,2)) AS DECIMAL(18,4)) + CAST(price * 0.01 AS DECIMAL(18,4))
              + CAST(price * 0.02 AS DECIMAL(18,4)) AS DECIMAL(18,4)) AS coupon_total,
         CAST(price * 0.01 AS DECIMAL(18,4)) AS coupon_supplier_borne,
         CAST(price * 0.02 AS DECIMAL(18,4)) AS coupon_platform_borne
  FROM lb WHERE (l_linestatus = 'F' AND l_returnflag IN ('N', 'A'))
     OR (l_returnflag = 'R' AND (p_brand = 'Brand#25' OR l_suppkey % 10 = 3))
),
oi AS (
  SELECT CAST(l_suppkey AS VARCHAR) AS supplier_id, s_name AS supplier_name, p_brand AS category_id,
         CAST(c_nationkey AS VARCHAR) AS store_id,
         CASE WHEN l_linenumber = 1 THEN '装卸费' WHEN l_linenumber = 2 THEN '搬运费' ELSE '返利' END AS deduction_type,
         CAST(price * 0.02 AS DECIMAL(18,4)) AS oi_amount
  FROM lb WHERE l_returnflag = 'A'
),
stock AS (
  SELECT p_brand AS category_id, CAST(c_nationkey AS VARCHAR) AS store_id, CAST(l_partkey AS VARCHAR) AS sku_id,
         p_name AS sku_name, CAST(price * 0.6 AS DECIMAL(18,4)) AS own_cost,
         CAST(p_size AS DECIMAL(18,4)) AS stock_qty,
         CAST(CAST(p_retailprice AS DECIMAL(18,2)) * p_size AS DECIMAL(18,4)) AS stock_value
  FROM lb WHERE l_linestatus = 'O'
),
coupon_type AS (
  SELECT CAST(c_nationkey AS VARCHAR) AS store_id, c_mktsegment AS coupon_type_id,
         lower(c_mktsegment) AS coupon_type_name,
         {NS} AS net_sales_issued,
         CAST({NS} - CAST(price * 0.97 AS DECIMAL(18,4)) AS DECIMAL(18,4)) AS margin_issued,
         CASE WHEN l_linenumber % 2 = 1 THEN {NS} ELSE CAST(0 AS DECIMAL(18,4)) END AS net_sales_redeemed,
         CASE WHEN l_linenumber % 2 = 1 THEN CAST({NS} - CAST(price * 0.97 AS DECIMAL(18,4)) AS DECIMAL(18,4))
              ELSE CAST(0 AS DECIMAL(18,4)) END AS margin_redeemed,
         CAST(price * 0.01 AS DECIMAL(18,4)) AS comp_net_alloc,
         CAST(price * 0.02 AS DECIMAL(18,4)) AS promo_comp_alloc
  FROM lb WHERE l_returnflag = 'R' AND c_mktsegment <> 'BUILDING'
),
category AS (
  SELECT {_module_id('category_id')} AS module_id, {_module_name('category_id')} AS module_name, category_id,
         CASE WHEN category_id = 'Brand#24' THEN category_id || '{DISABLED}'
              WHEN category_id = 'Brand#13' THEN '{DISABLED}' ELSE category_id END AS category_name
  FROM (SELECT DISTINCT p_brand AS category_id FROM part) b
),
store AS (
  SELECT CAST(n.n_nationkey AS VARCHAR) AS store_id, r.r_name AS store_format, n.n_name AS store_name
  FROM nation n LEFT JOIN region r ON n.n_regionkey = r.r_regionkey
),
oi_in AS (SELECT * FROM oi WHERE {_not_match('deduction_type', OI_EXCLUDE)})
"""


def _sql(ctes: str, select: str) -> str:
    body = "WITH " + BINDING.strip()
    if ctes.strip():
        body += ",\n" + ctes.strip().rstrip(",")
    return body + "\n" + select.strip()


def _rollup(src: str, keys: Sequence[str], measures: Sequence[str], where: str = "TRUE") -> str:
    ks = ", ".join(keys)
    ms = ", ".join(f"COALESCE(SUM({m}), 0) AS {m}" for m in measures)
    return f"SELECT {ks}, {ms} FROM {src} WHERE {_nn(keys)} AND ({where}) GROUP BY {ks}"


def _combine(frames: Sequence[tuple[str, Sequence[str]]], keys: Sequence[str],
             keep: Sequence[str] | None = None) -> str:
    """Outer joins of the facts' rollups on ``keys``, measures filled with 0. With
    ``keep``, facts that are not named in it are left-joined to the first one; the
    others are fully joined after them."""
    first, *rest = frames
    rest = sorted(rest, key=lambda f: keep is not None and f[0] in keep)  # left joins first
    out = _fact(*first, keys)
    for name, ms in rest:
        how = "FULL" if keep is None or name in keep else "LEFT"
        out = f"(SELECT * FROM {out} a_{name} {how} JOIN {_fact(name, ms, keys)} b_{name} USING ({', '.join(keys)}))"
    ms = ", ".join(f"COALESCE({m}, 0) AS {m}" for _, own in frames for m in own)
    return f"SELECT {', '.join(keys)}, {ms} FROM {out} z"


def _fact(name: str, measures: Sequence[str], keys: Sequence[str]) -> str:
    ks = ", ".join(keys)
    ms = ", ".join(f"COALESCE(SUM(CAST({m} AS DECIMAL(38,12))), 0) AS {m}" for m in measures)
    return f"(SELECT {ks}, {ms} FROM {name} WHERE {_nn(keys)} GROUP BY {ks})"


def _margin_measures() -> str:
    return (f"{_ratio('gross_margin', 'net_sales', fill=0)} AS margin_rate, "
            f"{_ratio('coupon_cost', 'net_sales', fill=0)} AS coupon_rate, "
            f"CAST(gross_margin - coupon_cost AS DOUBLE) AS post_coupon_margin, "
            f"{_ratio('gross_margin - coupon_cost', 'net_sales')} AS post_coupon_margin_rate")


def _doubles(cols: Sequence[str]) -> str:
    return ", ".join(_d(c) for c in cols)


# ------------------------------------------------------------------ allocation

def _pool(name: str, src: str, keys: Sequence[str], amt: str) -> str:
    ks = ", ".join(keys)
    return (f"{name} AS (SELECT {ks}, CAST(COALESCE(SUM({amt}), 0) AS DECIMAL(28,4)) AS {amt} "
            f"FROM {src} WHERE {_nn(keys)} GROUP BY {ks}),")


def _alloc(p: str, lines: str, pool: str, keys: Sequence[str], grain: Sequence[str], w: str, amt: str) -> str:
    cols = _uniq(list(keys) + list(grain))
    cs, ks = ", ".join(cols), ", ".join(keys)
    on_b = " AND ".join(f"l.{k} = b.{k}" for k in keys)
    on_p = " AND ".join(f"l.{k} = pl.{k}" for k in keys)
    on_r = " AND ".join(f"b.{k} = pl.{k}" for k in keys)
    share = f"CAST(l.{w} AS DOUBLE) / CAST(b._base AS DOUBLE)"
    return f"""
{p}_lw AS (SELECT {cs}, COALESCE(SUM({w}), 0) AS {w} FROM {lines} WHERE {_nn(cols)} GROUP BY {cs}),
{p}_base AS (SELECT {ks}, SUM({w}) AS _base FROM {p}_lw GROUP BY {ks} HAVING SUM({w}) >= 0.01),
{p}_raw AS (
  SELECT {', '.join('l.' + c for c in cols)}, l.{w} AS {w},
         {_dec_text(share, 'DECIMAL(24,12)')} AS alloc_share,
         CAST(pl.{amt} AS DECIMAL(18,4)) AS pool_amount,
         {_dec_text(share + f' * CAST(pl.{amt} AS DOUBLE)', 'DECIMAL(18,4)')} AS alloc_amount
  FROM {p}_lw l JOIN {p}_base b ON {on_b} JOIN {pool} pl ON {on_p}),
{p}_ranked AS (
  SELECT r.*, SUM(alloc_amount) OVER (PARTITION BY {ks}) AS _sum,
         row_number() OVER (PARTITION BY {ks} ORDER BY abs({w}) DESC{''.join(f', {c} DESC' for c in cols if c not in keys)}) AS _rn
  FROM {p}_raw r),
{p}_alloc AS (
  SELECT {cs}, {w}, alloc_share, pool_amount,
         CASE WHEN _rn = 1 THEN CAST(alloc_amount + pool_amount - _sum AS DECIMAL(18,4)) ELSE alloc_amount END AS alloc_amount
  FROM {p}_ranked),
{p}_resid AS (SELECT pl.* FROM {pool} pl WHERE NOT EXISTS (SELECT 1 FROM {p}_base b WHERE {on_r})),
"""


def _waterfall(p: str, lines: str, pool_src: str, levels: Sequence[tuple[Sequence[str], Sequence[str]]],
               amt: str, w: str = "net_sales", scope: str | None = None) -> str:
    """CTEs ``{p}_out`` (allocated rows) and ``{p}_unalloc`` (out-of-scope residual)."""
    out_cols = _uniq([c for k, g in levels for c in list(k) + list(g)])
    s = _pool(f"{p}_pool1", pool_src, levels[0][0], amt)
    for i, (keys, grain) in enumerate(levels, start=1):
        s += _alloc(f"{p}_l{i}", lines, f"{p}_pool{i}", keys, grain, w, amt)
        resid = f"{p}_l{i}_resid"
        if i == 1 and scope is not None:
            s += (f"{p}_unalloc AS (SELECT * FROM {resid} WHERE category_id NOT IN (SELECT category_id FROM {scope})),"
                  f"\n{p}_scoped AS (SELECT * FROM {resid} WHERE category_id IN (SELECT category_id FROM {scope})),\n")
            resid = f"{p}_scoped"
        elif i == 1:
            s += f"{p}_unalloc AS (SELECT * FROM {resid} WHERE FALSE),\n"
        if i < len(levels):
            s += _pool(f"{p}_pool{i + 1}", resid, levels[i][0], amt) + "\n"
        else:
            s += f"{p}_final AS (SELECT * FROM {resid}),\n"
    parts = []
    for i, (keys, grain) in enumerate(levels, start=1):
        have = set(keys) | set(grain)
        sel = ", ".join(c if c in have else f"{SENT} AS {c}" for c in out_cols)
        parts.append(f"SELECT {sel}, alloc_share, alloc_amount, {i} AS alloc_level FROM {p}_l{i}_alloc")
    have = set(levels[-1][0])
    sel = ", ".join(c if c in have else f"{SENT} AS {c}" for c in out_cols)
    parts.append(f"SELECT {sel}, CAST(NULL AS DECIMAL(24,12)) AS alloc_share, "
                 f"CAST({amt} AS DECIMAL(18,4)) AS alloc_amount, {len(levels) + 1} AS alloc_level FROM {p}_final")
    s += f"{p}_out AS ({' UNION ALL '.join(parts)}),\n"
    return s


def _realloc(p: str, lines: str, pool_src: str, keys: Sequence[str], grain: Sequence[str], w: str, amt: str,
             residual_share: float | None = None) -> str:
    """CTE ``{p}_out``: one-level allocation, residual kept whole on the sentinel grain."""
    out_cols = _uniq(list(keys) + list(grain))
    s = _pool(f"{p}_pool", pool_src, keys, amt) + _alloc(f"{p}_a", lines, f"{p}_pool", keys, grain, w, amt)
    sel = ", ".join(c if c in keys else f"{SENT} AS {c}" for c in out_cols)
    rs = "NULL" if residual_share is None else f"CAST({residual_share} AS DECIMAL(24,12))"
    s += (f"{p}_out AS (SELECT {', '.join(out_cols)}, CAST({w} AS DECIMAL(28,4)) AS {w}, alloc_share, pool_amount, "
          f"alloc_amount FROM {p}_a_alloc UNION ALL SELECT {sel}, CAST(NULL AS DECIMAL(28,4)) AS {w}, "
          f"CAST({rs} AS DECIMAL(24,12)) AS alloc_share, CAST({amt} AS DECIMAL(18,4)) AS pool_amount, "
          f"CAST({amt} AS DECIMAL(18,4)) AS alloc_amount FROM {p}_a_resid),\n")
    return s


def _active(name: str, modules: Sequence[str] | None = None, pattern: str | None = None) -> str:
    cond = _not_match("category_name", DISABLED)
    if modules is not None:
        cond += f" AND module_id IN {_in(modules)}"
    if pattern is not None:
        cond += f" AND {_match('module_name', pattern)}"
    return f"{name} AS (SELECT DISTINCT category_id FROM category WHERE {cond}),\n"


SALES_M = ["net_sales", "cost", "qty", "gross_margin", "discount_net", "price_comp", "shrink"]
SKU_KEYS = ["category_id", "store_id", "channel", "sku_id"]
SC_KEYS = ["category_id", "store_id", "channel"]
MARGIN_OUT = ["margin_rate", "coupon_rate", "post_coupon_margin", "post_coupon_margin_rate"]


def _margin_select(src: str, keys: Sequence[str], money: Sequence[str]) -> str:
    return f"SELECT {', '.join(keys)}, {_doubles(money)}, {_margin_measures()} FROM {src}"


# ------------------------------------------------------------------ building blocks shared by queries

ALC05 = (_active("scope05", modules=MODULES)
         + "lines05 AS (SELECT supplier_id, category_id, store_id, channel, sku_id, net_sales FROM sales),\n"
         + _waterfall("w05", "lines05", "oi_in",
                      [(["supplier_id", "category_id", "store_id"], ["channel", "sku_id"]),
                       (["category_id"], ["sku_id"])], "oi_amount", scope="scope05"))

ALC06 = (_active("scope06")
         + "lines06 AS (SELECT supplier_id, category_id, store_id, channel, net_sales FROM sales),\n"
         + _waterfall("w06", "lines06", "oi_in",
                      [(["supplier_id", "category_id", "store_id"], ["channel"]),
                       (["category_id"], ["store_id", "supplier_id", "channel"])], "oi_amount", scope="scope06"))

ALC09 = ("lines09 AS (SELECT supplier_id, category_id, channel, sku_id, net_sales FROM sales),\n"
         + _waterfall("w09", "lines09", "oi_in", [(["supplier_id", "category_id"], ["channel", "sku_id"])],
                      "oi_amount"))

FRESH_SALES = (f"fresh_cat AS (SELECT DISTINCT category_id FROM category WHERE {_match('module_name', FRESH)}),\n"
               "fresh_sales AS (SELECT * FROM sales WHERE category_id IN (SELECT category_id FROM fresh_cat)),\n"
               f"fresh_coupon AS (SELECT * FROM coupon WHERE {_match('department', FRESH)}),\n")

ALC07 = (FRESH_SALES + _active("scope07", pattern=FRESH)
         + "lines07 AS (SELECT supplier_id, category_id, sku_id, net_sales FROM fresh_sales WHERE net_sales > 0),\n"
         + _waterfall("w07", "lines07", "oi_in",
                      [(["supplier_id", "category_id"], ["sku_id"]), (["category_id"], ["sku_id"])],
                      "oi_amount", scope="scope07")
         + "hop2_pool AS (SELECT sku_id, alloc_amount AS sku_amount FROM w07_out),\n"
         + "hop2_lines AS (SELECT store_id, sku_id, net_sales FROM fresh_sales WHERE net_sales > 0),\n"
         + _realloc("h2", "hop2_lines", "hop2_pool", ["sku_id"], ["store_id"], "net_sales", "sku_amount",
                    residual_share=1.0))

SKU13 = (ALC05
         + f"oi13 AS ({_rollup('w05_out', SKU_KEYS, ['alloc_share', 'alloc_amount'])}),\n"
         + f"m13 AS ({_combine([('sales', SALES_M), ('coupon', ['coupon_cost']), ('oi13', ['alloc_share', 'alloc_amount'])], SKU_KEYS, keep=['sales', 'oi13'])}),\n")

CO13 = (ALC06
        + f"oi06r AS ({_rollup('w06_out', SC_KEYS, ['alloc_share', 'alloc_amount'])}),\n"
        + f"cm AS ({_combine([('sales', SALES_M + ['footfall']), ('coupon', ['coupon_cost']), ('oi06r', ['alloc_share', 'alloc_amount'])], SC_KEYS)}),\n")

ABN_KEYS = ["category_id", "store_id", "sku_id", "sku_name"]
ABN_M = ["net_sales", "gross_margin", "discount_net", "price_comp", "shrink"]
ABN_WORK = (f"abn_c AS ({_combine([('sales', ABN_M), ('coupon', ['coupon_cost'])], ABN_KEYS)}),\n"
            f"work AS (SELECT {', '.join(ABN_KEYS)}, {', '.join(ABN_M)}, coupon_cost, "
            f"CAST(gross_margin - coupon_cost AS DECIMAL(38,12)) AS post_coupon_margin, "
            f"{_ratio('gross_margin - coupon_cost', 'net_sales')} AS post_coupon_margin_rate FROM abn_c),\n")


def _sigma(name: str, src: str, by: str, col: str, k: float, keep: str = "outside") -> str:
    v = f"CAST(s.{col} AS DOUBLE)"
    if keep == "outside":
        cond = f"({v} > m._mean + {k} * m._std OR {v} < m._mean - {k} * m._std)"
    else:
        cond = f"({v} < m._mean + {k} * m._std AND {v} > m._mean - {k} * m._std)"
    return (f"{name}_m AS (SELECT {by}, avg(CAST({col} AS DOUBLE)) AS _mean, stddev_samp(CAST({col} AS DOUBLE)) AS _std "
            f"FROM {src} GROUP BY {by}),\n"
            f"{name} AS (SELECT s.* FROM {src} s JOIN {name}_m m ON s.{by} = m.{by} WHERE COALESCE({cond}, FALSE)),\n")


ABN_OUT = (ABN_WORK
           + "w_amt AS (SELECT category_id, store_id, sku_id, sku_name, post_coupon_margin FROM work),\n"
           + "w_rate AS (SELECT category_id, store_id, sku_id, sku_name, post_coupon_margin_rate FROM work),\n"
           + _sigma("o_amt", "w_amt", "category_id", "post_coupon_margin", 6.0)
           + _sigma("o_rate", "w_rate", "category_id", "post_coupon_margin_rate", 6.0)
           + "two AS (SELECT a.category_id, a.store_id, a.sku_id, a.sku_name, a.post_coupon_margin, "
             "r.post_coupon_margin_rate FROM o_amt a LEFT JOIN o_rate r ON a.category_id = r.category_id "
             "AND a.store_id = r.store_id AND a.sku_id = r.sku_id AND a.sku_name = r.sku_name),\n"
           + "abn_cat AS (SELECT DISTINCT category_id FROM category WHERE category_name NOT IN ('删除禁用') "
             "AND module_id NOT IN ('0', '1')),\n"
           + "flag AS (SELECT * FROM two WHERE category_id IN (SELECT category_id FROM abn_cat) "
             "AND post_coupon_margin < 0),\n")

# ------------------------------------------------------------------ queries

ORACLE_SQL: dict[str, str] = {}

ORACLE_SQL["pipe04_margin_sku"] = _sql(
    f"m AS ({_combine([('sales', SALES_M), ('coupon', ['coupon_cost'])], SKU_KEYS, keep=['sales'])})",
    _margin_select("m", SKU_KEYS, SALES_M + ["coupon_cost"]))

ORACLE_SQL["pipe05_margin_category"] = _sql(
    f"m AS ({_combine([('sales', SALES_M + ['footfall']), ('coupon', ['coupon_cost'])], SC_KEYS)})",
    _margin_select("m", SC_KEYS, SALES_M + ["footfall", "coupon_cost"]))

ORACLE_SQL["pipe05_margin_abnormal"] = _sql(
    f"m AS ({_combine([('sales', ABN_M), ('coupon', ['coupon_cost'])], ABN_KEYS)})",
    _margin_select("m", ABN_KEYS, ABN_M + ["coupon_cost"]))

ORACLE_SQL["prj05_conform_codes"] = _sql("", f"""
SELECT COALESCE(trim(CAST(p_partkey AS VARCHAR), {_q(WHITESPACE)}), '__NA__') AS sku_id,
       COALESCE(trim(p_name, {_q(WHITESPACE)}), '__NA__') AS sku_name,
       COALESCE(trim(p_brand, {_q(WHITESPACE)}), '__NA__') AS category_id,
       CAST(COALESCE(CAST(trunc(CASE WHEN isnan(TRY_CAST(p_retailprice AS DOUBLE)) OR isinf(TRY_CAST(p_retailprice AS DOUBLE))
                                     THEN NULL ELSE TRY_CAST(p_retailprice AS DOUBLE) END) AS BIGINT), 0) AS VARCHAR) AS price_code
FROM part""")

ORACLE_SQL["prj12_round"] = _sql(
    f"r AS ({_rollup('sales', ['category_id', 'store_id'], ['net_sales', 'gross_margin'])})",
    f"SELECT category_id, store_id, {_round2('net_sales')} AS net_sales, {_round2('gross_margin')} AS gross_margin, "
    f"{_round2(_ratio('gross_margin', 'net_sales', fill=0) + ' * 100')} AS margin_rate_pct FROM r")

ORACLE_SQL["flt05_oi_scope"] = _sql(
    f"r AS ({_rollup('oi_in', ['supplier_id', 'category_id', 'store_id', 'deduction_type'], ['oi_amount'])})",
    f"SELECT supplier_id, category_id, store_id, deduction_type, {_d('oi_amount')} FROM r")

ORACLE_SQL["flt07_semi_category"] = _sql(
    _active("act", modules=MODULES)
    + f"r AS ({_rollup('sales', ['category_id', 'store_id'], ['net_sales', 'gross_margin'], where='category_id IN (SELECT category_id FROM act)')})",
    f"SELECT category_id, store_id, {_doubles(['net_sales', 'gross_margin'])} FROM r")

ORACLE_SQL["flt11_pattern_match"] = _sql("", """
SELECT c_custkey, c_name, CAST(c_nationkey AS VARCHAR) || '$' AS match_key,
       regexp_matches(c_name, '(?i)' || CAST(c_nationkey AS VARCHAR) || '$') AS matched
FROM customer""")

ORACLE_SQL["flt12_scope_range"] = _sql(
    _active("act", modules=("1",)),
    "SELECT DISTINCT category_id, store_id, channel, 1 AS in_scope FROM sales "
    "WHERE category_id IN (SELECT category_id FROM act)")

ORACLE_SQL["jn06_unmatched_oi"] = _sql(
    f"p AS ({_rollup('oi_in', ['supplier_id', 'category_id', 'store_id'], ['oi_amount'])})",
    "SELECT supplier_id, category_id, store_id, CAST(oi_amount AS DOUBLE) AS oi_amount FROM p "
    "WHERE NOT EXISTS (SELECT 1 FROM sales s WHERE s.supplier_id = p.supplier_id "
    "AND s.category_id = p.category_id AND s.store_id = p.store_id)")

ALC04 = (f"base04 AS ({_rollup('sales', ['category_id', 'supplier_id'], ['net_sales'])}),\n"
         "lines04 AS (SELECT * FROM base04 WHERE net_sales > 0),\n"
         + _pool("pool04", "coupon", ["category_id"], "coupon_cost")
         + _alloc("a04", "lines04", "pool04", ["category_id"], ["supplier_id"], "net_sales", "coupon_cost")
         + "fb04 AS (SELECT category_id, supplier_id, CAST(coupon_cost AS DECIMAL(18,4)) AS alloc_amount FROM coupon "
           "WHERE category_id IN (SELECT category_id FROM a04_resid) AND category_id IS NOT NULL "
           "AND supplier_id IS NOT NULL),\n"
         + "sc04 AS (SELECT category_id, supplier_id, CAST(SUM(alloc_amount) AS DECIMAL(28,4)) AS coupon_cost FROM ("
           "SELECT category_id, supplier_id, alloc_amount FROM a04_alloc UNION ALL SELECT * FROM fb04) u "
           "GROUP BY category_id, supplier_id),\n")

ORACLE_SQL["alc04_coupon_to_supplier"] = _sql(
    ALC04, "SELECT category_id, supplier_id, CAST(coupon_cost AS DOUBLE) AS coupon_cost FROM sc04")

ORACLE_SQL["alc05_oi_store_sku"] = _sql(
    ALC05, "SELECT supplier_id, category_id, store_id, channel, sku_id, "
           "CAST(alloc_share AS DOUBLE) AS alloc_share, CAST(alloc_amount AS DOUBLE) AS alloc_amount, alloc_level "
           "FROM w05_out")

ORACLE_SQL["alc05_unallocated"] = _sql(
    ALC05, "SELECT supplier_id, category_id, store_id, CAST(oi_amount AS DOUBLE) AS oi_amount FROM w05_unalloc")

ORACLE_SQL["alc06_oi_store_category"] = _sql(
    ALC06, "SELECT supplier_id, category_id, store_id, channel, "
           "CAST(alloc_share AS DOUBLE) AS alloc_share, CAST(alloc_amount AS DOUBLE) AS alloc_amount, alloc_level "
           "FROM w06_out")

ORACLE_SQL["alc07_fresh_two_hop"] = _sql(
    ALC07, "SELECT supplier_id, category_id, sku_id, CAST(alloc_share AS DOUBLE) AS alloc_share, "
           "CAST(alloc_amount AS DOUBLE) AS alloc_amount, alloc_level FROM w07_out")

ORACLE_SQL["alc08_realloc_sku"] = _sql(
    ALC06 + "lines08 AS (SELECT category_id, store_id, channel, sku_id, net_sales FROM sales WHERE net_sales > 0),\n"
    + _realloc("r08", "lines08", "w06_out", SC_KEYS, ["sku_id"], "net_sales", "alloc_amount"),
    "SELECT category_id, store_id, channel, sku_id, " + _doubles(["net_sales", "alloc_share", "pool_amount",
                                                                 "alloc_amount"]) + " FROM r08_out")

ORACLE_SQL["alc09_oi_chain_sku"] = _sql(
    ALC09, "SELECT supplier_id, category_id, channel, sku_id, CAST(alloc_share AS DOUBLE) AS alloc_share, "
           "CAST(alloc_amount AS DOUBLE) AS alloc_amount, alloc_level FROM w09_out")

TYPE_M = ["net_sales_issued", "margin_issued", "net_sales_redeemed", "margin_redeemed", "comp_net_alloc",
          "promo_comp_alloc"]
ORACLE_SQL["pipe02_coupon_type"] = _sql(
    f"m AS ({_combine([('coupon_type', TYPE_M), ('coupon', ['coupon_cost'])], ['store_id', 'coupon_type_id'])})",
    f"SELECT store_id, coupon_type_id, {_doubles(TYPE_M + ['coupon_cost'])} FROM m")

SUPPLIER_MASTER = """
sm_src AS (SELECT supplier_id, supplier_name, 1 AS prio FROM sales
           UNION ALL SELECT supplier_id, supplier_name, 2 FROM oi_in
           UNION ALL SELECT supplier_id, supplier_name, 3 FROM coupon),
sm AS (SELECT supplier_id, supplier_name FROM (
         SELECT supplier_id, supplier_name, row_number() OVER (PARTITION BY supplier_id
                ORDER BY prio, supplier_name IS NULL, supplier_name) AS rn
         FROM sm_src WHERE supplier_id IS NOT NULL) t WHERE rn = 1),
"""

ORACLE_SQL["pipe03_supplier_master"] = _sql(SUPPLIER_MASTER, "SELECT supplier_id, supplier_name FROM sm")

ORACLE_SQL["pipe06_supplier_coupon"] = _sql(
    f"r AS ({_rollup('coupon', ['category_id', 'supplier_id'], ['coupon_cost'])})",
    "SELECT category_id, supplier_id, CAST(coupon_cost AS DOUBLE) AS coupon_cost FROM r")

ORACLE_SQL["pipe08_supplier_net_margin"] = _sql(
    ALC04 + SUPPLIER_MASTER
    + f"s08 AS ({_rollup('sales', ['category_id', 'supplier_id'], ['net_sales', 'gross_margin'])}),\n"
    + f"o08 AS ({_rollup('oi_in', ['category_id', 'supplier_id'], ['oi_amount'])}),\n"
    + f"m08 AS ({_combine([('s08', ['net_sales', 'gross_margin']), ('o08', ['oi_amount']), ('sc04', ['coupon_cost'])], ['category_id', 'supplier_id'])}),\n",
    "SELECT m.category_id, m.supplier_id, sm.supplier_name, "
    + ", ".join(f"{_round2('m.' + c)} AS {c}" for c in ["net_sales", "gross_margin", "oi_amount", "coupon_cost"])
    + f", {_round2('m.gross_margin - m.coupon_cost + m.oi_amount')} AS net_margin "
      "FROM m08 m LEFT JOIN sm ON m.supplier_id = sm.supplier_id")

ORACLE_SQL["pipe13_company_margin"] = _sql(
    CO13, _margin_select("cm", SC_KEYS, SALES_M + ["footfall", "coupon_cost", "alloc_share", "alloc_amount"]))

ORACLE_SQL["pipe13_sku_margin"] = _sql(
    SKU13, _margin_select("m13", SKU_KEYS, SALES_M + ["coupon_cost", "alloc_share", "alloc_amount"]))

ORACLE_SQL["pipe14_enriched_margin"] = _sql(
    SKU13 + """
skm_src AS (SELECT sku_id, sku_name, 1 AS prio FROM sales UNION ALL SELECT sku_id, sku_name, 2 FROM coupon),
skm AS (SELECT sku_id, sku_name FROM (SELECT sku_id, sku_name, row_number() OVER (PARTITION BY sku_id
        ORDER BY prio, sku_name IS NULL, sku_name) AS rn FROM skm_src WHERE sku_id IS NOT NULL) t WHERE rn = 1),
""",
    "SELECT m.category_id, m.store_id, m.channel, m.sku_id, "
    + ", ".join(f"CAST(m.{c} AS DOUBLE) AS {c}" for c in SALES_M + ["coupon_cost", "alloc_share", "alloc_amount"])
    + ", " + _margin_measures().replace("gross_margin", "m.gross_margin").replace("net_sales", "m.net_sales")
    .replace("coupon_cost", "m.coupon_cost")
    + ", c.module_id, c.module_name, c.category_name, st.store_format, st.store_name, k.sku_name "
      "FROM m13 m LEFT JOIN category c ON m.category_id = c.category_id "
      "LEFT JOIN store st ON m.store_id = st.store_id LEFT JOIN skm k ON m.sku_id = k.sku_id")

STOCK_M = ["own_cost", "stock_qty", "stock_value"]
MARGIN_M15 = ["net_sales", "cost", "qty", "gross_margin", "discount_net", "price_comp", "shrink", "coupon_cost",
              "post_coupon_margin", "alloc_amount"]

ORACLE_SQL["pipe15_turnover_store"] = _sql(
    SKU13
    + "m15 AS (SELECT store_id, category_id, sku_id, " + ", ".join(
        ["net_sales", "cost", "qty", "gross_margin", "discount_net", "price_comp", "shrink", "coupon_cost",
         "gross_margin - coupon_cost AS post_coupon_margin", "alloc_amount"]) + " FROM m13),\n"
    + f"t15 AS ({_combine([('m15', MARGIN_M15), ('stock', STOCK_M)], ['store_id', 'category_id', 'sku_id'])}),\n",
    f"SELECT store_id, category_id, sku_id, {_doubles(MARGIN_M15 + STOCK_M)}, "
    f"{_ratio('stock_value', str(DAYS), mode='null')} AS daily_stock_value, "
    f"{_ratio('stock_value', 'own_cost', mode='null')} AS turnover_days FROM t15")

CHAIN = (ALC09
         + f"oi09r AS ({_rollup('w09_out', ['category_id', 'channel', 'sku_id'], ['alloc_share', 'alloc_amount'])}),\n"
         + f"chain AS ({_combine([('sales', SALES_M), ('coupon', ['coupon_cost']), ('oi09r', ['alloc_share', 'alloc_amount'])], ['category_id', 'channel', 'sku_id'], keep=['sales', 'oi09r'])}),\n")

ORACLE_SQL["pipe16_turnover_sku"] = _sql(
    CHAIN
    + "c16 AS (SELECT category_id, sku_id, " + ", ".join(f"COALESCE(SUM({c}), 0) AS {c}" for c in
                                                      ["net_sales", "cost", "qty", "gross_margin", "discount_net",
                                                       "price_comp", "shrink", "coupon_cost"])
    + ", COALESCE(SUM(gross_margin - coupon_cost), 0) AS post_coupon_margin, COALESCE(SUM(alloc_amount), 0) AS alloc_amount "
      "FROM chain GROUP BY category_id, sku_id),\n"
    + f"k16 AS ({_rollup('stock', ['category_id', 'sku_id'], STOCK_M)}),\n",
    f"SELECT c.category_id, c.sku_id, {', '.join(f'CAST(c.{m} AS DOUBLE) AS {m}' for m in MARGIN_M15)}, "
    f"{', '.join(f'CAST(k.{m} AS DOUBLE) AS {m}' for m in STOCK_M)}, "
    f"{_ratio('c.post_coupon_margin + c.alloc_amount', 'c.net_sales', mode='null')} AS total_margin_rate, "
    f"{_ratio(f'k.own_cost * {DAYS * 12}', 'k.stock_value', mode='null')} AS annual_turns "
    "FROM c16 c JOIN k16 k ON c.category_id = k.category_id AND c.sku_id = k.sku_id")

SC_S = ["qty", "net_sales_pre_discount", "net_sales", "cost", "discount_net", "shrink", "price_comp",
        "gross_margin", "system_margin", "footfall"]
SC_C = ["coupon_total", "coupon_supplier_borne", "coupon_platform_borne", "coupon_cost"]
ORACLE_SQL["pipe17_category_scorecard"] = _sql(
    f"sc AS ({_combine([('sales', SC_S), ('coupon', SC_C), ('oi_in', ['oi_amount']), ('stock', ['own_cost', 'stock_value'])], ['category_id'])})",
    f"SELECT category_id, {_doubles(SC_S + SC_C + ['oi_amount', 'own_cost', 'stock_value'])}, {_margin_measures()}, "
    f"{_ratio('stock_value', 'own_cost', mode='null')} AS turnover_days, "
    f"{_ratio('own_cost * 365', 'stock_value', mode='null')} AS turns_per_year FROM sc")

ORACLE_SQL["sta01_top_quantile"] = _sql(
    f"r AS ({_rollup('sales', ['category_id', 'store_id', 'sku_id'], ['net_sales'])}),\n"
    "t AS (SELECT category_id, quantile_cont(CAST(net_sales AS DOUBLE), 0.8) AS th FROM r GROUP BY category_id)",
    "SELECT r.category_id, r.store_id, r.sku_id, CAST(r.net_sales AS DOUBLE) AS net_sales FROM r "
    "JOIN t ON r.category_id = t.category_id WHERE CAST(r.net_sales AS DOUBLE) >= t.th")

EVENTS = "ev AS (SELECT event_id, event_type, user_id, value FROM events),\n"
ORACLE_SQL["sta02_sigma_outliers"] = _sql(
    EVENTS + _sigma("o", "ev", "event_type", "value", 6.0), "SELECT * FROM o")
ORACLE_SQL["sta03_inliers"] = _sql(
    EVENTS + _sigma("o", "ev", "event_type", "value", 1.5, keep="inside"), "SELECT * FROM o")
ORACLE_SQL["sta04_number_outliers"] = _sql(
    f"r AS ({_rollup('sales', ['category_id', 'store_id', 'sku_id'], ['qty'])}),\n"
    + _sigma("o", "r", "category_id", "qty", 6.0),
    "SELECT category_id, store_id, sku_id, CAST(qty AS DOUBLE) AS qty FROM o")
ORACLE_SQL["sta05_two_metric_outliers"] = _sql(
    ABN_OUT, "SELECT category_id, store_id, sku_id, sku_name, CAST(post_coupon_margin AS DOUBLE) AS post_coupon_margin, "
             "post_coupon_margin_rate FROM two")
ORACLE_SQL["sta06_category_outliers"] = _sql(
    CHAIN + "c06 AS (SELECT category_id, channel, sku_id, CAST(gross_margin - coupon_cost AS DECIMAL(38,12)) "
            "AS post_coupon_margin FROM chain),\n"
    + _sigma("o", "c06", "category_id", "post_coupon_margin", 3.0),
    "SELECT category_id, channel, sku_id, CAST(post_coupon_margin AS DOUBLE) AS post_coupon_margin FROM o")

ORACLE_SQL["pipe12_abnormal_summary"] = _sql(
    ABN_OUT, f"SELECT st.store_format, f.store_id, st.store_name, f.category_id, f.sku_id, f.sku_name, "
             f"{_round2('f.post_coupon_margin')} AS post_coupon_margin FROM flag f "
             "LEFT JOIN store st ON f.store_id = st.store_id")

DRILL_M = ["net_sales", "gross_margin", "discount_net", "price_comp", "qty", "cost"]
ORACLE_SQL["pipe12_abnormal_drill"] = _sql(
    ABN_OUT
    + f"dr AS ({_combine([('sales', DRILL_M), ('coupon', ['coupon_cost'])], ['store_id', 'sku_id', 'channel'])}),\n"
    + "fl AS (SELECT store_id, sku_id, min(sku_name) AS sku_name FROM flag GROUP BY store_id, sku_id),\n",
    "SELECT d.store_id, st.store_name, d.sku_id, fl.sku_name, d.channel, "
    + ", ".join(f"{_round2('d.' + c)} AS {c}" for c in ["net_sales", "cost", "price_comp", "gross_margin", "coupon_cost"])
    + f", {_round2('d.gross_margin - d.coupon_cost')} AS post_coupon_margin, CAST(d.qty AS DOUBLE) AS qty, "
    + f"{_round2(_ratio('d.net_sales', 'd.qty'))} AS unit_price, {_round2(_ratio('d.cost', 'd.qty'))} AS unit_cost "
      "FROM dr d JOIN fl ON d.store_id = fl.store_id AND d.sku_id = fl.sku_id "
      "LEFT JOIN store st ON d.store_id = st.store_id")

FRESH_M = ["net_sales", "cost", "qty", "gross_margin"]
FRESH_MARGIN = (FRESH_SALES
                + f"fm AS ({_combine([('fresh_sales', FRESH_M), ('fresh_coupon', ['coupon_cost'])], ['store_id', 'sku_id'])}),\n")
ORACLE_SQL["pipe09_fresh_margin"] = _sql(
    FRESH_MARGIN, _margin_select("fm", ["store_id", "sku_id"], FRESH_M + ["coupon_cost"]))

ORACLE_SQL["pipe10_fresh_oi"] = _sql(
    ALC07, "SELECT store_id, sku_id, CAST(alloc_share AS DOUBLE) AS alloc_share, "
           "CAST(pool_amount AS DOUBLE) AS sku_amount, CAST(alloc_amount AS DOUBLE) AS alloc_amount FROM h2_out")

ORACLE_SQL["pipe11_fresh_total"] = _sql(
    ALC07.replace("fresh_cat AS", "fresh_cat AS", 1) + "fm AS ("
    + _combine([('fresh_sales', FRESH_M), ('fresh_coupon', ['coupon_cost'])], ['store_id', 'sku_id']) + "),\n"
    + "fo AS (SELECT store_id, sku_id, alloc_amount AS oi_amount FROM h2_out),\n"
    + f"ft AS ({_combine([('fm', ['net_sales', 'gross_margin', 'coupon_cost']), ('fo', ['oi_amount'])], ['store_id', 'sku_id'])}),\n",
    "SELECT store_id, sku_id, " + _doubles(["net_sales", "gross_margin", "coupon_cost", "oi_amount"])
    + ", CAST(gross_margin - coupon_cost + oi_amount AS DOUBLE) AS total_margin, "
    + _ratio("gross_margin - coupon_cost + oi_amount", "net_sales") + " AS total_margin_rate FROM ft")

ORACLE_SQL["pipe01_union_complete"] = _sql(
    """
d AS (SELECT CAST(ts AS DATE) AS biz_date FROM events
      WHERE ts IS NOT NULL),
c AS (SELECT biz_date, count(*) AS n_rows FROM d GROUP BY biz_date),
cal AS (SELECT CAST(unnest(generate_series(min(biz_date), max(biz_date), INTERVAL 1 DAY)) AS DATE) AS biz_date FROM d)
""",
    "SELECT cal.biz_date, CAST(COALESCE(c.n_rows, 0) AS BIGINT) AS n_rows, c.n_rows IS NULL AS is_missing "
    "FROM cal LEFT JOIN c ON cal.biz_date = c.biz_date")

ORACLE_SQL["agg13_reconcile"] = _sql(
    CO13,
    """
SELECT 'net_sales' AS metric, CAST((SELECT COALESCE(SUM(net_sales), 0) FROM sales) AS DOUBLE) AS raw_total,
       CAST((SELECT COALESCE(SUM(net_sales), 0) FROM cm) AS DOUBLE) AS result_total,
       CAST((SELECT COALESCE(SUM(net_sales), 0) FROM cm) - (SELECT COALESCE(SUM(net_sales), 0) FROM sales) AS DOUBLE) AS diff
UNION ALL
SELECT 'coupon_cost', CAST((SELECT COALESCE(SUM(coupon_cost), 0) FROM coupon) AS DOUBLE),
       CAST((SELECT COALESCE(SUM(coupon_cost), 0) FROM cm) AS DOUBLE),
       CAST((SELECT COALESCE(SUM(coupon_cost), 0) FROM cm) - (SELECT COALESCE(SUM(coupon_cost), 0) FROM coupon) AS DOUBLE)
UNION ALL
SELECT 'oi_amount', CAST((SELECT COALESCE(SUM(oi_amount), 0) FROM oi_in) AS DOUBLE),
       CAST((SELECT COALESCE(SUM(alloc_amount), 0) FROM w06_out) + (SELECT COALESCE(SUM(oi_amount), 0) FROM w06_unalloc) AS DOUBLE),
       CAST((SELECT COALESCE(SUM(alloc_amount), 0) FROM w06_out) + (SELECT COALESCE(SUM(oi_amount), 0) FROM w06_unalloc)
            - (SELECT COALESCE(SUM(oi_amount), 0) FROM oi_in) AS DOUBLE)
""")

# ------------------------------------------------------------------ further report forms

CHAIN_KEYS = ["category_id", "channel", "sku_id"]
OI_M = ["alloc_share", "alloc_amount"]


def _margin_from(alias: str) -> str:
    return (_margin_measures().replace("gross_margin", f"{alias}.gross_margin")
            .replace("net_sales", f"{alias}.net_sales").replace("coupon_cost", f"{alias}.coupon_cost"))


def _first_name(name: str, key: str, attr: str, sources: Sequence[str]) -> str:
    """Master: the name in the first source that has the key, the smallest one there."""
    src = " UNION ALL ".join(f"SELECT {key}, {attr}, {i} AS prio FROM {s}" for i, s in enumerate(sources))
    return (f"{name} AS (SELECT {key}, {attr} FROM (SELECT {key}, {attr}, row_number() OVER (PARTITION BY {key} "
            f"ORDER BY prio, {attr} IS NULL, {attr}) AS rn FROM ({src}) s WHERE {key} IS NOT NULL) t WHERE rn = 1),\n")


ORACLE_SQL["pipe04_margin_chain"] = _sql(
    f"m AS ({_combine([('sales', SALES_M), ('coupon', ['coupon_cost'])], CHAIN_KEYS, keep=['sales'])})",
    _margin_select("m", CHAIN_KEYS, SALES_M + ["coupon_cost"]))

ORACLE_SQL["pipe13_chain_margin"] = _sql(
    CHAIN, _margin_select("chain", CHAIN_KEYS, SALES_M + ["coupon_cost"] + OI_M))

PARTIAL = (ALC06 + "lines08 AS (SELECT category_id, store_id, channel, sku_id, net_sales FROM sales WHERE net_sales > 0),\n"
           + _realloc("r08", "lines08", "w06_out", SC_KEYS, ["sku_id"], "net_sales", "alloc_amount")
           + f"o08 AS ({_rollup('r08_out', SKU_KEYS, OI_M)}),\n"
           + f"pm AS ({_combine([('sales', SALES_M), ('coupon', ['coupon_cost']), ('o08', OI_M)], SKU_KEYS, keep=['sales', 'o08'])}),\n")
ORACLE_SQL["pipe13_partial_margin"] = _sql(
    PARTIAL, _margin_select("pm", SKU_KEYS, SALES_M + ["coupon_cost"] + OI_M))

ORACLE_SQL["pipe14_enriched_chain"] = _sql(
    CHAIN + _first_name("skm", "sku_id", "sku_name", ["sales", "coupon"]),
    "SELECT m.category_id, m.channel, m.sku_id, "
    + ", ".join(f"CAST(m.{c} AS DOUBLE) AS {c}" for c in SALES_M + ["coupon_cost"] + OI_M)
    + f", {_margin_from('m')}, k.sku_name, c.module_id, c.module_name, c.category_name FROM chain m "
      "LEFT JOIN skm k ON m.sku_id = k.sku_id LEFT JOIN category c ON m.category_id = c.category_id")

ORACLE_SQL["pipe14_enriched_company"] = _sql(
    CO13, "SELECT m.category_id, m.store_id, m.channel, "
    + ", ".join(f"CAST(m.{c} AS DOUBLE) AS {c}" for c in SALES_M + ["footfall", "coupon_cost"] + OI_M)
    + f", {_margin_from('m')}, c.module_id, c.module_name, c.category_name, st.store_format, st.store_name FROM cm m "
      "LEFT JOIN category c ON m.category_id = c.category_id LEFT JOIN store st ON m.store_id = st.store_id")

ORACLE_SQL["pipe14_enriched_scorecard"] = (
    "SELECT s.*, c.module_id, c.module_name, c.category_name FROM (" + ORACLE_SQL["pipe17_category_scorecard"]
    + ") s LEFT JOIN (" + _sql("", "SELECT * FROM category") + ") c ON s.category_id = c.category_id")

ORACLE_SQL["pipe15_turnover_category"] = _sql(
    CO13 + "m15 AS (SELECT *, gross_margin - coupon_cost AS post_coupon_margin FROM cm),\n"
    + f"t15 AS ({_combine([('m15', MARGIN_M15), ('stock', STOCK_M)], ['store_id', 'category_id'])}),\n",
    f"SELECT store_id, category_id, {_doubles(MARGIN_M15 + STOCK_M)}, "
    f"{_ratio('stock_value', str(DAYS), mode='null')} AS daily_stock_value, "
    f"{_ratio('stock_value', 'own_cost', mode='null')} AS turnover_days FROM t15")

ORACLE_SQL["pipe12_abnormal_list"] = _sql(
    ABN_OUT, "SELECT t.store_id, t.category_id, t.sku_id, t.sku_name, "
             "CAST(t.post_coupon_margin AS DOUBLE) AS post_coupon_margin, t.post_coupon_margin_rate, "
             "st.store_format, st.store_name FROM two t LEFT JOIN store st ON t.store_id = st.store_id")

ORACLE_SQL["pipe03_coupon_type_master"] = _sql(
    _first_name("ctm", "coupon_type_id", "coupon_type_name", ["coupon_type", "coupon"]),
    "SELECT coupon_type_id, coupon_type_name FROM ctm")

ORACLE_SQL["pipe03_sku_master"] = _sql(
    _first_name("skm", "sku_id", "sku_name", ["sales", "coupon", "stock"]), "SELECT sku_id, sku_name FROM skm")

CHAIN_SCOPE = (_active("act", modules=("1",)) + "scope AS (SELECT DISTINCT category_id, channel, 1 AS in_scope FROM sales "
               "WHERE category_id IN (SELECT category_id FROM act)),\n")
ORACLE_SQL["flt12_scope_range_chain"] = _sql(CHAIN_SCOPE, "SELECT category_id, channel, in_scope FROM scope")
ORACLE_SQL["flt12_scope_semi"] = _sql(
    CHAIN_SCOPE, "SELECT category_id, channel, CAST(SUM(coupon_cost) AS DOUBLE) AS coupon_cost FROM coupon "
                 "WHERE (category_id, channel) IN (SELECT category_id, channel FROM scope) GROUP BY category_id, channel")


def _control(rows: Sequence[tuple[str, str, str]]) -> str:
    """metric, raw total and result total (scalar SQL)."""
    return " UNION ALL ".join(
        f"SELECT '{m}' AS metric, CAST({raw} AS DOUBLE) AS raw_total, CAST({res} AS DOUBLE) AS result_total, "
        f"CAST({res} - {raw} AS DOUBLE) AS diff" for m, raw, res in rows)


def _total(col: str, src: str) -> str:
    return f"(SELECT CAST(COALESCE(SUM({col}), 0) AS DECIMAL(38,4)) FROM {src})"


CARD = f"sc AS ({_combine([('sales', SC_S), ('coupon', SC_C), ('oi_in', ['oi_amount']), ('stock', ['own_cost', 'stock_value'])], ['category_id'])}),\n"
ORACLE_SQL["agg13_scorecard"] = _sql(CARD, _control([
    (m, _total(m, src), _total(m, "sc")) for m, src in
    (("net_sales", "sales"), ("coupon_cost", "coupon"), ("oi_amount", "oi_in"), ("stock_value", "stock"))]))

ORACLE_SQL["agg13_fresh"] = _sql(ALC07, _control([
    ("oi_amount", _total("oi_amount", "oi_in"),
     f"({_total('alloc_amount', 'w07_out')} + {_total('oi_amount', 'w07_unalloc')})"),
    ("fresh_oi_amount", _total("oi_amount", "oi_in WHERE category_id IN (SELECT category_id FROM scope07)"),
     _total("alloc_amount", "h2_out"))]))

ORACLE_SQL["agg13_chain"] = _sql(CHAIN, _control([
    ("oi_amount", _total("oi_amount", "oi_in"), _total("alloc_amount", "w09_out")),
    ("oi_matched", _total("alloc_amount", "w09_out WHERE alloc_level = 1"),
     _total("alloc_amount", f"chain WHERE channel <> {SENT}")),
    ("net_sales", _total("net_sales", "sales"), _total("net_sales", "chain"))]))

_COVER = {"sales": "l_returnflag <> 'A' AND p_brand <> 'Brand#25' AND l_suppkey % 10 <> 3",
          "coupon": "(l_linestatus = 'F' AND l_returnflag IN ('N', 'A')) OR (l_returnflag = 'R' AND "
                    "(p_brand = 'Brand#25' OR l_suppkey % 10 = 3))",
          "oi": "l_returnflag = 'A'", "stock": "l_linestatus = 'O'",
          "coupon_type": "l_returnflag = 'R' AND c_mktsegment <> 'BUILDING'"}
_COVER["any"] = " OR ".join(f"({_COVER[f]})" for f in ("sales", "coupon", "oi", "stock"))
ORACLE_SQL["agg13_fact_coverage"] = _sql("", " UNION ALL ".join(
    f"SELECT '{f}' AS fact, count(*) FILTER (WHERE {c}) AS rows_inside, count(*) FILTER (WHERE NOT ({c})) AS rows_outside, "
    f"CAST(COALESCE(SUM(price) FILTER (WHERE {c}), 0) AS DOUBLE) AS price_inside, "
    f"CAST(COALESCE(SUM(price) FILTER (WHERE NOT ({c})), 0) AS DOUBLE) AS price_outside FROM lb" for f, c in _COVER.items()))

_NULLS = {"sales": (SKU_KEYS, "net_sales"), "coupon": (SKU_KEYS, "coupon_cost"),
          "oi": (["supplier_id", "category_id", "store_id"], "oi_amount"),
          "stock": (["category_id", "store_id", "sku_id"], "stock_value")}
ORACLE_SQL["agg13_null_keys"] = _sql("", " UNION ALL ".join(
    f"SELECT '{f}' AS fact, count(*) AS dropped_rows, CAST(COALESCE(SUM({m}), 0) AS DOUBLE) AS dropped_amount "
    f"FROM {f} WHERE NOT ({_nn(keys)})" for f, (keys, m) in _NULLS.items()))

_OBSERVED = [("net_sales", "sales"), ("cost", "sales"), ("gross_margin", "sales"), ("coupon_cost", "coupon")]
_SC = ["category_id", "store_id", "channel"]
ORACLE_SQL["agg13_observed"] = _sql("", " UNION ALL ".join(
    f"SELECT '{m}' AS metric, CAST(COALESCE(SUM({m}), 0) AS DOUBLE) AS raw_total, "
    f"count(*) FILTER (WHERE NOT ({_nn(_SC)})) AS dropped_rows, "
    f"CAST(COALESCE(SUM({m}) FILTER (WHERE NOT ({_nn(_SC)})), 0) AS DOUBLE) AS dropped_amount, "
    f"CAST(COALESCE(SUM({m}) FILTER (WHERE {_nn(_SC)}), 0) AS DOUBLE) AS result_total, CAST(0 AS DOUBLE) AS diff "
    f"FROM {src}" for m, src in _OBSERVED))

ORACLE_SQL["agg01_margin_from_states"] = ORACLE_SQL["pipe04_margin_sku"]
ORACLE_SQL["pipe04_margin_stored"] = ORACLE_SQL["pipe04_margin_sku"]
ORACLE_SQL["pipe05_margin_stored"] = ORACLE_SQL["pipe05_margin_category"]

ORACLE_SQL["agg15_merged_moments"] = _sql(
    "", f"SELECT category_id, count(*) AS n_rows, {_d('SUM(net_sales)', 'net_sales')}, {_d('SUM(qty)', 'qty')}, "
        "CAST(SUM(net_sales) AS DOUBLE) / count(net_sales) AS net_sales_mean, "
        "round(stddev_samp(CAST(net_sales AS DOUBLE)), 2) AS net_sales_std FROM sales "
        f"WHERE {_nn(['category_id', 'store_id', 'biz_date'])} GROUP BY category_id")

ORACLE_SQL["sta02_state_outliers"] = """
WITH m AS (SELECT event_type, avg(value) AS mu, stddev_samp(value) AS sd FROM events
           WHERE event_type IS NOT NULL AND NOT isnan(value) GROUP BY event_type)
SELECT event_id, e.event_type, value FROM events e JOIN m ON e.event_type = m.event_type
WHERE NOT isnan(value) AND (value > mu + 3 * sd OR value < mu - 3 * sd)"""

# conditions of the overlapping extracts, on a row of events
_EXTRACTS = ["COALESCE(day(ts) <= 15, TRUE)", "COALESCE(day(ts) > 12 AND event_id % 3 <> 0, FALSE)",
             "COALESCE(day(ts) > 25 AND event_id % 2 = 0, FALSE)", "COALESCE(day(ts) = 5, FALSE)"]
ORACLE_SQL["pipe01_overlap_check"] = (
    "SELECT *, CASE WHEN repeated_rows = 0 THEN 'new' WHEN repeated_rows < n_rows THEN 'partly repeated' "
    "ELSE 'delivered again' END AS status FROM (" + " UNION ALL ".join(
        f"SELECT {i + 1} AS extract, CAST(ts AS DATE) AS biz_date, count(*) AS n_rows, "
        f"count(*) FILTER (WHERE {' OR '.join(_EXTRACTS[:i]) or 'FALSE'}) AS repeated_rows "
        f"FROM events WHERE {c} GROUP BY CAST(ts AS DATE)" for i, c in enumerate(_EXTRACTS)) + ")")
ORACLE_SQL["pipe01_union_once"] = ORACLE_SQL["pipe01_union_complete"].replace(
    "WHERE ts IS NOT NULL", f"WHERE ts IS NOT NULL AND ({' OR '.join(_EXTRACTS)})")

ORACLE_SQL["alc05_late_extract"] = ORACLE_SQL["alc05_oi_store_sku"]
