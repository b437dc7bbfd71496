"""Independent SQL (DuckDB dialect) for every registered query.

The SQL re-derives the testbed from the provided tables (``raw``,
``sdim``, ``goods``, ``tgt_*`` CTEs) and states each report's rules directly
in SQL, so the Spark plans are checked against a second engine. Money
decimals are returned as DOUBLE and dates as ISO text, like ``presentable``.
"""

from __future__ import annotations

import datetime as _dt

from ..operators.filters import period_bounds
from ..schema import DEFAULT_SNAPSHOT, TOTAL_LABEL
from ..sources.testbed import AS_OF, OPERATORS, OTHER_SNAPSHOT

# ------------------------------------------------------------------ pieces
RAW_CTE = f"""
parts AS (SELECT count(*) AS n FROM part),
raw0 AS (
  SELECT
    CAST(o.o_orderdate AS DATE) AS order_date,
    CAST(l.l_shipdate AS DATE) AS ship_date,
    s.s_name AS store,
    CAST(l.l_orderkey AS VARCHAR) AS order_no,
    'SKU-' || CAST(l.l_partkey AS VARCHAR) AS product,
    CASE WHEN l.l_linenumber = 1 THEN NULL
         ELSE 'SKU-' || CAST((l.l_partkey * 7) % (SELECT n FROM parts) AS VARCHAR) END AS product2,
    l.l_quantity AS quantity,
    CAST(CAST(p.p_retailprice AS DECIMAL(18,2)) AS VARCHAR) AS unit_price,
    'USD' AS currency1,
    l.l_tax AS commission_rate,
    format('{{:,.2f}}', CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) AS DOUBLE)) AS settle_total,
    'CNY' AS currency2,
    CAST(CAST(p.p_retailprice AS DECIMAL(18,2)) * 7 AS DECIMAL(18,2)) AS unit_price_cny,
    CAST(CAST(l.l_extendedprice AS DECIMAL(18,2)) * (1 - CAST(l.l_discount AS DECIMAL(4,2))) AS DECIMAL(18,2)) AS revenue,
    CAST(p.p_retailprice AS DECIMAL(18,2)) AS cost_price,
    'CNY' AS currency3,
    CAST(CAST(l.l_quantity AS DECIMAL(18,2)) * CAST(p.p_retailprice AS DECIMAL(18,2)) AS DECIMAL(18,2)) AS cost_total,
    CAST(l.l_linenumber AS DECIMAL(18,2)) AS handling_fee,
    CASE WHEN l.l_linenumber % 5 = 0 THEN '未更新'
         ELSE CAST(CAST(CAST(l.l_tax AS DECIMAL(4,2)) * 100 AS DECIMAL(9,2)) AS VARCHAR) END AS freight_first,
    CASE WHEN l.l_linenumber = 2 THEN NULL
         ELSE CAST(CAST(l.l_discount AS DECIMAL(4,2)) * 100 AS DECIMAL(18,2)) END AS freight_last,
    CASE WHEN l.l_returnflag = 'R' THEN '香港' ELSE l.l_returnflag END AS warehouse,
    lower(n.n_name) AS country,
    CASE WHEN l.l_linenumber = 3 THEN NULL ELSE CAST(l.l_orderkey * 10 + l.l_linenumber AS VARCHAR) END AS tracking_no,
    l.l_linestatus AS payment_status
  FROM lineitem l
  JOIN orders o ON l.l_orderkey = o.o_orderkey
  JOIN supplier s ON l.l_suppkey = s.s_suppkey
  JOIN part p ON l.l_partkey = p.p_partkey
  JOIN customer c ON o.o_custkey = c.c_custkey
  JOIN nation n ON c.c_nationkey = n.n_nationkey
),
raw AS (
  SELECT order_date, ship_date, store, order_no, product, product2, quantity, unit_price, currency1,
         commission_rate, settle_total, currency2, unit_price_cny, revenue, cost_price, currency3,
         cost_total, handling_fee, freight_first, freight_last,
         CAST(revenue * CAST(0.01 AS DECIMAL(3,2)) AS DECIMAL(18,2)) AS capital_cost,
         CAST(revenue - cost_total AS DECIMAL(18,2)) AS profit,
         warehouse, country, tracking_no, payment_status
  FROM raw0
)"""

SDIM_CTE = f"""
sdim AS (
  SELECT upper(s.s_name) AS store, n.n_name AS department, r.r_name AS platform,
         'Operator#' || CAST(s.s_suppkey % {OPERATORS} AS VARCHAR) AS operator
  FROM supplier s JOIN nation n ON s.s_nationkey = n.n_nationkey
  JOIN region r ON n.n_regionkey = r.r_regionkey
)"""

GOODS_CTE = """
goods AS (
  SELECT p_partkey AS id, 'SKU-' || CAST(p_partkey AS VARCHAR) AS sku, p_brand AS brand,
         p_type AS category, 'PM-' || CAST(p_size AS VARCHAR) AS manager
  FROM part
)"""

RAW_COLS = ("order_date, ship_date, store, order_no, product, product2, quantity, unit_price, currency1, "
            "commission_rate, settle_total, currency2, unit_price_cny, revenue, cost_price, currency3, "
            "cost_total, handling_fee, freight_first, freight_last, capital_cost, profit, warehouse, "
            "country, tracking_no, payment_status")

COLLECTED_CTE = """
collected AS (
  SELECT r.* REPLACE (lower(r.store) AS store), d.platform, d.department, d.operator
  FROM raw r LEFT JOIN sdim d ON lower(r.store) = lower(d.store)
)"""

MONEY = ["unit_price", "unit_price_cny", "settle_total", "revenue", "cost_price", "cost_total",
         "handling_fee", "freight_first", "freight_last", "capital_cost", "profit"]


def _money_parse(c: str) -> str:
    if c == "freight_first":
        src = "CAST(NULLIF(trim(freight_first), '未更新') AS DECIMAL(18,6))"
    elif c == "settle_total":
        src = "CAST(replace(settle_total, ',', '') AS DECIMAL(18,6))"
    else:
        src = f"CAST({c} AS DECIMAL(18,6))"
    return f"CAST(round_even(COALESCE({src}, 0), 2) AS DECIMAL(18,2))"


CLEAN_CTE = f"""
cm AS (
  SELECT order_date, store, COALESCE(order_no, '') AS order_no, product, product2,
         CAST(quantity AS DOUBLE) AS quantity, currency1, CAST(commission_rate AS DOUBLE) AS commission_rate,
         currency2, currency3, warehouse, upper(country) AS country, COALESCE(tracking_no, '') AS tracking_no,
         payment_status, CAST(weekofyear(order_date) AS INTEGER) AS week,
         {", ".join(f"{_money_parse(c)} AS {c}" for c in MONEY)}
  FROM raw WHERE product IS NOT NULL
),
clean AS (
  SELECT cm.*,
         CASE WHEN profit <= 0 THEN '是' WHEN profit > 0 THEN '否' END AS is_loss,
         CAST(revenue - (cost_total + handling_fee + freight_first + freight_last + capital_cost) AS DECIMAL(18,2))
           AS corrected_profit,
         d.department, d.platform, d.operator,
         g1.id AS product1_id, g1.brand AS product1_brand, g1.category AS product1_category,
         g1.manager AS product1_manager,
         g2.id AS product2_id, g2.brand AS product2_brand, g2.category AS product2_category,
         g2.manager AS product2_manager
  FROM cm
  LEFT JOIN sdim d ON lower(cm.store) = lower(d.store)
  LEFT JOIN goods g1 ON cm.product = g1.sku
  LEFT JOIN goods g2 ON cm.product2 = g2.sku
)"""


def tgt_cte(kind: str, suffix: str = "") -> str:
    if kind == "department":
        keys, step = "SELECT n_name AS key, CAST(n_nationkey AS BIGINT) AS num FROM nation", 1000.0
    elif kind == "platform":
        keys, step = "SELECT r_name AS key, CAST(r_regionkey AS BIGINT) AS num FROM region", 50000.0
    else:
        keys = (f"SELECT DISTINCT 'Operator#' || CAST(s_suppkey % {OPERATORS} AS VARCHAR) AS key, "
                f"CAST(s_suppkey % {OPERATORS} AS BIGINT) AS num FROM supplier")
        step = 2000.0
    x = suffix
    return f"""
tkeys{x} AS ({keys}),
tgt_all{x} AS (
  SELECT CAST(v.snap AS BIGINT) AS snapshot, k.key,
         CAST(k.num * {step} * CASE WHEN v.snap = {DEFAULT_SNAPSHOT} THEN 1 ELSE 2 END AS DOUBLE) AS target
  FROM tkeys{x} k, (VALUES ({DEFAULT_SNAPSHOT}), ({OTHER_SNAPSHOT})) v(snap)
  WHERE k.num < (SELECT max(num) FROM tkeys{x})
),
tgt{x} AS (SELECT key, CAST(target AS DECIMAL(18,2)) AS target FROM tgt_all{x} WHERE snapshot = {DEFAULT_SNAPSHOT})"""


def with_ctes(*ctes: str, body: str) -> str:
    """``body`` is either a SELECT or more CTEs followed by the SELECT."""
    body = body.strip()
    sep = "\n" if body.upper().startswith("SELECT") else ",\n"
    return "WITH " + ",".join(c.strip("\n") for c in ctes) + sep + body


def split_select(sql: str) -> tuple[str, str]:
    """(WITH-part without the keyword, final SELECT) of an SQL built here."""
    head, _, final = sql.rpartition("\nSELECT ")
    return head[len("WITH "):], "SELECT " + final


def base_ctes(clean: bool = False, collected: bool = False) -> list[str]:
    out = [RAW_CTE, SDIM_CTE, GOODS_CTE]
    if collected:
        out.append(COLLECTED_CTE)
    if clean:
        out.append(CLEAN_CTE)
    return out


# ------------------------------------------------------------------ helpers
def r_up(x: str, s: int) -> str:
    return f"round(TRY_CAST({x} AS DECIMAL(38,6)), {s})"


def r_even(x: str, s: int) -> str:
    return f"round_even(TRY_CAST({x} AS DECIMAL(38,6)), {s})"


def safe_ratio(n: str, d: str) -> str:
    return f"(CAST({n} AS DOUBLE) / NULLIF(CAST({d} AS DOUBLE), 0))"


def report_pct(x: str) -> str:
    return f"(regexp_replace(CAST({x} AS VARCHAR), '(\\.\\d)0$', '\\1') || '%')"


def sheet_ratio(n: str, d: str) -> str:
    nn, dd = f"CAST({n} AS DOUBLE)", f"CAST({d} AS DOUBLE)"
    return (f"(CASE WHEN {nn} IS NULL OR {dd} IS NULL THEN 0.0 "
            f"WHEN {dd} = 0 AND {nn} > 0 THEN CAST('inf' AS DOUBLE) "
            f"WHEN {dd} = 0 AND {nn} < 0 THEN CAST('-inf' AS DOUBLE) "
            f"WHEN {dd} = 0 THEN 0.0 ELSE {nn} / {dd} END)")


def sheet_pct(r: str) -> str:
    return (f"(CASE WHEN {r} = CAST('inf' AS DOUBLE) THEN 'inf%' "
            f"WHEN {r} = CAST('-inf' AS DOUBLE) THEN '-inf%' "
            f"ELSE printf('%.2f', {r} * 100) || '%' END)")


def d(x: _dt.date) -> str:
    return f"DATE '{x.isoformat()}'"


# ------------------------------------------------------------------ attainment
def attainment_sql(kind: str) -> str:
    key = kind
    with_rev = kind != "department"
    rev_sum = ", round_even(sum(COALESCE(revenue, 0)), 2) AS revenue" if with_rev else ""
    having = "HAVING sum(COALESCE(profit, 0)) >= 0" if kind == "department" else ""
    rate_round = r_even if kind == "department" else r_up
    rate_expr = rate_round(safe_ratio("achieved", "target") + " * 100", 2)
    if kind == "operator":
        ranked = f"""
j1 AS (SELECT j.*, dense_rank() OVER (ORDER BY achieved DESC NULLS LAST) AS rnk,
              {rate_expr} AS rate0 FROM j),
j2 AS (SELECT j1.*, dense_rank() OVER (ORDER BY rate0 DESC NULLS LAST) AS rate_rnk FROM j1),
rk AS (SELECT {key}, target, achieved, COALESCE(rate0, 100) AS rate, rnk, rate_rnk, revenue,
              {r_up(safe_ratio('achieved', 'revenue') + ' * 100', 2)} AS margin FROM j2)"""
    else:
        margin = f", {r_up(safe_ratio('achieved', 'revenue') + ' * 100', 2)} AS margin" if with_rev else ""
        ranked = f"""
j1 AS (SELECT j.*, {rate_expr} AS rate FROM j),
rk AS (SELECT j1.*, dense_rank() OVER (ORDER BY achieved DESC NULLS LAST) AS rnk,
              dense_rank() OVER (ORDER BY rate DESC NULLS LAST) AS rate_rnk {margin} FROM j1)"""
    tot_rev = ", sum(revenue) AS v" if with_rev else ""
    body_cols = [key, "target", "achieved", "rate", "rnk", "rate_rnk"] + (["revenue", "margin"] if with_rev else [])
    def d2(x):          # both union branches typed alike (scale 2)
        return f"CAST({x} AS DECIMAL(38,2))"
    tot_cols = (f"'{TOTAL_LABEL}' AS {key}, {d2('round_even(t, 1)')} AS target, {d2('round_even(a, 1)')} AS achieved, "
                f"{d2(r_even(safe_ratio('a', 't') + ' * 100', 1))} AS rate, rk AS rnk, 0 AS rate_rnk")
    if with_rev:
        tot_cols += (f", {d2('round_even(v, 1)')} AS revenue, "
                     f"{d2(r_even(safe_ratio('a', 'v') + ' * 100', 1))} AS margin")
    body_cols = [c if c in (key, "rnk", "rate_rnk") else f"{d2(c)} AS {c}" for c in body_cols]
    out = [f"{key}", "CAST(target AS DOUBLE) AS target", "CAST(achieved AS DOUBLE) AS achieved",
           "CAST(rate AS DOUBLE) AS rate", f"{report_pct('rate')} AS rate_pct",
           "CAST(rnk AS INTEGER) AS rank", "CAST(rate_rnk AS INTEGER) AS rate_rank"]
    if with_rev:
        out += ["CAST(revenue AS DOUBLE) AS revenue", "CAST(margin AS DOUBLE) AS margin",
                f"{report_pct('margin')} AS margin_pct"]
    out.append("is_total")
    body = f"""
sums AS (
  SELECT {key}, round_even(sum(COALESCE(profit, 0)), 2) AS achieved {rev_sum}
  FROM collected WHERE profit IS NOT NULL AND TRY_CAST(quantity AS DOUBLE) >= 1
  GROUP BY {key} {having}
),
j AS (SELECT s.*, t.target FROM sums s JOIN tgt t ON s.{key} = t.key),
{ranked},
tot AS (SELECT sum(achieved) AS a, sum(target) AS t, min(rnk) AS rk {tot_rev} FROM rk HAVING min(rnk) = 1),
u AS (
  SELECT {", ".join(body_cols)}, false AS is_total FROM rk
  UNION ALL
  SELECT {tot_cols}, true AS is_total FROM tot
)
SELECT {", ".join(out)} FROM u"""
    return with_ctes(*base_ctes(collected=True), tgt_cte(kind), body=body)


def target_status_sql(kind: str) -> str:
    cond = "lower(t.key) = lower(a.k)" if kind == "platform" else "t.key = a.k"
    body = f"""
act AS (SELECT {kind} AS k, sum(profit) AS p, sum(revenue) AS v FROM clean WHERE {kind} IS NOT NULL GROUP BY {kind}),
j AS (
  SELECT t.key AS {kind}, COALESCE(t.target, 0) AS target, COALESCE(a.p, 0) AS achieved, COALESCE(a.v, 0) AS revenue
  FROM tgt t LEFT JOIN act a ON {cond}
),
r1 AS (SELECT j.*, {sheet_ratio('achieved', 'target')} AS rate,
              {sheet_pct(sheet_ratio('achieved', 'revenue'))} AS margin_pct FROM j),
r2 AS (SELECT r1.*, {sheet_pct('rate')} AS rate_pct,
              rank() OVER (ORDER BY rate DESC NULLS LAST) AS rate_rank,
              rank() OVER (ORDER BY achieved DESC NULLS LAST) AS rnk FROM r1)
SELECT {kind}, CAST(target AS DOUBLE) AS target, CAST(achieved AS DOUBLE) AS achieved,
       CAST(revenue AS DOUBLE) AS revenue, rate, rate_pct, margin_pct,
       CAST(rate_rank AS BIGINT) AS rate_rank, CAST(rnk AS BIGINT) AS rank, false AS is_total FROM r2
UNION ALL
SELECT '{TOTAL_LABEL}', CAST(sum(target) AS DOUBLE), CAST(sum(achieved) AS DOUBLE), CAST(sum(revenue) AS DOUBLE),
       CAST(NULL AS DOUBLE), CAST(NULL AS VARCHAR), CAST(NULL AS VARCHAR),
       CAST(sum(rate_rank) AS BIGINT), CAST(sum(rnk) AS BIGINT), true FROM r2"""
    return with_ctes(*base_ctes(clean=True), tgt_cte(kind), body=body)


# ------------------------------------------------------------------ compare
MEASURES = ["profit", "revenue", "quantity"]
PERIODS = ("new", "old")


def _period_aggs() -> str:
    parts = []
    for p in PERIODS:
        cond = "is_new" if p == "new" else "NOT is_new"
        parts.append(f"count(*) FILTER (WHERE {cond}) AS n_{p}")
        for m in MEASURES:
            parts.append(f"sum({m}) FILTER (WHERE {cond}) AS s_{m}_{p}")
            parts.append(f"count({m}) FILTER (WHERE {cond}) AS c_{m}_{p}")
    return ",\n    ".join(parts)


def _compare_cols(keys: list[str], bprefix: str = "") -> str:
    """Sheet columns from the per-period sums; absent period -> 0 / '0'."""
    cols = list(keys)
    for p in PERIODS:
        pres = f"n_{p} > 0"
        for m in MEASURES:
            cols.append(f"CASE WHEN {pres} THEN COALESCE(s_{m}_{p}, 0) ELSE 0 END AS {m}_{p}")
        ratio = sheet_ratio(f"COALESCE(s_profit_{p}, 0)", f"COALESCE(s_revenue_{p}, 0)")
        cols.append(f"CASE WHEN {pres} THEN {sheet_pct(ratio)} ELSE '0' END AS margin_{p}")
        for m in MEASURES:
            avg = r_up(f"CAST({bprefix}s_{m}_{p} AS DOUBLE) / NULLIF(CAST({bprefix}c_{m}_{p} AS DOUBLE), 0)", 2)
            cols.append(f"CASE WHEN {pres} THEN COALESCE({avg}, 0) ELSE 0 END AS avg_{m}_{p}")
    cols.append("COALESCE(s_profit_new, 0) - COALESCE(s_profit_old, 0) AS growth")
    gr = (f"CASE WHEN n_new = 0 OR n_old = 0 THEN 0.0 ELSE "
          f"{sheet_ratio('COALESCE(s_profit_new, 0) - COALESCE(s_profit_old, 0)', 'COALESCE(s_profit_old, 0)')} END")
    cols.append(f"{sheet_pct(gr)} AS growth_rate")
    return ",\n    ".join(cols)


SUM_COLS = [f"{m}_{p}" for p in PERIODS for m in MEASURES] + [f"avg_{m}_{p}" for p in PERIODS for m in MEASURES]
SUM_COLS = [c for p in PERIODS for c in ([f"{m}_{p}" for m in MEASURES] + [f"avg_{m}_{p}" for m in MEASURES])] + ["growth"]
OUT_ORDER = ([f"{m}_new" for m in MEASURES] + ["margin_new"] + [f"avg_{m}_new" for m in MEASURES]
             + [f"{m}_old" for m in MEASURES] + ["margin_old"] + [f"avg_{m}_old" for m in MEASURES]
             + ["growth", "growth_rate"])


def _present_cols(keys: list[str]) -> str:
    out = list(keys)
    for c in OUT_ORDER:
        out.append(c if c.startswith("margin") or c == "growth_rate" else f"CAST({c} AS DOUBLE) AS {c}")
    out.append("is_total")
    return ", ".join(out)


def _slice(src: str, key_expr: str) -> str:
    b = period_bounds(AS_OF)
    return (f"SELECT {key_expr}, order_date >= {d(b['new_start'])} AS is_new, profit, revenue, quantity, *"
            f" EXCLUDE (profit, revenue, quantity) FROM {src}"
            f" WHERE order_date BETWEEN {d(b['old_start'])} AND {d(b['new_end'])}")


def week_compare_sql(key: str) -> str:
    key_expr = "lower(store) AS k" if key == "store" else f"{key} AS k"
    tot = ", ".join(f"round(sum({c}), 2) AS {c}" for c in SUM_COLS)
    text_nulls = "CAST(NULL AS VARCHAR) AS margin_new, CAST(NULL AS VARCHAR) AS margin_old, CAST(NULL AS VARCHAR) AS growth_rate"
    body = f"""
sl AS ({_slice('clean', key_expr)}),
agg AS (SELECT k, {_period_aggs()} FROM sl WHERE k IS NOT NULL GROUP BY k),
rows AS (SELECT k AS {key}, {_compare_cols([])}, false AS is_total FROM agg),
tot AS (SELECT '{TOTAL_LABEL}' AS {key}, {tot}, {text_nulls}, true AS is_total FROM rows),
u AS (SELECT * FROM rows UNION ALL BY NAME SELECT * FROM tot)
SELECT {_present_cols([key])} FROM u"""
    return with_ctes(*base_ctes(clean=True), body=body)


DIMENSIONS = {"product": "product", "brand": "product1_brand", "category": "product1_category"}


def store_dimension_compare_sql() -> str:
    unions = " UNION ALL ".join(
        f"SELECT store, is_new, profit, revenue, quantity, '{name}' AS dimension, CAST({col} AS VARCHAR) AS value FROM sl"
        for name, col in DIMENSIONS.items())
    base = []
    for p in PERIODS:
        for m in MEASURES:
            base.append(f"sum(s_{m}_{p}) OVER w AS bs_{m}_{p}")
            base.append(f"sum(c_{m}_{p}) OVER w AS bc_{m}_{p}")
    tot = ", ".join(f"round(sum({c}), 2) AS {c}" for c in SUM_COLS)
    fill = ", ".join(f"COALESCE(t.{c}, 0) AS {c}" for c in SUM_COLS)
    text_nulls = "CAST(NULL AS VARCHAR) AS margin_new, CAST(NULL AS VARCHAR) AS margin_old, CAST(NULL AS VARCHAR) AS growth_rate"
    dims = ", ".join(f"('{n}')" for n in DIMENSIONS)
    body = f"""
sl AS ({_slice('(SELECT * REPLACE (lower(store) AS store) FROM clean)', 'store AS k')}),
lng AS (SELECT * FROM ({unions}) x WHERE value IS NOT NULL),
agg0 AS (SELECT store, dimension, value, {_period_aggs()} FROM lng GROUP BY store, dimension, value),
agg AS (SELECT agg0.*, {", ".join(base)} FROM agg0 WINDOW w AS (PARTITION BY dimension, value)),
rows AS (SELECT {_compare_cols(['store', 'dimension', 'value'], bprefix='b')}, false AS is_total
         FROM agg WHERE store IS NOT NULL),
tots AS (SELECT store, dimension, {tot} FROM rows GROUP BY store, dimension),
stores AS (SELECT DISTINCT lower(store) AS store FROM clean WHERE store IS NOT NULL),
grid AS (SELECT s.store, v.dimension FROM stores s, (VALUES {dims}) v(dimension)),
tot AS (SELECT g.store, g.dimension, '{TOTAL_LABEL}' AS value, {fill}, {text_nulls}, true AS is_total
        FROM grid g LEFT JOIN tots t ON g.store = t.store AND g.dimension = t.dimension),
u AS (SELECT * FROM rows UNION ALL BY NAME SELECT * FROM tot)
SELECT {_present_cols(['store', 'dimension', 'value'])} FROM u"""
    return with_ctes(*base_ctes(clean=True), body=body)


def entity_compare_sql() -> str:
    """The per-value comparison of stores, platforms and operators."""
    entities = ("store", "platform", "operator")
    lines = " UNION ALL ".join(
        f"SELECT '{e}' AS entity, CAST({e} AS VARCHAR) AS key, is_new, profit, revenue, quantity, '{name}' AS dimension, CAST({col} AS VARCHAR) AS value FROM sl"
        for e in entities for name, col in DIMENSIONS.items())
    base = ", ".join(f"sum(s_{m}_{p}) OVER w AS bs_{m}_{p}, sum(c_{m}_{p}) OVER w AS bc_{m}_{p}" for p in PERIODS for m in MEASURES)
    tot = ", ".join(f"round(sum({c}), 2) AS {c}" for c in SUM_COLS)
    fill = ", ".join(f"COALESCE(t.{c}, 0) AS {c}" for c in SUM_COLS)
    text_nulls = "CAST(NULL AS VARCHAR) AS margin_new, CAST(NULL AS VARCHAR) AS margin_old, CAST(NULL AS VARCHAR) AS growth_rate"
    dims = ", ".join(f"('{n}')" for n in DIMENSIONS)
    keys = ["entity", "key", "dimension", "value"]
    members = " UNION ".join(f"SELECT '{e}' AS entity, {f'lower({e})' if e == 'store' else e} AS key FROM clean WHERE {e} IS NOT NULL" for e in entities)
    body = f"""
sl AS (SELECT * REPLACE (lower(store) AS store), order_date >= {d(period_bounds(AS_OF)['new_start'])} AS is_new FROM clean
       WHERE order_date BETWEEN {d(period_bounds(AS_OF)['old_start'])} AND {d(period_bounds(AS_OF)['new_end'])}),
lng AS (SELECT * FROM ({lines}) x WHERE value IS NOT NULL),
agg0 AS (SELECT {", ".join(keys)}, {_period_aggs()} FROM lng GROUP BY {", ".join(keys)}),
agg AS (SELECT agg0.*, {base} FROM agg0 WINDOW w AS (PARTITION BY entity, dimension, value)),
rows AS (SELECT {_compare_cols(keys, bprefix='b')}, false AS is_total FROM agg WHERE key IS NOT NULL),
tots AS (SELECT entity, key, dimension, {tot} FROM rows GROUP BY entity, key, dimension),
grid AS (SELECT m.entity, m.key, v.dimension FROM ({members}) m, (VALUES {dims}) v(dimension)),
tot AS (SELECT g.entity, g.key, g.dimension, '{TOTAL_LABEL}' AS value, {fill}, {text_nulls}, true AS is_total
        FROM grid g LEFT JOIN tots t ON g.entity = t.entity AND g.key = t.key AND g.dimension = t.dimension),
u AS (SELECT * FROM rows UNION ALL BY NAME SELECT * FROM tot)
SELECT {_present_cols(keys)} FROM u"""
    return with_ctes(*base_ctes(clean=True), body=body)


def movers_sql(kind: str, which: str) -> str:
    if kind == "store":
        inner = week_compare_sql("store")
        k, n = "store", 5
        cols = "store, growth, growth_rate"
        enrich = ("LEFT JOIN sdim d ON lower(m.store) = lower(d.store)", "d.department, d.platform, d.operator")
    else:
        inner = week_compare_sql("product")
        k, n = "product", 10
        cols = "product, profit_new, quantity_new, growth, growth_rate"
        enrich = ("LEFT JOIN goods g ON m.product = g.sku", "g.manager")
    order = f"growth DESC, {k} ASC" if which == "top" else f"growth ASC, {k} DESC"
    head, final = split_select(inner)
    return (f"WITH {head},\ncmp AS ({final}),\n"
            f"m AS (SELECT {cols} FROM cmp WHERE NOT is_total ORDER BY {order} LIMIT {n})\n"
            f"SELECT m.*, {enrich[1]} FROM m {enrich[0]}")


# ------------------------------------------------------------------ collect / clean
def clean_sql() -> str:
    cols = ("CAST(order_date AS VARCHAR) AS order_date, * EXCLUDE (order_date) REPLACE ("
            + ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in MONEY + ["corrected_profit"]) + ")")
    return with_ctes(*base_ctes(clean=True), body=f"SELECT {cols} FROM clean")


def _present_raw(src: str, money_cols: list[str]) -> str:
    rep = ", ".join([f"CAST({c} AS DOUBLE) AS {c}" for c in money_cols]
                    + ["CAST(order_date AS VARCHAR) AS order_date", "CAST(ship_date AS VARCHAR) AS ship_date"])
    return f"SELECT * REPLACE ({rep}) FROM {src}"


RAW_DECIMALS = ["unit_price_cny", "revenue", "cost_price", "cost_total", "handling_fee", "freight_last",
                "capital_cost", "profit"]


def collect_sql() -> str:
    return with_ctes(*base_ctes(collected=True), body=_present_raw("collected", RAW_DECIMALS))


def merge_snapshots_sql() -> str:
    body = f"""
older AS (SELECT * FROM collected WHERE order_date < DATE '1998-01-01'),
newer AS (SELECT * EXCLUDE (payment_status) FROM collected WHERE order_date >= DATE '1997-07-01'),
u AS (SELECT * FROM newer UNION ALL BY NAME SELECT * FROM older)
{_present_raw('u', RAW_DECIMALS)}"""
    return with_ctes(*base_ctes(collected=True), body=body)


def repair_sql() -> str:
    body = ("SELECT r.* REPLACE (lower(r.store) AS store), d.department, d.platform, d.operator "
            "FROM raw r LEFT JOIN sdim d ON lower(r.store) = lower(d.store)")
    return with_ctes(*base_ctes(), f"repaired AS ({body})", body=_present_raw("repaired", RAW_DECIMALS))


def report_sql() -> dict[str, str]:
    return {
        "platform_attainment": attainment_sql("platform"),
        "department_attainment": attainment_sql("department"),
        "operator_attainment": attainment_sql("operator"),
        "target_status_platform": target_status_sql("platform"),
        "target_status_department": target_status_sql("department"),
        "target_status_operator": target_status_sql("operator"),
        "store_week_compare": week_compare_sql("store"),
        "product_week_compare": week_compare_sql("product"),
        "store_dimension_week_compare": store_dimension_compare_sql(),
        "entity_dimension_week_compare": entity_compare_sql(),
        "store_movers_top": movers_sql("store", "top"),
        "store_movers_bottom": movers_sql("store", "bottom"),
        "product_movers_top": movers_sql("product", "top"),
        "product_movers_bottom": movers_sql("product", "bottom"),
        "clean_orders": clean_sql(),
        "collect_orders": collect_sql(),
        "merge_snapshots": merge_snapshots_sql(),
        "repair_orders": repair_sql(),
    }


def all_sql() -> dict[str, str]:
    from .feature_queries import feature_sql
    from .operator_queries import operator_sql
    return {**report_sql(), **operator_sql(), **feature_sql()}
