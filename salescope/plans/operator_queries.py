"""Queries exposing single operators of the inventory that the
composed reports do not show alone. Each runs over the whole provided
tables; each has its SQL twin in ``operator_sql`` except ``row_uuid``
(random by definition: row-count check only).
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numeric as fn
from ..functions import text as tx
from ..operators import cleaning as cl
from ..operators.dims import attach_goods, attach_store_dim, store_is_broadcast
from ..operators.fills import fill_numeric, fill_text, round_money, zero_if_null
from ..operators.filters import drop_null_keys, period_slice, quantity_filter, target_snapshot
from ..operators.ranking import competition_rank_desc, dense_rank_desc
from ..operators.setops import distinct_values, positional, rename, reorder, union_by_name
from ..operators.totals import append_total, sheet_total_rows
from ..schema import DEFAULT_SNAPSHOT, MONEY, TARGET_KINDS
from ..sources import testbed as tb
from . import compare
from .catalog import cleaned, cleaned_lines, collected, presentable, raw
from . import oracle as o

KEYS = ["order_no", "product"]


def _money_parsed(spark, d) -> DataFrame:
    return cl.convert_money_text(raw(spark, d))


def q_clean_money(spark, d):
    df = round_money(_money_parsed(spark, d), MONEY)
    return presentable(df.select(*KEYS, *MONEY))


def q_iso_week(spark, d):
    r = raw(spark, d)
    return presentable(cl.add_iso_week(r).select(*KEYS, "order_date", "week"))


def q_loss_flag(spark, d):
    df = cl.loss_flag(round_money(_money_parsed(spark, d), MONEY))
    return presentable(df.select(*KEYS, "profit", "is_loss"))


def q_corrected_profit(spark, d):
    # on parsed but unfilled money columns: null costs are skipped
    df = cl.corrected_profit(_money_parsed(spark, d))
    return presentable(df.select(*KEYS, "revenue", "freight_first", "freight_last", "corrected_profit"))


def q_row_margin(spark, d):
    return presentable(cl.row_margin(cleaned(spark, d)).select(*KEYS, "profit", "revenue", "margin"))


def q_hk_fee(spark, d):
    return cl.hk_fee(raw(spark, d)).select(*KEYS, "warehouse", "hk_handling_fee")


def q_store_join(spark, d):
    r = raw(spark, d).select(*KEYS, "store")
    return attach_store_dim(r, tb.store_dim(spark, d), case_insensitive=True)


def q_goods_join(spark, d):
    r = raw(spark, d).select(*KEYS, "product2")
    g = tb.goods_dim(spark, d)
    return attach_goods(attach_goods(r, g, "product", "product1"), g, "product2", "product2")


def q_quantity_filter(spark, d):
    r = raw(spark, d).select(*KEYS, F.col("quantity").cast("string").alias("quantity"))
    return quantity_filter(r)


def _all_targets(spark, d) -> DataFrame:
    return union_by_name([tb.targets(spark, d, k).withColumn("kind", F.lit(k)) for k in TARGET_KINDS])


def q_target_snapshot(spark, d):
    t = _all_targets(spark, d)
    return presentable(union_by_name([
        target_snapshot(t.where(F.col("kind") == k), DEFAULT_SNAPSHOT).withColumn("kind", F.lit(k))
        for k in TARGET_KINDS]))


def q_literal_targets(spark, d):
    return _all_targets(spark, d).select("kind", "snapshot", "key", "target")


def q_period_slice(spark, d):
    s = period_slice(cleaned(spark, d), tb.AS_OF)
    return presentable(s.select(*KEYS, "order_date", "is_new"))


def q_null_key_drop(spark, d):
    return drop_null_keys(raw(spark, d).select(*KEYS, "product2"), ["product2"])


def q_distinct_stores(spark, d):
    c = cleaned(spark, d).select(F.lower("store").alias("store"))
    return distinct_values(c, "store")


def _actual(spark, d, key: str) -> DataFrame:
    return (cleaned(spark, d).where(F.col(key).isNotNull())
            .groupBy(key).agg(F.sum("profit").alias("achieved"), F.sum("revenue").alias("revenue")))


def q_rank_dense(spark, d):
    a = _actual(spark, d, "operator")
    a = dense_rank_desc(a, "achieved", "rank")
    return presentable(a.select("operator", "achieved", "rank"))


def q_rank_min(spark, d):
    a = _actual(spark, d, "department")
    a = competition_rank_desc(a, "achieved", "rank")
    return presentable(a.select("department", "achieved", F.col("rank").cast("bigint").alias("rank")))


def q_total_row(spark, d):
    rows = (cleaned(spark, d).where(F.col("platform").isNotNull()).groupBy("platform")
            .agg(F.sum("profit").alias("profit"), F.sum("revenue").alias("revenue"),
                 F.sum("quantity").alias("quantity")))
    total = sheet_total_rows(rows, "platform", ["profit", "revenue", "quantity"], round_scale=2)
    return presentable(append_total(rows, total))


def q_clean_text(spark, d):
    r = raw(spark, d)
    return presentable(r.select(
        tx.id_text(r, "order_no").alias("order_no"), tx.id_text(r, "tracking_no").alias("tracking_no"),
        F.upper("country").alias("country"), F.lower("store").alias("store"),
        tx.parse_date(r, "order_date").alias("order_date")))


def q_round_modes(spark, d):
    c = cleaned(spark, d)
    x = fn.safe_ratio("profit", "quantity")
    return presentable(c.select(
        *KEYS, x.alias("unit_profit"),
        fn.round_half_up(x, 2).alias("half_up_2"),
        fn.round_half_even(x, 2).alias("half_even_2"),
        fn.round_half_even(x, 1).alias("half_even_1")))


def q_percent_text(spark, d):
    c = cleaned(spark, d)
    return c.select(
        *KEYS,
        fn.sheet_pct_text(fn.sheet_ratio("profit", "revenue")).alias("sheet_pct"),
        fn.report_pct_text(fn.round_half_up(fn.safe_ratio("profit", "revenue") * 100, 2)).alias("report_pct"))


def _targets_vs_actual(spark, d, key: str) -> DataFrame:
    t = target_snapshot(tb.targets(spark, d, key), DEFAULT_SNAPSHOT)
    a = _actual(spark, d, key)
    return t.join(a, t["key"] == a[key], "left").select(t["key"].alias(key), "target", "achieved", "revenue")


def q_ratio_safe(spark, d):
    j = _targets_vs_actual(spark, d, "operator")
    return j.select("operator",
                    fn.safe_ratio("achieved", "target").alias("rate"),
                    fn.sheet_ratio("achieved", "target").alias("sheet_rate"),
                    fn.safe_ratio("achieved", "revenue").alias("margin"))


def q_growth(spark, d):
    s = period_slice(cleaned(spark, d), tb.AS_OF).where(F.col("product1_category").isNotNull())
    g = s.groupBy(F.col("product1_category").alias("category")).agg(
        F.sum(F.when(F.col("is_new"), F.col("profit"))).alias("profit_new"),
        F.sum(F.when(~F.col("is_new"), F.col("profit"))).alias("profit_old"))
    return presentable(g.select("category", "profit_new", "profit_old",
                                fn.growth("profit_new", "profit_old").alias("growth"),
                                fn.growth_rate("profit_new", "profit_old").alias("growth_rate")))


def q_fill_rules(spark, d):
    j = _targets_vs_actual(spark, d, "operator")
    j = j.select("operator", "target", zero_if_null("achieved").alias("achieved"), "revenue",
                 fn.round_half_up(fn.safe_ratio("achieved", "target") * 100, 2).alias("rate"))
    j = j.withColumn("rate_pct", fn.report_pct_text(F.col("rate")))
    j = fill_numeric(j, 100, ["rate"])                         # P15
    j = fill_text(j, "0", ["rate_pct"])                        # P14
    return presentable(j)


def q_union_by_name(spark, d):
    c = collected(spark, d)
    older = reorder(c.where(F.col("order_date") < F.lit("1998-01-01").cast("date")),
                    ["order_no", "store", "profit"])
    newer = rename(positional(c.where(F.col("order_date") >= F.lit("1997-07-01").cast("date"))
                              .select("store", "order_no", "revenue"), ["shop", "order_no", "revenue"]),
                   {"shop": "store"})
    return presentable(union_by_name([newer, older], allow_missing=True))


def q_fan_out_summary(spark, d):
    r = compare.store_dimension_week_compare(cleaned(spark, d), tb.AS_OF)
    body = r.where(~F.col("is_total"))
    return presentable(body.groupBy("store", "dimension").agg(
        F.count(F.lit(1)).alias("values"), F.sum("growth").alias("growth")))


def q_row_uuid(spark, d):
    return cl.row_uuid(cleaned(spark, d)).select(*KEYS, "uuid")


def q_csv_round_trip(spark, d):
    from ..sinks.files import write_csv
    from ..sources.files import read_order_files
    from ..session import scratch_path
    from ..schema import ORDER_COLS
    path = scratch_path(spark, "csv-round-trip")
    write_csv(collected(spark, d), path, compression="gzip")
    return read_order_files(spark, path, columns=ORDER_COLS, header=True)


def q_partitioned_round_trip(spark, d):
    from ..sinks.files import write_partitioned
    from ..sources.files import read_table
    from ..session import scratch_path
    path = scratch_path(spark, "partitioned-round-trip")
    rep = compare.store_dimension_week_compare(cleaned(spark, d), tb.AS_OF)
    write_partitioned(rep, path, ["store", "dimension"],
                      sort_within=[F.col("is_total"), F.col("growth").desc(), F.col("value")])
    back = read_table(spark, path, schema=rep.schema, by=["store", "dimension"])
    return presentable(back.select(*rep.columns))


def q_collect_order_files(spark, d):
    """R1 from files: raw orders as CSV files -> checked multi-file read
    (S1, S2) -> collect (J2)."""
    from ..sinks.files import write_csv
    from ..sources.files import read_order_files_checked
    from ..session import scratch_path
    from .collect import collect_orders
    path = scratch_path(spark, "order-files")
    write_csv(raw(spark, d), path, compression="gzip")
    good, _rejected = read_order_files_checked(spark, path, glob="*.csv.gz")
    return collect_orders(good.drop("source_file"), tb.store_dim(spark, d))


def q_landed_store_week_compare(spark, d):
    """R10 on the cleaned fact landed partitioned by order month: the period
    slice prunes to the month directories it needs. The order lines meet the
    goods and are dealt to their days before their columns are made."""
    from ..sinks.files import deal_by_day, write_fact
    from ..sources.files import read_fact
    from ..session import scratch_path
    path = scratch_path(spark, "landed-fact")
    cells = tb.order_cells(spark, d)
    keys = cleaned_lines(spark, d).select("order_date", "order_no")
    stores = tb.store_dim(spark, d)

    def deal(rows):
        return tb.named_lines(spark, d, deal_by_day(rows, keys, cells["order_date"], cells["order_no"]))

    lines = tb.order_lines(spark, d, named=not store_is_broadcast(stores))
    fact = cl.clean_orders(lines, stores, tb.goods_dim(spark, d), cells=cells, deal=deal)
    write_fact(fact, path, dealt=True, compression="zstd")
    return presentable(compare.store_week_compare(read_fact(spark, path).drop("order_month"), tb.AS_OF))


OPERATORS = {
    "collect_order_files": q_collect_order_files,
    "landed_store_week_compare": q_landed_store_week_compare,
    "clean_money": q_clean_money,
    "iso_week": q_iso_week,
    "loss_flag": q_loss_flag,
    "corrected_profit": q_corrected_profit,
    "row_margin": q_row_margin,
    "hk_fee": q_hk_fee,
    "store_join": q_store_join,
    "goods_join": q_goods_join,
    "quantity_filter": q_quantity_filter,
    "target_snapshot": q_target_snapshot,
    "literal_targets": q_literal_targets,
    "period_slice": q_period_slice,
    "null_key_drop": q_null_key_drop,
    "distinct_stores": q_distinct_stores,
    "rank_dense": q_rank_dense,
    "rank_min": q_rank_min,
    "total_row": q_total_row,
    "clean_text": q_clean_text,
    "round_modes": q_round_modes,
    "percent_text": q_percent_text,
    "ratio_safe": q_ratio_safe,
    "growth": q_growth,
    "fill_rules": q_fill_rules,
    "union_by_name": q_union_by_name,
    "fan_out_summary": q_fan_out_summary,
    "csv_round_trip": q_csv_round_trip,
    "partitioned_round_trip": q_partitioned_round_trip,
    "row_uuid": q_row_uuid,
}


# ---------------------------------------------------------------------- SQL
def _sql(body: str, clean: bool = False, collected_: bool = False, extra: tuple[str, ...] = ()) -> str:
    return o.with_ctes(*o.base_ctes(clean=clean, collected=collected_), *extra, body=body)


def _dbl(cols) -> str:
    return ", ".join(f"CAST({c} AS DOUBLE) AS {c}" for c in cols)


def _parsed_money_cols() -> str:
    def parse(c):
        if c == "freight_first":
            return "CAST(NULLIF(trim(freight_first), '未更新') AS DECIMAL(18,6))"
        if c == "settle_total":
            return "CAST(replace(settle_total, ',', '') AS DECIMAL(18,6))"
        return f"CAST({c} AS DECIMAL(18,6))"
    return ", ".join(f"{parse(c)} AS {c}" for c in MONEY)


def _targets_all_cte() -> list[str]:
    return [o.tgt_cte(k, suffix=f"_{k}") for k in TARGET_KINDS]


def _actual_sql(key: str) -> str:
    return (f"SELECT {key}, sum(profit) AS achieved, sum(revenue) AS revenue FROM clean "
            f"WHERE {key} IS NOT NULL GROUP BY {key}")


def _tva_sql(key: str) -> str:
    return (f"SELECT t.key AS {key}, t.target, a.achieved, a.revenue FROM tgt t "
            f"LEFT JOIN ({_actual_sql(key)}) a ON t.key = a.{key}")


def operator_sql() -> dict[str, str]:
    b = o.period_bounds(tb.AS_OF)
    pm = _parsed_money_cols()
    parsed = f"parsed AS (SELECT order_no, product, {pm} FROM raw)"
    rounded = ", ".join(f"CAST(round_even(COALESCE({c}, 0), 2) AS DECIMAL(18,2)) AS {c}" for c in MONEY)
    tall = _targets_all_cte()
    union_t = " UNION ALL ".join(f"SELECT snapshot, key, target, '{k}' AS kind FROM tgt_all_{k}" for k in TARGET_KINDS)
    snap_t = " UNION ALL ".join(
        f"SELECT key, CAST(CAST(target AS DECIMAL(18,2)) AS DOUBLE) AS target, '{k}' AS kind FROM tgt_all_{k} "
        f"WHERE snapshot = {DEFAULT_SNAPSHOT}" for k in TARGET_KINDS)
    x = "(CAST(profit AS DOUBLE) / NULLIF(quantity, 0))"
    q = {
        "clean_money": _sql(f"SELECT order_no, product, {_dbl(MONEY)} FROM (SELECT order_no, product, {rounded} FROM parsed)",
                            extra=(parsed,)),
        "iso_week": _sql("SELECT order_no, product, CAST(order_date AS VARCHAR) AS order_date, "
                         "CAST(weekofyear(order_date) AS INTEGER) AS week FROM raw"),
        "loss_flag": _sql("SELECT order_no, product, CAST(profit AS DOUBLE) AS profit, "
                          "CASE WHEN profit <= 0 THEN '是' WHEN profit > 0 THEN '否' END AS is_loss "
                          f"FROM (SELECT order_no, product, {rounded} FROM parsed)", extra=(parsed,)),
        "corrected_profit": _sql(
            "SELECT order_no, product, CAST(revenue AS DOUBLE) AS revenue, CAST(freight_first AS DOUBLE) AS freight_first, "
            "CAST(freight_last AS DOUBLE) AS freight_last, CAST(CAST(revenue - (COALESCE(cost_total, 0) + "
            "COALESCE(handling_fee, 0) + COALESCE(freight_first, 0) + COALESCE(freight_last, 0) + "
            "COALESCE(capital_cost, 0)) AS DECIMAL(18,2)) AS DOUBLE) AS corrected_profit FROM parsed", extra=(parsed,)),
        "row_margin": _sql("SELECT order_no, product, CAST(profit AS DOUBLE) AS profit, CAST(revenue AS DOUBLE) AS revenue, "
                           "CAST(profit AS DOUBLE) / NULLIF(CAST(revenue AS DOUBLE), 0) AS margin FROM clean", clean=True),
        "hk_fee": _sql("SELECT order_no, product, warehouse, CASE WHEN warehouse = '香港' THEN CAST(9.5 AS DOUBLE) END AS hk_handling_fee FROM raw"),
        "store_join": _sql("SELECT r.order_no, r.product, r.store, d.department, d.platform, d.operator "
                           "FROM raw r LEFT JOIN sdim d ON lower(r.store) = lower(d.store)"),
        "goods_join": _sql("SELECT r.order_no, r.product, r.product2, g1.id AS product1_id, g1.brand AS product1_brand, "
                           "g1.category AS product1_category, g1.manager AS product1_manager, g2.id AS product2_id, "
                           "g2.brand AS product2_brand, g2.category AS product2_category, g2.manager AS product2_manager "
                           "FROM raw r LEFT JOIN goods g1 ON r.product = g1.sku LEFT JOIN goods g2 ON r.product2 = g2.sku"),
        "quantity_filter": _sql("SELECT order_no, product, CAST(quantity AS VARCHAR) AS quantity FROM raw "
                                "WHERE TRY_CAST(CAST(quantity AS VARCHAR) AS DOUBLE) >= 1"),
        "target_snapshot": _sql(f"SELECT * FROM ({snap_t}) x", extra=tuple(tall)),
        "literal_targets": _sql(f"SELECT kind, snapshot, key, target FROM ({union_t}) x", extra=tuple(tall)),
        "period_slice": _sql(f"SELECT order_no, product, CAST(order_date AS VARCHAR) AS order_date, "
                             f"order_date >= {o.d(b['new_start'])} AS is_new FROM clean "
                             f"WHERE order_date BETWEEN {o.d(b['old_start'])} AND {o.d(b['new_end'])}", clean=True),
        "null_key_drop": _sql("SELECT order_no, product, product2 FROM raw WHERE product2 IS NOT NULL"),
        "distinct_stores": _sql("SELECT DISTINCT lower(store) AS store FROM clean", clean=True),
        "rank_dense": _sql(f"SELECT operator, CAST(achieved AS DOUBLE) AS achieved, "
                           f"CAST(dense_rank() OVER (ORDER BY achieved DESC NULLS LAST) AS INTEGER) AS rank "
                           f"FROM ({_actual_sql('operator')}) a", clean=True),
        "rank_min": _sql(f"SELECT department, CAST(achieved AS DOUBLE) AS achieved, "
                         f"CAST(rank() OVER (ORDER BY achieved DESC NULLS LAST) AS BIGINT) AS rank "
                         f"FROM ({_actual_sql('department')}) a", clean=True),
        "total_row": _sql(
            "rows AS (SELECT platform, sum(profit) AS profit, sum(revenue) AS revenue, sum(quantity) AS quantity "
            "FROM clean WHERE platform IS NOT NULL GROUP BY platform)\n"
            "SELECT platform, CAST(profit AS DOUBLE) AS profit, CAST(revenue AS DOUBLE) AS revenue, quantity, false AS is_total FROM rows "
            f"UNION ALL SELECT '{o.TOTAL_LABEL}', CAST(round(sum(profit), 2) AS DOUBLE), CAST(round(sum(revenue), 2) AS DOUBLE), "
            "round(sum(quantity), 2), true FROM rows", clean=True),
        "clean_text": _sql("SELECT COALESCE(order_no, '') AS order_no, COALESCE(tracking_no, '') AS tracking_no, "
                           "upper(country) AS country, lower(store) AS store, CAST(order_date AS VARCHAR) AS order_date FROM raw"),
        "round_modes": _sql(f"SELECT order_no, product, {x} AS unit_profit, CAST({o.r_up(x, 2)} AS DOUBLE) AS half_up_2, "
                            f"CAST({o.r_even(x, 2)} AS DOUBLE) AS half_even_2, CAST({o.r_even(x, 1)} AS DOUBLE) AS half_even_1 "
                            "FROM clean", clean=True),
        "percent_text": _sql(f"SELECT order_no, product, {o.sheet_pct(o.sheet_ratio('profit', 'revenue'))} AS sheet_pct, "
                             f"{o.report_pct(o.r_up(o.safe_ratio('profit', 'revenue') + ' * 100', 2))} AS report_pct FROM clean",
                             clean=True),
        "ratio_safe": _sql(f"SELECT operator, {o.safe_ratio('achieved', 'target')} AS rate, "
                           f"{o.sheet_ratio('achieved', 'target')} AS sheet_rate, "
                           f"{o.safe_ratio('achieved', 'revenue')} AS margin FROM ({_tva_sql('operator')}) j",
                           clean=True, extra=(o.tgt_cte("operator"),)),
        "growth": _sql(
            f"g AS (SELECT product1_category AS category, sum(profit) FILTER (WHERE order_date >= {o.d(b['new_start'])}) AS profit_new, "
            f"sum(profit) FILTER (WHERE order_date < {o.d(b['new_start'])}) AS profit_old FROM clean "
            f"WHERE order_date BETWEEN {o.d(b['old_start'])} AND {o.d(b['new_end'])} AND product1_category IS NOT NULL "
            "GROUP BY product1_category)\n"
            "SELECT category, CAST(profit_new AS DOUBLE) AS profit_new, CAST(profit_old AS DOUBLE) AS profit_old, "
            "CAST(COALESCE(profit_new, 0) - COALESCE(profit_old, 0) AS DOUBLE) AS growth, "
            f"CASE WHEN profit_new IS NULL OR profit_old IS NULL THEN 0.0 ELSE "
            f"{o.sheet_ratio('profit_new - profit_old', 'profit_old')} END AS growth_rate FROM g", clean=True),
        "fill_rules": _sql(
            f"j AS ({_tva_sql('operator')}),\n"
            f"k AS (SELECT operator, target, COALESCE(achieved, 0) AS achieved, revenue, "
            f"{o.r_up(o.safe_ratio('achieved', 'target') + ' * 100', 2)} AS rate FROM j)\n"
            f"SELECT operator, CAST(target AS DOUBLE) AS target, CAST(achieved AS DOUBLE) AS achieved, "
            f"CAST(revenue AS DOUBLE) AS revenue, CAST(COALESCE(rate, 100) AS DOUBLE) AS rate, "
            f"COALESCE({o.report_pct('rate')}, '0') AS rate_pct FROM k",
            clean=True, extra=(o.tgt_cte("operator"),)),
        "union_by_name": _sql(
            "SELECT order_no, store, CAST(profit AS DOUBLE) AS profit, CAST(NULL AS DOUBLE) AS revenue FROM collected "
            "WHERE order_date < DATE '1998-01-01' UNION ALL "
            "SELECT order_no, store, CAST(NULL AS DOUBLE), CAST(revenue AS DOUBLE) FROM collected "
            "WHERE order_date >= DATE '1997-07-01'", collected_=True),
    }
    # the per-store report as a sub-select
    head, final = o.split_select(o.store_dimension_compare_sql())
    q["fan_out_summary"] = (f"WITH {head},\nrep AS ({final})\n"
                            "SELECT store, dimension, count(*) AS \"values\", "
                            "CAST(sum(CAST(growth AS DECIMAL(28,2))) AS DOUBLE) AS growth "
                            "FROM rep WHERE NOT is_total GROUP BY store, dimension")
    q["partitioned_round_trip"] = o.store_dimension_compare_sql()
    cols = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in
                     ["order_date", "ship_date", "store", "order_no", "product", "product2", "quantity",
                      "unit_price", "currency1", "commission_rate", "settle_total", "currency2", "unit_price_cny",
                      "revenue", "cost_price", "currency3", "cost_total", "handling_fee", "freight_first",
                      "freight_last", "capital_cost", "profit", "warehouse", "country", "tracking_no",
                      "payment_status", "platform", "department", "operator"])
    q["csv_round_trip"] = _sql(f"SELECT {cols} FROM collected", collected_=True)
    q["collect_order_files"] = q["csv_round_trip"]
    q["landed_store_week_compare"] = o.week_compare_sql("store")
    return q
