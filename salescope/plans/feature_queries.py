"""Queries of whole features on data written from the provided tables: files
of many layouts, amounts that do not parse, versioned tables, daily states and
ranks of all products. Each has its SQL beside it.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..operators.cleaning import row_uuid
from ..operators.dims import attach_store_dim
from ..operators.filters import quantity_filter
from ..operators.ranking import distributed_competition_rank_desc, distributed_dense_rank_desc
from ..schema import DEFAULT_SNAPSHOT, DIM_COLS, FILE_LABELS, ORDER_COLS, RAW_ORDER_COLS, TARGET_KINDS
from ..session import scratch_path, staged
from ..sinks.files import write_clustered, write_csv, write_dealt, write_report, write_tables
from ..sinks.versioned import VersionedTable, seed
from ..sources import testbed as tb
from ..sources.files import read_order_files, read_positional, read_table, read_target
from ..sources.order_files import read_named_orders
from . import attainment, compare, oracle as o, states
from .catalog import cleaned_by_store, cleaned_by_store_and_product, cleaned_lines, collected, presentable, raw
from .collect import collect_orders, seed_targets

#: order files that are written: by the store's number
FILES = 64
#: of them, one ends in a short line and one lacks the profit
SHORT, NO_PROFIT = 7, 3


def _file_no(store: str = "store"):
    return (F.regexp_extract(store, "([0-9]+)$", 1).cast("int") % FILES).alias("file_no")


def write_layouts(spark, d, path: str) -> None:
    """The raw orders as files of three layouts: plain; a title line and the
    columns reversed; a title line and more columns. Half of them are gzip.

    The order lines are dealt to the files before their columns are spelled
    out, one file a task, whose first row brings the lines above it along: no
    row is sorted, and the lines are text only where they are written."""
    labels = [FILE_LABELS[c] for c in RAW_ORDER_COLS]
    layout = F.col("file_no") % 3
    extra = [F.lit("note, of the store").alias("extra1"), F.lit("x").alias("extra2")]

    def line(columns):
        return F.to_csv(F.struct(*columns), {"escape": '"'})

    body = F.when(layout == 0, line(RAW_ORDER_COLS)).when(layout == 1, line(RAW_ORDER_COLS[::-1])).otherwise(line([extra[0], *RAW_ORDER_COLS, extra[1]]))
    heads = [",".join(labels), ",".join(labels[::-1]), ",".join(["备注", *labels, "x"])]
    head = F.when(layout == 0, heads[0]).when(layout == 1, heads[1]).otherwise(heads[2])
    head = F.when(F.col("file_no") == NO_PROFIT, F.regexp_replace(head, FILE_LABELS["profit"], "other")).otherwise(head)
    # concat_ws leaves out what is null
    first = F.concat_ws("\n", F.when(layout > 0, F.lit("orders of a store")), head, "line", F.when(F.col("file_no") == SHORT, F.lit("2020-11-01,short")))
    for zipped in (0, 1):
        lines = tb.order_lines(spark, d)
        lines = lines.where(_file_no("s_name") % 2 == zipped).repartitionById(FILES // 2, F.shiftright(_file_no("s_name"), 1))
        cells = [F.col(c).cast("string").alias(c) for c in RAW_ORDER_COLS]
        orders = tb.order_columns(spark, d, lines).select(_file_no(), *cells)
        # the lower 33 bits are a row's number in its task
        placed = orders.select("file_no", body.alias("line"), F.monotonically_increasing_id().bitwiseAND((1 << 33) - 1).alias("at"))
        out = placed.select("file_no", F.when(F.col("at") == 0, first).otherwise(F.col("line")).alias("line"))
        write_dealt(out, f"{path}/{'gz' if zipped else 'plain'}", ["file_no"], fmt="text", compression="gzip" if zipped else "none")


def _layouts(spark, d):
    path = scratch_path(spark, "order-layouts")
    write_layouts(spark, d, path)
    return read_named_orders(spark, path, labels=FILE_LABELS, glob="part-*", recursive=True)


def q_collect_named_files(spark, d):
    """R1 from files of several layouts, by their own labels."""
    return collect_orders(_layouts(spark, d).rows, tb.store_dim(spark, d)).select(*ORDER_COLS)


def q_order_file_status(spark, d):
    """Which files were taken and why others were not."""
    files = _layouts(spark, d).files
    return files.select(F.regexp_extract("source_file", "file_no=([0-9]+)", 1).cast("int").alias("file_no"), "rows", "bad_lines", "reason")


def _text_amounts(spark, d) -> DataFrame:
    """The collected orders with amounts as text: thousands separators, and
    some cells that are no numbers."""
    n = F.col("order_no").cast("long")
    c = collected(spark, d)
    profit = F.when(n % 50 == 0, F.lit("n/a")).when(n % 50 == 1, F.lit(" ")).otherwise(F.format_number("profit", 2))
    revenue = F.when(n % 70 == 0, F.lit("9e40")).otherwise(F.concat(F.lit(" "), F.format_number("revenue", 2)))
    return c.withColumns({"profit": profit, "revenue": revenue})


def q_text_amount_attainment(spark, d):
    return attainment.platform_attainment(_text_amounts(spark, d), tb.targets(spark, d, "platform"))


def q_quarantined_amounts(spark, d):
    return attainment.unparsed_amounts(_text_amounts(spark, d))


def q_seeded_targets(spark, d):
    """Two snapshots seeded, one of them a second time with other values."""
    table = VersionedTable(spark, scratch_path(spark, "targets"), "snapshot")
    everything = None
    for kind in TARGET_KINDS:
        t = tb.targets(spark, d, kind).withColumn("key", F.concat(F.lit(f"{kind}:"), "key"))
        everything = t if everything is None else everything.unionByName(t)
    current = everything.where(F.col("snapshot") == DEFAULT_SNAPSHOT)
    seed(table, seed_targets(current.withColumn("target", F.col("target") + 1), DEFAULT_SNAPSHOT))
    seed(table, everything.where(F.col("snapshot") != DEFAULT_SNAPSHOT).select("snapshot", "key", "target"))
    seed(table, seed_targets(current, DEFAULT_SNAPSHOT))
    return table.read()


def _landed_states(spark, d) -> DataFrame:
    table = states.state_table(spark, scratch_path(spark, "daily-states"))
    states.land_days(table, cleaned_by_store_and_product(spark, d))
    return table.read()


def q_state_store_week_compare(spark, d):
    return presentable(states.reports(_landed_states(spark, d), tb.AS_OF)["store_week_compare"])


def q_state_entity_week_compare(spark, d):
    return presentable(states.reports(_landed_states(spark, d), tb.AS_OF)["entity_dimension_week_compare"])


def q_product_ranks(spark, d):
    """W1-W4 over every product: profit ranks without a single-task sort."""
    path = scratch_path(spark, "product-profits")
    cleaned_lines(spark, d).groupBy("product").agg(F.sum("profit").alias("profit")).write.parquet(path)
    sums = spark.read.parquet(path)
    out = distributed_dense_rank_desc(sums, "profit", "dense_rank")
    return presentable(distributed_competition_rank_desc(out, "profit", "competition_rank"))


def q_positional_files(spark, d):
    """Header-less files read by position; the header lines that
    arrive as rows fall to the quantity filter."""
    path = scratch_path(spark, "positional")
    write_csv(collected(spark, d), path, compression="gzip")
    return quantity_filter(read_positional(spark, path))


def q_target_files(spark, d):
    """Targets of one snapshot from stored tables."""
    out = None
    for kind in TARGET_KINDS:
        path = scratch_path(spark, f"targets-{kind}")
        write_report(tb.targets(spark, d, kind), path)
        t = read_target(spark, path, DEFAULT_SNAPSHOT).withColumn("kind", F.lit(kind))
        out = t if out is None else out.unionByName(t)
    return presentable(out)


def q_export_tables(spark, d):
    """The fact and three status sheets side by side,
    each read back; the fact written in two appends."""
    base = scratch_path(spark, "export")
    fact = staged(cleaned_by_store(spark, d), "export-fact")             # five jobs read it
    write_tables({f"{k}_status": attainment.target_status(fact, tb.targets(spark, d, k), k) for k in TARGET_KINDS}, base)
    early = F.col("order_date") < F.lit("1998-01-01").cast("date")
    write_report(fact.where(early), f"{base}/orders")
    write_report(fact.where(~early), f"{base}/orders", mode="append")
    out = read_table(spark, f"{base}/orders").agg(
        F.lit("orders").alias("name"), F.count(F.lit(1)).alias("rows"), F.sum("profit").cast("double").alias("profit"))
    for k in TARGET_KINDS:
        t = read_table(spark, f"{base}/{k}_status").where(~F.col("is_total"))
        out = out.unionByName(t.agg(F.lit(f"{k}_status").alias("name"), F.count(F.lit(1)).alias("rows"),
                                    F.sum(F.col("achieved").cast("decimal(28,2)")).cast("double").alias("profit")))
    return out


def q_unique_row_ids(spark, d):
    """every row has an id of its own, the same each time it is read."""
    path = scratch_path(spark, "row-ids")
    row_uuid(collected(spark, d)).select("order_no", "uuid").write.parquet(path)
    return spark.read.parquet(path).agg(F.count(F.lit(1)).alias("rows"), F.count_distinct("uuid").alias("ids"))


def q_ordered_csv(spark, d):
    """O3: the collected fact as CSV in order of date; per file the rows, the
    steps back inside it, and whether it begins before the last one ends. The
    order lines have their store's columns when they are put in order, and are
    spelled out where they are written."""
    path = scratch_path(spark, "ordered-csv")
    lines = attach_store_dim(tb.order_lines(spark, d), tb.store_dim(spark, d), store_col="s_name")
    cells = tb.order_cells(spark, d)
    write_csv(lines, path, order_by=[cells["order_date"], cells["order_no"]], compression="gzip",
              spell=lambda rows: collect_orders(tb.order_columns(spark, d, rows, keep=tuple(DIM_COLS)), None))
    rows = read_order_files(spark, path, columns=ORDER_COLS, with_source=True).withColumn("at", F.monotonically_increasing_id())
    in_file = Window.partitionBy("source_file").orderBy("at")
    steps = rows.select("source_file", "order_date", F.lag("order_date").over(in_file).alias("before"))
    files = steps.groupBy("source_file").agg(F.count(F.lit(1)).alias("n"), F.sum((F.col("before") > F.col("order_date")).cast("long")).alias("back"),
                                             F.min("order_date").alias("low"), F.max("order_date").alias("high"))
    # one row a file
    follow = files.select("*", F.lag("high").over(Window.orderBy("source_file")).alias("last"))
    return follow.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("rows"), F.coalesce(F.sum("back"), F.lit(0)).alias("steps_back"), F.coalesce(F.sum((F.col("last") > F.col("low")).cast("long")), F.lit(0)).alias("overlaps"))


def q_clustered_store_week_compare(spark, d):
    """R10 on the fact landed in z-order over date and store."""
    path = scratch_path(spark, "clustered-fact")
    write_clustered(cleaned_lines(spark, d), path, ["order_date", "store"])
    return presentable(compare.store_week_compare(read_table(spark, path), tb.AS_OF))


def q_report_order(spark, d):
    """The place of each row in the reports' own order."""
    sold = staged(collected(spark, d).select("platform", "department", "quantity", "profit", "revenue"), "order-sold")   # two reports read it
    reports = {
        "platform_attainment": (attainment.platform_attainment(sold, tb.targets(spark, d, "platform")), "platform"),
        "department_attainment": (attainment.department_attainment(sold, tb.targets(spark, d, "department")), "department"),
        "target_status": (attainment.target_status(cleaned_by_store(spark, d), tb.targets(spark, d, "operator"), "operator"), "operator"),
        "store_week_compare": (compare.store_week_compare(cleaned_lines(spark, d), tb.AS_OF), "store"),
    }
    out = None
    for name, (report, key) in reports.items():
        # one file, in the report's order: at most a row per key of a dimension
        path = scratch_path(spark, f"order-{name}")
        report.select(F.col(key).alias("key")).coalesce(1).write.parquet(path)
        placed = spark.read.parquet(path).select(F.lit(name).alias("report"), "key", (F.col("_metadata.row_index") + 1).cast("long").alias("place"))
        out = placed if out is None else out.unionByName(placed)
    return out


FEATURES = {
    "positional_files": q_positional_files,
    "target_files": q_target_files,
    "export_tables": q_export_tables,
    "unique_row_ids": q_unique_row_ids,
    "ordered_csv": q_ordered_csv,
    "clustered_store_week_compare": q_clustered_store_week_compare,
    "report_order": q_report_order,
    "collect_named_files": q_collect_named_files,
    "order_file_status": q_order_file_status,
    "text_amount_attainment": q_text_amount_attainment,
    "quarantined_amounts": q_quarantined_amounts,
    "seeded_targets": q_seeded_targets,
    "state_store_week_compare": q_state_store_week_compare,
    "state_entity_week_compare": q_state_entity_week_compare,
    "product_ranks": q_product_ranks,
}


def feature_sql() -> dict[str, str]:
    text = ", ".join(f"CAST({c} AS VARCHAR) AS {c}" for c in ORDER_COLS)
    number = f"(CAST(regexp_extract(store, '([0-9]+)$', 1) AS INTEGER) % {FILES})"
    n = "CAST(order_no AS BIGINT)"
    amounts = (f"SELECT * REPLACE (CASE WHEN {n} % 50 IN (0, 1) THEN 0 ELSE profit END AS profit, "
               f"CASE WHEN {n} % 70 = 0 THEN 0 ELSE revenue END AS revenue) FROM collected")
    attained = o.attainment_sql("platform").replace("FROM collected WHERE", f"FROM ({amounts}) WHERE")
    kinds = " UNION ALL ".join(f"SELECT snapshot, '{k}:' || key AS key, target FROM tgt_all_{k}" for k in TARGET_KINDS)
    exported = ["SELECT 'orders' AS name, count(*) AS rows, CAST(sum(profit) AS DOUBLE) AS profit FROM clean"] + [
        f"SELECT '{k}_status', count(*), CAST(sum(COALESCE(p, 0)) AS DOUBLE) FROM tgt_{k} t LEFT JOIN "
        f"(SELECT {k} AS k, sum(profit) AS p FROM clean WHERE {k} IS NOT NULL GROUP BY {k}) a ON lower(t.key) = lower(a.k)" for k in TARGET_KINDS]
    order = {"platform_attainment": (o.attainment_sql("platform"), "platform", "rank, platform"), "department_attainment": (o.attainment_sql("department"), "department", "rank, department"),
             "target_status": (o.target_status_sql("operator"), "operator", "rank, operator"), "store_week_compare": (o.week_compare_sql("store"), "store", "growth DESC, store")}
    placed = " UNION ALL ".join(f"SELECT '{n}' AS report, {k} AS key, row_number() OVER (ORDER BY is_total, {by}) AS place FROM ({q}) q_{n}" for n, (q, k, by) in order.items())
    return {
        "positional_files": o.with_ctes(*o.base_ctes(collected=True), body=f"SELECT {text} FROM collected WHERE quantity >= 1"),
        "target_files": " UNION ALL ".join(f"SELECT * FROM ({o.with_ctes(o.tgt_cte(k), body=f"SELECT key, CAST(target AS DOUBLE) AS target, '{k}' AS kind FROM tgt")}) t_{k}" for k in TARGET_KINDS),
        "export_tables": o.with_ctes(*o.base_ctes(clean=True), *[o.tgt_cte(k, suffix=f"_{k}") for k in TARGET_KINDS], body=" UNION ALL ".join(exported)),
        "unique_row_ids": o.with_ctes(*o.base_ctes(), body="SELECT count(*) AS rows, count(*) AS ids FROM raw"),
        "ordered_csv": o.with_ctes(*o.base_ctes(), body="SELECT count(*) AS rows, CAST(0 AS BIGINT) AS steps_back, CAST(0 AS BIGINT) AS overlaps FROM raw"),
        "clustered_store_week_compare": o.week_compare_sql("store"),
        "report_order": placed,
        "collect_named_files": o.with_ctes(*o.base_ctes(collected=True), body=f"SELECT {text} FROM collected WHERE {number} NOT IN ({SHORT}, {NO_PROFIT})"),
        "order_file_status": o.with_ctes(*o.base_ctes(), body=(
            f"SELECT {number} AS file_no, CASE WHEN {number} IN ({SHORT}, {NO_PROFIT}) THEN 0 ELSE count(*) END AS rows, "
            f"CAST(CASE WHEN {number} = {SHORT} THEN 1 ELSE 0 END AS BIGINT) AS bad_lines, "
            f"CASE {number} WHEN {SHORT} THEN '1 lines are not as wide as the header' WHEN {NO_PROFIT} THEN 'lacks {FILE_LABELS['profit']}' END AS reason "
            f"FROM raw GROUP BY {number}")),
        "text_amount_attainment": attained,
        "quarantined_amounts": o.with_ctes(*o.base_ctes(collected=True), body=(
            f"SELECT order_no, product, 'profit' AS \"column\", 'n/a' AS \"text\", 'not a number' AS reason FROM collected WHERE {n} % 50 = 0 AND quantity >= 1 "
            f"UNION ALL SELECT order_no, product, 'revenue', '9e40', 'out of range' FROM collected WHERE {n} % 70 = 0 AND quantity >= 1")),
        "seeded_targets": o.with_ctes(*o.base_ctes(), *[o.tgt_cte(k, suffix=f"_{k}") for k in TARGET_KINDS], body=f"SELECT * FROM ({kinds}) x"),
        "state_store_week_compare": o.week_compare_sql("store"),
        "state_entity_week_compare": o.entity_compare_sql(),
        "product_ranks": o.with_ctes(*o.base_ctes(clean=True), body=(
            "SELECT product, CAST(profit AS DOUBLE) AS profit, CAST(dense_rank() OVER (ORDER BY profit DESC) AS INTEGER) AS dense_rank, "
            "CAST(rank() OVER (ORDER BY profit DESC) AS INTEGER) AS competition_rank FROM (SELECT product, sum(profit) AS profit FROM clean GROUP BY product) s")),
    }
