"""Adapter from the provided star-schema tables to the order data model.

The provided parquet tables (``lineitem orders part supplier customer nation
region``) stand in for the collected order workbooks:

* one lineitem row is one order line; the supplier is the store,
* the store dimension is supplier -> nation (department) -> region
  (platform), the operator is derived from the supplier number,
* the goods dimension is the part table,
* targets are derived from the dimension keys (a multiple of the key number,
  so one key has a zero target) with one key left without a target, in two
  snapshots of which the reports use one.

Every frame here is lazy and grows with the input tables. Nation and region
have a fixed size (25 and 5 rows) and are hinted for broadcast, the supplier
names only after a bounded count; every other join is left to the
planner and AQE's runtime sizes. The order lines, by far the widest and longest
side, are shuffled twice, by order and by part: the customers are joined to the
orders, which are fewer and narrower, and the supplier names to the lines last,
or first where they cannot be broadcast.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dims import checked_broadcast
from ..session import session_key
from .files import ensure_parallelism, scan_splits
from ..schema import DEFAULT_SNAPSHOT, MONEY_TYPE, NOT_UPDATED, HK_WAREHOUSE, RAW_ORDER_COLS

# Anchor date of the week comparisons on the provided data: the last full
# fortnight before the latest order date.
AS_OF = _dt.date(2001, 7, 30)
OTHER_SNAPSHOT = 20201001
OPERATORS = 24                     # operators derived as supplier number mod 24


_SCANS: dict[tuple, DataFrame] = {}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """Lazy scan of one provided table. The provided tables are read-only, so
    the scan (file listing and footer schema) is set up once per session."""
    path = f"{sf_dir.rstrip('/')}/{name}.parquet"
    key = (*session_key(spark), path)
    if key not in _SCANS:
        _SCANS[key] = spark.read.parquet(path)
    return _SCANS[key]


def _dec(c, scale: int = 2, precision: int = 18):
    return c.cast(f"decimal({precision},{scale})")


def order_lines(spark: SparkSession, sf_dir: str, named: bool = True) -> DataFrame:
    """The order lines with their store, order and product: what
    ``order_cells`` makes the collected columns of, in fewer bytes. Amounts and
    dates have their narrow types before the shuffles, and stores are their
    numbers in them where the names can be broadcast after. Without ``named``
    the names are left to ``named_lines``, for lines that are moved again."""
    li = table(spark, sf_dir, "lineitem").select(
        "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_tax", "l_returnflag", "l_linestatus",
        _dec(F.col("l_extendedprice")).alias("price"), _dec(F.col("l_discount"), 2, 4).alias("discount"),
        F.col("l_shipdate").cast("date").alias("ship_date"))
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", F.col("o_orderdate").cast("date").alias("o_orderdate"))
    supplier, last = _suppliers(spark, sf_dir)
    part_tbl = table(spark, sf_dir, "part")
    part = part_tbl.select("p_partkey", _dec(F.col("p_retailprice")).alias("retail"))
    customer = table(spark, sf_dir, "customer").select("c_custkey", "c_nationkey")

    placed = orders.join(customer, orders.o_custkey == customer.c_custkey)
    if named:
        placed = _with_nation(spark, sf_dir, placed)
    placed = placed.drop("o_custkey", "c_custkey")
    j = li if last else li.join(supplier, li.l_suppkey == supplier.s_suppkey).drop("l_suppkey", "s_suppkey")
    j = (j.join(placed, j.l_orderkey == placed.o_orderkey).drop("o_orderkey")
          .join(part, j.l_partkey == part.p_partkey).drop("p_partkey"))
    j = named_lines(spark, sf_dir, j) if named else j
    # rows are spread after the joins: a filter on the order date (pushed
    # to the orders scan) shrinks the join output first
    return ensure_parallelism(j, splits=scan_splits(table(spark, sf_dir, "lineitem")))


def _suppliers(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, bool]:
    """The supplier names, and whether they are broadcast."""
    tbl = table(spark, sf_dir, "supplier")
    names = tbl.select("s_suppkey", "s_name")
    supplier = checked_broadcast(names, of=tbl)
    return supplier, supplier is not names


def _with_nation(spark: SparkSession, sf_dir: str, rows: DataFrame) -> DataFrame:
    nation = table(spark, sf_dir, "nation").select("n_nationkey", "n_name")
    return rows.join(F.broadcast(nation), rows.c_nationkey == nation.n_nationkey).drop("c_nationkey", "n_nationkey")


def named_lines(spark: SparkSession, sf_dir: str, lines: DataFrame) -> DataFrame:
    """``order_lines`` with the names that they lack, by broadcasts: the rows
    stay where they are."""
    if "n_name" not in lines.columns:
        lines = _with_nation(spark, sf_dir, lines)
    if "s_name" not in lines.columns:
        supplier, _ = _suppliers(spark, sf_dir)
        lines = lines.join(supplier, lines.l_suppkey == supplier.s_suppkey).drop("l_suppkey", "s_suppkey")
    return lines


def order_cells(spark: SparkSession, sf_dir: str) -> dict[str, Column]:
    """How the 26 collected order columns are made of ``order_lines``. Three money
    columns arrive as text the way the workbooks carry them: unit price as plain
    text, settlement total with thousands separators, first-leg freight with a
    "not updated" sentinel."""
    parts = table(spark, sf_dir, "part").select(F.count(F.lit(1))).scalar()

    price, retail, discount = F.col("price"), F.col("retail"), F.col("discount")
    revenue = _dec(price * (F.lit(1) - discount))
    cost_total = _dec(_dec(F.col("l_quantity")) * retail)
    line = F.col("l_linenumber")
    return {
        "order_date": F.col("o_orderdate").cast("date"),
        "ship_date": F.col("ship_date"),
        "store": F.col("s_name"),
        "order_no": F.col("l_orderkey").cast("string"),
        "product": F.concat(F.lit("SKU-"), F.col("l_partkey").cast("string")),
        "product2": F.when(line == 1, F.lit(None).cast("string")).otherwise(
            F.concat(F.lit("SKU-"), ((F.col("l_partkey") * 7) % parts).cast("string"))),
        "quantity": F.col("l_quantity"),
        "unit_price": retail.cast("string"),
        "currency1": F.lit("USD"),
        "commission_rate": F.col("l_tax"),
        "settle_total": F.format_number(price, 2),
        "currency2": F.lit("CNY"),
        "unit_price_cny": _dec(retail * 7),
        "revenue": revenue,
        "cost_price": retail,
        "currency3": F.lit("CNY"),
        "cost_total": cost_total,
        "handling_fee": _dec(line),
        "freight_first": F.when(line % 5 == 0, F.lit(NOT_UPDATED)).otherwise(
            _dec(_dec(F.col("l_tax"), 2, 4) * 100, 2, 9).cast("string")),
        "freight_last": F.when(line == 2, F.lit(None).cast(MONEY_TYPE)).otherwise(_dec(discount * 100)),
        "capital_cost": _dec(revenue * F.lit(0.01).cast("decimal(3,2)")),
        "profit": _dec(revenue - cost_total),
        "warehouse": F.when(F.col("l_returnflag") == "R", F.lit(HK_WAREHOUSE)).otherwise(F.col("l_returnflag")),
        "country": F.lower(F.col("n_name")),
        "tracking_no": F.when(line == 3, F.lit(None).cast("string")).otherwise(
            (F.col("l_orderkey") * 10 + line).cast("string")),
        "payment_status": F.col("l_linestatus"),
    }


def order_columns(spark: SparkSession, sf_dir: str, lines: DataFrame, keep: tuple[str, ...] = ()) -> DataFrame:
    """The 26 collected order columns of ``order_lines``, and those of its
    columns that are to be kept."""
    cells = order_cells(spark, sf_dir)
    return lines.select(*[cells[c].alias(c) for c in RAW_ORDER_COLS], *keep)


def raw_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The 26 collected order columns of every order line."""
    return order_columns(spark, sf_dir, order_lines(spark, sf_dir))


def store_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Store -> department, platform, operator. Store names are upper-cased,
    so joining them to the order stores needs a case-insensitive match."""
    s = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    n = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    r = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    return (s.join(F.broadcast(n), s.s_nationkey == n.n_nationkey)
             .join(F.broadcast(r), n.n_regionkey == r.r_regionkey)
             .select(F.upper("s_name").alias("store"),
                     F.col("n_name").alias("department"),
                     F.col("r_name").alias("platform"),
                     F.concat(F.lit("Operator#"), (F.col("s_suppkey") % OPERATORS).cast("string")).alias("operator"),
                     F.lit(_dt.date(2020, 11, 1)).alias("updatetime")))


def goods_dim(spark: SparkSession, sf_dir: str) -> DataFrame:
    p = table(spark, sf_dir, "part")
    return p.select(F.col("p_partkey").alias("id"),
                    F.concat(F.lit("SKU-"), F.col("p_partkey").cast("string")).alias("sku"),
                    F.col("p_brand").alias("brand"),
                    F.col("p_type").alias("category"),
                    F.concat(F.lit("PM-"), F.col("p_size").cast("string")).alias("manager"))


def targets(spark: SparkSession, sf_dir: str, kind: str) -> DataFrame:
    """(snapshot, key, target) for ``department`` / ``platform`` /
    ``operator``: target = key number x a per-kind step, so key number 0 has a
    zero target; the highest key number has none. The second snapshot holds
    doubled targets and is filtered out by the reports."""
    if kind == "department":
        keys = table(spark, sf_dir, "nation").select(
            F.col("n_name").alias("key"), F.col("n_nationkey").cast("long").alias("num"))
        step = 1000.0
    elif kind == "platform":
        keys = table(spark, sf_dir, "region").select(
            F.col("r_name").alias("key"), F.col("r_regionkey").cast("long").alias("num"))
        step = 50000.0
    elif kind == "operator":
        keys = (table(spark, sf_dir, "supplier")
                .select((F.col("s_suppkey") % OPERATORS).alias("num"))
                .distinct()
                .select(F.concat(F.lit("Operator#"), F.col("num").cast("string")).alias("key"),
                        F.col("num").cast("long").alias("num")))
        step = 2000.0
    else:
        raise ValueError(f"unknown target kind {kind!r}")
    keyed = keys.where(F.col("num") < keys.select(F.max("num")).scalar())
    snaps = F.explode(F.array(F.lit(DEFAULT_SNAPSHOT).cast("long"), F.lit(OTHER_SNAPSHOT).cast("long")))
    return (keyed.select(snaps.alias("snapshot"), "key", "num")
                 .select("snapshot", "key",
                         (F.col("num") * step * F.when(F.col("snapshot") == DEFAULT_SNAPSHOT, 1).otherwise(2))
                         .cast("double").alias("target")))
