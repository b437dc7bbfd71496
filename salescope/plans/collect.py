"""Collecting raw order files into one fact."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..operators.dims import attach_store_dim
from ..operators.setops import reorder, union_by_name
from ..schema import DIM_COLS, RAW_ORDER_COLS


def collect_orders(raw: DataFrame, store_dim: DataFrame | None) -> DataFrame:
    """The 26 order columns in fixed order (P2), store names lower-cased
    and matched case-insensitively to the store dimension (F2, J2), which adds
    platform, department and operator: the 29 columns of the collected fact.
    Without a store dimension ``raw`` has those three from it already.

    ``raw`` is typically one multi-file read (``sources.read_order_files``):
    the stacking of per-store files is the scan itself. The reference also
    sorted by order date before landing; order is not part of a table's
    contract here, so it is left to the writer (``sort_within``).
    """
    if store_dim is None:
        return raw.select(*[F.lower(c).alias(c) if c == "store" else c for c in (*RAW_ORDER_COLS, *DIM_COLS)])
    fact = reorder(raw, RAW_ORDER_COLS)
    fact = attach_store_dim(fact, store_dim, case_insensitive=True, lower_store=True)
    return fact.select(*RAW_ORDER_COLS, *DIM_COLS)


def merge_snapshots(older: DataFrame, newer: DataFrame) -> DataFrame:
    """R2: two collected facts stacked by column name; a column missing in one
    is null there; duplicate rows are kept (U3)."""
    return union_by_name([newer, older], allow_missing=True)


def repair_orders(fact: DataFrame, store_dim: DataFrame) -> DataFrame:
    """Attach (or replace) the store dimension on a fact that lacks it."""
    return attach_store_dim(fact, store_dim, case_insensitive=True, lower_store=True)


def seed_targets(keys: DataFrame, snapshot: int, target_col: str = "target") -> DataFrame:
    """Target rows (snapshot, key, target) from a keyed frame, ready for an
    append to the target table (``sinks.write_jdbc`` / ``write_table``)."""
    return keys.select(F.lit(snapshot).cast("long").alias("snapshot"),
                       F.col("key").cast("string").alias("key"),
                       F.col(target_col).cast("double").alias("target"))
