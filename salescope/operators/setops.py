"""Unions, distinct values and column shaping."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def union_by_name(frames: list[DataFrame], allow_missing: bool = True) -> DataFrame:
    """Stack frames by column name; a column missing in one frame is null
    there; duplicates are kept (U2, U3)."""
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=allow_missing), frames)


def distinct_values(df: DataFrame, col: str) -> DataFrame:
    """One row per distinct value, nulls included (A12, U4). Stays a
    DataFrame: nothing is collected to the driver."""
    return df.select(col).distinct()


def reorder(df: DataFrame, cols: list[str]) -> DataFrame:
    """Fixed column order (P2); absent columns raise."""
    return df.select(*cols)


def rename(df: DataFrame, mapping: dict[str, str]) -> DataFrame:
    """Rename by map (P3); absent names are ignored like a dict rename."""
    return df.withColumnsRenamed({k: v for k, v in mapping.items() if k in df.columns})


def positional(df: DataFrame, names: list[str]) -> DataFrame:
    """Rename all columns by position."""
    return df.toDF(*names)


def with_total_flag(df: DataFrame, value: bool = False) -> DataFrame:
    return df.withColumn("is_total", F.lit(value))
