"""Null-fill rules."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import MONEY_SCALE, MONEY_TYPE


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def text_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]


def fill_text(df: DataFrame, value: str, cols: list[str]) -> DataFrame:
    """Fill nulls of the named string columns (P14). Names must exist."""
    missing = [c for c in cols if c not in df.columns]
    if missing:
        raise ValueError(f"columns not found: {missing}")
    return df.fillna(value, subset=cols)


def fill_numeric(df: DataFrame, value, cols: list[str] | None = None) -> DataFrame:
    """Fill nulls of numeric columns (all of them by default)."""
    cols = numeric_columns(df) if cols is None else cols
    return df.withColumns({c: F.coalesce(F.col(c), F.lit(value).cast(df.schema[c].dataType))
                           for c in cols})


def fill_all_zero(df: DataFrame, exclude: tuple[str, ...] = ()) -> DataFrame:
    """Numbers -> 0 and text -> "0" (P16, Q23)."""
    nums = [c for c in numeric_columns(df) if c not in exclude]
    texts = [c for c in text_columns(df) if c not in exclude]
    out = fill_numeric(df, 0, nums)
    return out.fillna("0", subset=texts) if texts else out


def is_money(df: DataFrame, name: str) -> bool:
    """Whether a column's type holds nothing that the money type does not."""
    t = df.schema[name].dataType
    return isinstance(t, T.DecimalType) and t.scale <= MONEY_TYPE.scale and t.precision - t.scale <= MONEY_TYPE.precision - MONEY_TYPE.scale


def round_money(df: DataFrame, cols: list[str]) -> DataFrame:
    """Fill 0, round half-even to 2 places, type as money (P17). Only a null is
    filled: a value beyond the money type fails, or without ANSI is null."""
    return df.withColumns({
        c: F.coalesce(F.col(c).cast(MONEY_TYPE), F.lit(0).cast(MONEY_TYPE)) if is_money(df, c)      # nothing to round
        else F.when(F.col(c).isNull(), F.lit(0).cast(MONEY_TYPE)).otherwise(
            F.bround(F.col(c).cast("decimal(38,18)"), MONEY_SCALE).cast(MONEY_TYPE))
        for c in cols})


def zero_if_null(col: str):
    """One column's nulls as 0."""
    return F.coalesce(F.col(col), F.lit(0))
