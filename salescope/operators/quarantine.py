"""Parsing that carries its errors.

A text amount becomes a value or a reason, never a silent zero: the typed
frame keeps the row with a null amount, and the quarantine lists the cell.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import NOT_UPDATED

#: amounts as they are parsed: 20 integer digits, 8 decimals
AMOUNT = "decimal(28,8)"


def is_text(df: DataFrame, name: str) -> bool:
    return isinstance(df.schema[name].dataType, T.StringType)


def amount_text(c: Column) -> Column:
    """What there is to parse: trimmed, without thousands separators (F7); the
    "not updated" sentinel (F6) and blanks are no value."""
    t = F.regexp_replace(F.trim(c), ",", "")
    return F.when((t != "") & (t != NOT_UPDATED), t)


def amount(df: DataFrame, name: str, target: str = AMOUNT) -> Column:
    """The amount, null where there is none or it does not parse."""
    return (amount_text(F.col(name)) if is_text(df, name) else F.col(name)).try_cast(target)


def amount_error(df: DataFrame, name: str, target: str = AMOUNT) -> Column:
    """Why an amount does not parse; null where it does or there is none."""
    text = amount_text(F.col(name)) if is_text(df, name) else F.col(name).cast("string")
    wide = text.try_cast("double")
    return (F.when(text.isNull() | text.try_cast(target).isNotNull(), F.lit(None).cast("string"))
             .when(wide.isNull() | F.isnan(wide), F.lit("not a number")).otherwise(F.lit("out of range")))


def parse_amounts(df: DataFrame, columns: list[str], target: str = AMOUNT) -> DataFrame:
    """``df`` with its amounts typed, null where they do not parse."""
    return df.withColumns({c: amount(df, c, target) for c in columns})


def quarantine(df: DataFrame, columns: list[str], keys: list[str], target: str = AMOUNT) -> DataFrame:
    """One row for each cell of ``columns`` that does not parse: ``keys``,
    column, text, reason. One scan; rows whose cells all parse yield none."""
    cells = F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("text"), amount_error(df, c, target).alias("reason")) for c in columns])
    bad = F.filter(cells, lambda x: x["reason"].isNotNull())
    return df.select(*keys, F.explode(bad).alias("__cell")).select(*keys, "__cell.column", "__cell.text", "__cell.reason")
