"""Text, date and identifier expressions used by cleaning.

Each helper looks at the input column's type where that matters, so the same
cleaning works on an all-string file read and on an already typed table.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import NOT_UPDATED


def _type(df: DataFrame, name: str) -> T.DataType:
    return df.schema[name].dataType


def parse_date(df: DataFrame, name: str) -> Column:
    """To DateType; strings in ISO form (optionally with a time part)."""
    return F.to_date(F.col(name))


def iso_week(df: DataFrame, name: str) -> Column:
    """ISO-8601 week number (Monday start; 2021-01-03 is week 53)."""
    return F.weekofyear(F.to_date(F.col(name)))


def strict_number(df: DataFrame, name: str, target: T.DataType) -> Column:
    """String or number to ``target``; unparsable text raises (ANSI)."""
    return F.col(name).cast(target)


def sentinel_number(df: DataFrame, name: str, target: T.DataType,
                    sentinel: str = NOT_UPDATED) -> Column:
    """The sentinel text means "unknown": it becomes null, the rest parses."""
    if isinstance(_type(df, name), T.StringType):
        return F.nullif(F.trim(F.col(name)), F.lit(sentinel)).cast(target)
    return F.col(name).cast(target)


def thousands_number(df: DataFrame, name: str, target: T.DataType) -> Column:
    """Text with thousands separators ("1,234.50") to a number."""
    if isinstance(_type(df, name), T.StringType):
        return F.replace(F.col(name), F.lit(","), F.lit("")).cast(target)
    return F.col(name).cast(target)


def id_text(df: DataFrame, name: str) -> Column:
    """Identifier as text, null -> ''. Integral floating ids print without
    a fraction (12.0 -> "12")."""
    t = _type(df, name)
    c = F.col(name)
    if isinstance(t, (T.FloatType, T.DoubleType)):
        c = F.when(c == F.floor(c), F.floor(c).cast("string")).otherwise(c.cast("string"))
    elif isinstance(t, T.DecimalType):
        c = F.when(c == F.floor(c), F.floor(c).cast("bigint").cast("string")).otherwise(c.cast("string"))
    else:
        c = c.cast("string")
    return F.coalesce(c, F.lit(""))
