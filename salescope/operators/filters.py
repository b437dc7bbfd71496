"""Row filters."""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..schema import PERIOD_DAYS


def quantity_filter(df: DataFrame, col: str = "quantity") -> DataFrame:
    """Quantity >= 1 on a possibly untyped column. Text that is not a number
    (a header line read as data) and nulls drop out instead of raising."""
    return df.where(F.expr(f"try_cast(`{col}` AS double)") >= 1)


def target_snapshot(targets: DataFrame, snapshot: int) -> DataFrame:
    """(key, target) of one snapshot; the filter reaches the scan."""
    return (targets.where(F.col("snapshot") == F.lit(snapshot))
                   .select("key", F.col("target").cast("decimal(18,2)").alias("target")))


def drop_null_keys(df: DataFrame, cols: list[str]) -> DataFrame:
    return df.dropna(subset=cols)


def exclude_total(df: DataFrame) -> DataFrame:
    return df.where(~F.col("is_total"))


def period_bounds(as_of: _dt.date) -> dict[str, _dt.date]:
    """Current period [as_of-6, as_of], previous [as_of-13, as_of-7]; both
    ends inclusive."""
    return {
        "new_start": as_of - _dt.timedelta(days=PERIOD_DAYS - 1),
        "new_end": as_of,
        "old_start": as_of - _dt.timedelta(days=2 * PERIOD_DAYS - 1),
        "old_end": as_of - _dt.timedelta(days=PERIOD_DAYS),
    }


MONTH_COL = "order_month"


def period_slice(df: DataFrame, as_of: _dt.date, date_col: str = "order_date") -> DataFrame:
    """Rows of the two compared periods, flagged ``is_new``. One range filter
    over the 14 days (pushed to the scan) instead of two scans. On a fact
    landed partitioned by ``order_month`` (``sinks.write_fact``) the same
    range is also stated on the partition column, so only the one or two
    month directories are listed and read."""
    b = period_bounds(as_of)
    d = F.col(date_col)
    out = df.where(d.between(F.lit(b["old_start"]), F.lit(b["new_end"])))
    if MONTH_COL in df.columns:
        out = out.where(F.col(MONTH_COL).between(F.lit(b["old_start"].replace(day=1)),
                                                 F.lit(b["new_end"].replace(day=1))))
    return out.withColumn("is_new", d >= F.lit(b["new_start"]))


def anchor_date(run_date: _dt.date) -> _dt.date:
    """The reference "today": two days before the run date."""
    from ..schema import ANCHOR_LAG_DAYS
    return run_date - _dt.timedelta(days=ANCHOR_LAG_DAYS)
