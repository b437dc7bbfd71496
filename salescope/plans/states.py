"""Daily states: what the week reports need of a day, summed once.

A state is a row per day, store, platform, operator, product, brand and
category with its number of rows and each measure's sum and non-null count.
States merge by addition, so a report over any days adds up theirs, equal to
the same report over the fact's rows, and reads none of those. The table is
partitioned by day and a day is replaced as a whole: landing a day again, after
a correction or a failed run, leaves it once.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..schema import COMPARE_DIMENSIONS, MEASURES
from ..sinks.versioned import VersionedTable
from .compare import ENTITIES, entity_dimension_week_compare, store_dimension_week_compare, week_compare

KEYS = ["order_date", *ENTITIES, *COMPARE_DIMENSIONS.values()]


def daily_states(fact: DataFrame, measures: list[str] = MEASURES) -> DataFrame:
    """The states of ``fact``'s days; columns that ``fact`` lacks are null."""
    keys = [(F.lower(F.col(k)) if k == "store" else F.col(k) if k in fact.columns else F.lit(None).cast("string")).alias(k) for k in KEYS]
    sums = [x for m in measures for x in (F.sum(m).alias(f"sum_{m}"), F.count(m).alias(f"n_{m}"))]
    return fact.where(F.col("order_date").isNotNull()).select(*keys, *measures).groupBy(*KEYS).agg(F.count(F.lit(1)).alias("n_rows"), *sums)


def state_table(spark: SparkSession, path: str) -> VersionedTable:
    return VersionedTable(spark, path, "order_date")


def land_days(table: VersionedTable, fact: DataFrame, measures: list[str] = MEASURES) -> int:
    """The days that occur in ``fact`` become its states; returns the version."""
    return table.replace(daily_states(fact, measures))


def reports(states: DataFrame, as_of: _dt.date, measures: list[str] = MEASURES) -> dict[str, DataFrame]:
    """R10, R11, R12 and the comparison of all entities, from states alone."""
    return {
        "store_week_compare": week_compare(states, "store", as_of, measures=measures, states=True),
        "product_week_compare": week_compare(states, "product", as_of, measures=measures, states=True),
        "store_dimension_week_compare": store_dimension_week_compare(states, as_of, measures=measures, states=True),
        "entity_dimension_week_compare": entity_dimension_week_compare(states, as_of, measures=measures, states=True),
    }
