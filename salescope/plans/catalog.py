"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the provided tables through the testbed adapter, so its work
grows with them. Outputs are presented with portable types (money decimals as
double, dates as ISO text) so they can be compared with an SQL engine.
"""

from __future__ import annotations

import datetime as _dt
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators import cleaning as cl
from ..sources import testbed as tb
from . import attainment, collect, compare, movers

QueryFn = Callable[[SparkSession, str], DataFrame]


def presentable(df: DataFrame) -> DataFrame:
    """Decimals -> double, dates -> 'yyyy-MM-dd' text; other types kept."""
    out = []
    for f in df.schema.fields:
        c = F.col(f"`{f.name}`")
        if isinstance(f.dataType, T.DecimalType):
            c = c.cast("double")
        elif isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        out.append(c.alias(f.name))
    return df.select(*out)


# ---------------------------------------------------------------- inputs
def raw(spark, d):
    return tb.raw_orders(spark, d)


def collected(spark, d):
    return collect.collect_orders(tb.raw_orders(spark, d), tb.store_dim(spark, d))


def cleaned(spark, d):
    return cl.clean_orders(tb.raw_orders(spark, d), tb.store_dim(spark, d), tb.goods_dim(spark, d))


def cleaned_lines(spark, d):
    """The cleaned orders alone, for reports that need no dimension."""
    return cl.clean_orders(tb.raw_orders(spark, d))


def cleaned_by_store(spark, d):
    return cl.clean_orders(tb.raw_orders(spark, d), tb.store_dim(spark, d))


def cleaned_by_product(spark, d):
    return cl.clean_orders(tb.raw_orders(spark, d), None, tb.goods_dim(spark, d), goods_keys=("product",))


def cleaned_by_store_and_product(spark, d):
    return cl.clean_orders(tb.raw_orders(spark, d), tb.store_dim(spark, d), tb.goods_dim(spark, d), goods_keys=("product",))


# ---------------------------------------------------------------- reports
def q_platform_attainment(spark, d):
    return attainment.platform_attainment(collected(spark, d), tb.targets(spark, d, "platform"))


def q_department_attainment(spark, d):
    return attainment.department_attainment(collected(spark, d), tb.targets(spark, d, "department"))


def q_operator_attainment(spark, d):
    return attainment.operator_attainment(collected(spark, d), tb.targets(spark, d, "operator"))


def _target_status(kind: str) -> QueryFn:
    def q(spark, d):
        return attainment.target_status(cleaned_by_store(spark, d), tb.targets(spark, d, kind), kind)
    q.__name__ = f"q_target_status_{kind}"
    return q


def q_store_week_compare(spark, d):
    return presentable(compare.store_week_compare(cleaned_lines(spark, d), tb.AS_OF))


def q_product_week_compare(spark, d):
    return presentable(compare.product_week_compare(cleaned_lines(spark, d), tb.AS_OF))


def q_store_dimension_week_compare(spark, d):
    return presentable(compare.store_dimension_week_compare(cleaned_by_product(spark, d), tb.AS_OF))


def q_entity_dimension_week_compare(spark, d):
    return presentable(compare.entity_dimension_week_compare(cleaned_by_store_and_product(spark, d), tb.AS_OF))


def _store_movers(which: str) -> QueryFn:
    def q(spark, d):
        cmp_ = compare.store_week_compare(cleaned_lines(spark, d), tb.AS_OF)
        return presentable(movers.store_movers(cmp_, tb.store_dim(spark, d), which))
    return q


def _product_movers(which: str) -> QueryFn:
    def q(spark, d):
        cmp_ = compare.product_week_compare(cleaned_lines(spark, d), tb.AS_OF)
        return presentable(movers.product_movers(cmp_, tb.goods_dim(spark, d), which))
    return q


def q_clean_orders(spark, d):
    return presentable(cleaned(spark, d))


def q_collect_orders(spark, d):
    return presentable(collected(spark, d))


SNAPSHOT_SPLIT = _dt.date(1998, 1, 1)       # older snapshot: orders before
SNAPSHOT_OVERLAP = _dt.date(1997, 7, 1)     # newer snapshot: orders from


def _snapshots(spark, d):
    c = collected(spark, d)
    older = c.where(F.col("order_date") < F.lit(SNAPSHOT_SPLIT))
    newer = c.where(F.col("order_date") >= F.lit(SNAPSHOT_OVERLAP)).drop("payment_status")
    return older, newer


def q_merge_snapshots(spark, d):
    older, newer = _snapshots(spark, d)
    return presentable(collect.merge_snapshots(older, newer))


def q_repair_orders(spark, d):
    return presentable(collect.repair_orders(raw(spark, d), tb.store_dim(spark, d)))


REPORTS: dict[str, QueryFn] = {
    "platform_attainment": q_platform_attainment,
    "department_attainment": q_department_attainment,
    "operator_attainment": q_operator_attainment,
    "target_status_platform": _target_status("platform"),
    "target_status_department": _target_status("department"),
    "target_status_operator": _target_status("operator"),
    "store_week_compare": q_store_week_compare,
    "product_week_compare": q_product_week_compare,
    "store_dimension_week_compare": q_store_dimension_week_compare,
    "entity_dimension_week_compare": q_entity_dimension_week_compare,
    "store_movers_top": _store_movers("top"),
    "store_movers_bottom": _store_movers("bottom"),
    "product_movers_top": _product_movers("top"),
    "product_movers_bottom": _product_movers("bottom"),
    "clean_orders": q_clean_orders,
    "collect_orders": q_collect_orders,
    "merge_snapshots": q_merge_snapshots,
    "repair_orders": q_repair_orders,
}


def all_queries() -> dict[str, QueryFn]:
    from .feature_queries import FEATURES
    from .operator_queries import OPERATORS
    return {**REPORTS, **OPERATORS, **FEATURES}
