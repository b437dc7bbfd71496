"""Week-over-week comparisons.

The reference filtered each 7-day period, aggregated each, and full-outer
joined the two; the per-store report did that in nested driver loops
(stores x 3 dimensions x 2 periods x 2 group-bys). Here one range filter over
the 14 days feeds ONE conditional aggregation per key: per-period row counts
tell a key absent from a period (outer-join null) apart from a key present
with zero sums (Q15). The per-store report sums each combination of store and
dimension columns once and expands those sums into all its groupings, the
all-store baseline among them, so the fact is scanned once.

Averages are ``sum / count`` in double precision, rounded half-up to 2 places
through a decimal, so they are reproducible in any engine.
"""

from __future__ import annotations

import datetime as _dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numeric as fn
from ..operators.filters import period_slice
from ..operators.fills import fill_all_zero
from ..operators.totals import append_total, sheet_total_rows
from ..schema import COMPARE_DIMENSIONS, MEASURES, TOTAL_LABEL

PERIODS = ("new", "old")


def _period_aggs(measures: list[str], states: bool = False) -> list:
    """Per period: row count, and per measure its sum and non-null count, of
    rows or of ``plans.states`` that hold those of many rows."""
    aggs = []
    for p in PERIODS:
        cond = F.col("is_new") if p == "new" else ~F.col("is_new")
        if states:
            total = lambda c: F.coalesce(F.sum(F.when(cond, F.col(c))), F.lit(0).cast("bigint"))  # noqa: B023, E731
            aggs.append(total("n_rows").alias(f"__n_{p}"))
            for m in measures:
                aggs += [F.sum(F.when(cond, F.col(f"sum_{m}"))).alias(f"__sum_{m}_{p}"), total(f"n_{m}").alias(f"__cnt_{m}_{p}")]
            continue
        aggs.append(F.count(F.when(cond, F.lit(1))).alias(f"__n_{p}"))
        for m in measures:
            v = F.when(cond, F.col(m))
            aggs += [F.sum(v).alias(f"__sum_{m}_{p}"), F.count(v).alias(f"__cnt_{m}_{p}")]
    return aggs


def state_columns(measures: list[str]) -> list[str]:
    return ["n_rows", *[f"{k}_{m}" for m in measures for k in ("sum", "n")]]


def _present(p: str):
    return F.col(f"__n_{p}") > 0


def _avg(sum_col, cnt_col):
    return fn.round_half_up(F.try_divide(fn.as_double(sum_col), fn.as_double(cnt_col)), 2)


def _compare_columns(key_cols: list[str], measures: list[str], baseline: bool) -> list:
    """From the conditional sums to the sheet columns. Absent-period
    measures stay null here and are filled with 0 afterwards."""
    out = [F.col(k) for k in key_cols]
    for p in PERIODS:
        present = _present(p)
        for m in measures:
            s = F.coalesce(F.col(f"__sum_{m}_{p}"), F.lit(0))
            out.append(F.when(present, s).alias(f"{m}_{p}"))
        out.append(F.when(present, fn.sheet_pct_text(fn.sheet_ratio(
            F.coalesce(F.col(f"__sum_profit_{p}"), F.lit(0)),
            F.coalesce(F.col(f"__sum_revenue_{p}"), F.lit(0))))).alias(f"margin_{p}"))
        prefix = "__b" if baseline else "__"
        for m in measures:
            a = _avg(F.col(f"{prefix}sum_{m}_{p}"), F.col(f"{prefix}cnt_{m}_{p}"))
            out.append(F.when(present, a).alias(f"avg_{m}_{p}"))
    return out


def _finish_compare(rows: DataFrame, key: str, measures: list[str],
                    group_cols: tuple[str, ...] = ()) -> DataFrame:
    """Growth, growth rate, 0-fill and the total row(s)."""
    rows = rows.withColumns({
        "growth": fn.growth("profit_new", "profit_old"),
        "growth_rate": fn.sheet_pct_text(fn.growth_rate("profit_new", "profit_old")),
    })
    rows = fill_all_zero(rows, exclude=(key, *group_cols))
    rows = rows.withColumn("is_total", F.lit(False))
    return rows


def _sum_columns(measures: list[str]) -> list[str]:
    cols = []
    for p in PERIODS:
        cols += [f"{m}_{p}" for m in measures] + [f"avg_{m}_{p}" for m in measures]
    return cols + ["growth"]


def week_compare(fact: DataFrame, key: str, as_of: _dt.date, *,
                 measures: list[str] = MEASURES, sort: bool = True, states: bool = False) -> DataFrame:
    """R10 (key = store, names lower-cased first) / R11 (key = product), of the
    fact's rows or of its daily ``states``.

    Columns: key, {profit, revenue, quantity}_{new,old}, margin_{new,old},
    avg_{profit, revenue, quantity}_{new,old}, growth, growth_rate, is_total.
    """
    src = fact.withColumn(key, F.lower(F.col(key))) if key == "store" else fact
    sl = period_slice(src, as_of).where(F.col(key).isNotNull())
    agg = sl.groupBy(key).agg(*_period_aggs(measures, states))
    rows = agg.select(*_compare_columns([key], measures, baseline=False))
    rows = _finish_compare(rows, key, measures)
    total = sheet_total_rows(rows, key, _sum_columns(measures), round_scale=2)
    out = append_total(rows, total)
    if sort:
        out = out.orderBy(F.col("is_total"), F.col("growth").desc(), F.col(key))
    return out


def store_week_compare(fact: DataFrame, as_of: _dt.date) -> DataFrame:
    return week_compare(fact, "store", as_of)


def product_week_compare(fact: DataFrame, as_of: _dt.date) -> DataFrame:
    return week_compare(fact, "product", as_of)


#: columns by which the per-entity comparison can be asked for
ENTITIES = ("store", "platform", "operator")


def entity_dimension_week_compare(fact: DataFrame, as_of: _dt.date, *, entities: tuple[str, ...] = ENTITIES,
                                  dimensions: dict[str, str] = COMPARE_DIMENSIONS, measures: list[str] = MEASURES,
                                  members: DataFrame | None = None, states: bool = False) -> DataFrame:
    """The per-value comparison of every store, platform and operator (P11, A6,
    A12): each entity's sums per product, brand and category against the mean
    of the value over all rows (Q21), plus a total row per (entity, dimension)
    for every entity of the whole fact, idle ones included (Q27).

    Columns: entity, key, dimension, value, the week_compare measures, is_total.
    Rows are first summed per combination of the columns in use, and one
    expand of those sums gives every (entity, dimension) grouping and the
    (dimension) groupings alike. The means, one row per value, are joined
    back: a value has one row per entity by then, however many rows of the
    fact hold it, and what is still skewed is split by its measured size.
    ``members`` holds the entity columns where ``fact`` is already cut to the
    two periods.
    """
    by_name = {name: f"__v_{name}" for name in dimensions}
    keys = [F.lower(F.col(e)).alias(e) if e == "store" else F.col(e) for e in entities]
    sl = period_slice(fact, as_of).select(
        *keys, "is_new", *(state_columns(measures) if states else measures), *[F.col(c).cast("string").alias(by_name[n]) for n, c in dimensions.items()])
    sums = sl.groupBy(*entities, *by_name.values()).agg(*_period_aggs(measures, states))
    measured = [f"__n_{p}" for p in PERIODS] + [f"__{k}_{m}_{p}" for p in PERIODS for m in measures for k in ("sum", "cnt")]
    # one row per (entity column, dimension column) and one per dimension column, of every combination's sums
    sets = F.explode(F.array(*[
        F.struct(F.lit(e).cast("string").alias("entity"), (F.col(e) if e else F.lit(None)).cast("string").alias("key"),
                 F.lit(n).alias("dimension"), F.col(v).alias("value"))
        for e in (None, *entities) for n, v in by_name.items()])).alias("__s")
    grouped = (sums.select(sets, *measured).select("__s.*", *measured).where("value is not null and (entity is null or key is not null)")
                   .groupBy("entity", "key", "dimension", "value").agg(*[F.sum(c).alias(c) for c in measured]))
    base = grouped.where("entity is null").select("dimension", "value", *[F.col(c).alias(c.replace("__", "__b", 1)) for c in measured if not c.startswith("__n_")])
    rows = grouped.where("entity is not null")
    rows = rows.join(base, ["dimension", "value"]).select(*_compare_columns(["entity", "key", "dimension", "value"], measures, baseline=True))
    rows = _finish_compare(rows, "value", measures, group_cols=("entity", "key", "dimension"))

    sum_cols = _sum_columns(measures)
    totals = sheet_total_rows(rows, "value", sum_cols, group_cols=("entity", "key", "dimension"), round_scale=2)
    # distinct before they are dealt out: joins that only add columns to the fact are not computed for the list
    listed = (fact if members is None else members).select(*keys).distinct()
    grid = (listed.select(F.explode(F.array(*[F.struct(F.lit(e).alias("entity"), F.col(e).cast("string").alias("key")) for e in entities])).alias("__e"))
                  .select("__e.*").where("key is not null").distinct()
                  .select("entity", "key", F.explode(F.array(*[F.lit(n) for n in dimensions])).alias("dimension")))
    totals = grid.join(totals.drop("value", "is_total"), ["entity", "key", "dimension"], "left")
    totals = totals.withColumns({
        "value": F.lit(TOTAL_LABEL),
        "is_total": F.lit(True),
        **{c: F.coalesce(F.col(c), F.lit(0).cast(rows.schema[c].dataType)) for c in sum_cols},
    })
    return append_total(rows, totals.select(*rows.columns))


def store_dimension_week_compare(fact: DataFrame, as_of: _dt.date, *,
                                 dimensions: dict[str, str] = COMPARE_DIMENSIONS,
                                 measures: list[str] = MEASURES,
                                 stores: DataFrame | None = None, states: bool = False) -> DataFrame:
    """The per-value comparison of every store.

    Columns: store, dimension, value, the week_compare measures, is_total.
    ``stores`` overrides where the store list comes from (e.g. when ``fact``
    is already cut to the two periods). Not globally sorted: write it
    partitioned by store and dimension and sort within partitions (see
    ``sinks.write_partitioned``).
    """
    out = entity_dimension_week_compare(fact, as_of, entities=("store",), dimensions=dimensions, measures=measures, members=stores, states=states)
    return out.drop("entity").withColumnRenamed("key", "store")


def week_reports(fact: DataFrame, as_of: _dt.date) -> dict[str, DataFrame]:
    """R10, R11 and R12 for one anchor date from ONE slice of the fact.

    The 14-day slice is persisted (memory, spilling to disk; recomputed from
    lineage if an executor is lost) and all three reports read it, so the fact
    is filtered and projected once instead of three times. Call
    ``unpersist()`` on the returned ``"slice"`` when done.
    """
    from pyspark import StorageLevel
    cols = ["order_date", "store", "product", *COMPARE_DIMENSIONS.values(), *MEASURES]
    cols = list(dict.fromkeys(cols))
    sliced = period_slice(fact.select(*cols), as_of).drop("is_new").persist(StorageLevel.MEMORY_AND_DISK)
    stores = fact.select("store")
    return {
        "slice": sliced,
        "store_week_compare": store_week_compare(sliced, as_of),
        "product_week_compare": product_week_compare(sliced, as_of),
        "store_dimension_week_compare": store_dimension_week_compare(sliced, as_of, stores=stores),
    }
