"""Attainment reports: profit against target per department, platform and
operator (R6-R8, report flavour) and the target-driven status sheet (R9,
sheet flavour).

Plan shape (R7): one fact scan -> filter -> ONE aggregate computing profit
and revenue together (the reference ran two group-bys and joined them) ->
join to one target snapshot -> ranks -> total row. After the aggregate the
row count is at most the number of target rows, so the unpartitioned rank
windows and the total aggregate work on a dimension-sized input.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions import numeric as fn
from ..operators.filters import quantity_filter, target_snapshot
from ..operators.quarantine import amount, quarantine
from ..operators.ranking import competition_rank_desc, dense_rank_desc
from ..operators.totals import append_total
from ..schema import DEFAULT_SNAPSHOT, TOTAL_LABEL, ZERO_TARGET_RATE_FILL

#: amounts as they are summed: 20 integer digits, 8 decimals
SUMMED_TYPE = "decimal(28,8)"


def _report_sums(fact: DataFrame, key: str, *, with_revenue: bool,
                 nonnegative_only: bool = False) -> DataFrame:
    """Profit (and revenue) per key over rows with a profit and quantity >= 1
    (P13, P7, P14). Amounts are summed as they are, as exact decimals, and the
    sums rounded half-even to 2 once (F9). Text amounts are parsed (F7); those
    that do not parse are not counted, and :func:`unparsed_amounts` lists them."""
    base = quantity_filter(fact.where(F.col("profit").isNotNull()))
    total = lambda c: F.sum(F.coalesce(amount(fact, c, SUMMED_TYPE), F.lit(0))).cast("decimal(38,8)")
    aggs = [total("profit").alias("__profit")]
    if with_revenue:
        aggs.append(total("revenue").alias("__revenue"))
    sums = base.groupBy(F.col(key)).agg(*aggs)
    if nonnegative_only:                                     # P8 (HAVING), R6 only
        sums = sums.where(F.col("__profit") >= 0)
    cols = [F.col(key), F.bround("__profit", 2).cast("decimal(28,2)").alias("achieved")]
    if with_revenue:
        cols.append(F.bround("__revenue", 2).cast("decimal(28,2)").alias("revenue"))
    return sums.select(*cols)


def unparsed_amounts(fact: DataFrame, keys: list[str] | None = None) -> DataFrame:
    """The amounts of the rows that the attainment reports count which are no
    numbers: ``keys``, column, text, reason."""
    base = quantity_filter(fact.where(F.col("profit").isNotNull()))
    return quarantine(base, ["profit", "revenue"], keys or ["order_no", "product"], SUMMED_TYPE)


def _with_targets(sums: DataFrame, targets: DataFrame, key: str, snapshot: int) -> DataFrame:
    t = target_snapshot(targets, snapshot)
    return sums.join(t, sums[key] == t["key"], "inner").drop(t["key"])   # J9


def _report_total(rows: DataFrame, key: str, with_revenue: bool) -> DataFrame:
    """Report-flavour total (A10, J11): sums re-divided, scale 1 half-even,
    rank = min(rank) (= 1), rate rank 0. No total on empty input."""
    aggs = [F.sum("achieved").alias("a"), F.sum("target").alias("t"), F.min("rank").alias("rank")]
    if with_revenue:
        aggs.append(F.sum("revenue").alias("v"))
    tot = rows.agg(*aggs).where(F.col("rank") == 1)
    rate = fn.round_half_even(fn.safe_ratio("a", "t") * 100, 1)
    cols = {
        key: F.lit(TOTAL_LABEL),
        "target": F.bround("t", 1), "achieved": F.bround("a", 1),
        "rate": rate, "rank": F.col("rank"), "rate_rank": F.lit(0),
    }
    if with_revenue:
        cols["revenue"] = F.bround("v", 1)
        cols["margin"] = fn.round_half_even(fn.safe_ratio("a", "v") * 100, 1)
    return tot.select(*[c.alias(n) for n, c in cols.items()]).withColumn("is_total", F.lit(True))


_VALUES = ("target", "achieved", "revenue", "rate", "margin")


def _typed(df: DataFrame, order: list[str], extra: tuple[str, ...] = ()) -> DataFrame:
    """Both union branches as decimal(38,2): left to itself the union would
    widen (28,2) and (38,1) to (38,1) and round the body rows."""
    return df.select(*[F.col(c).cast("decimal(38,2)").alias(c) if c in _VALUES else F.col(c)
                       for c in order], *extra)


def _finish(rows: DataFrame, total: DataFrame, key: str, order: list[str], pct: list[str]) -> DataFrame:
    both = append_total(_typed(rows, order), _typed(total, order, ("is_total",)))
    out = []
    for c in order:
        if c in pct:
            out += [fn.as_double(c).alias(c), fn.report_pct_text(F.col(c)).alias(f"{c}_pct")]
        elif c in ("target", "achieved", "revenue"):
            out.append(fn.as_double(c).alias(c))
        else:
            out.append(F.col(c))
    return (both.select(*out, "is_total")
                .orderBy(F.col("is_total"), F.col("rank"), F.col(key)))


def platform_attainment(fact: DataFrame, targets: DataFrame, snapshot: int = DEFAULT_SNAPSHOT,
                        key: str = "platform") -> DataFrame:
    """Platform, target, achieved, rate(+_pct), rank, rate_rank, revenue,
    margin(+_pct), is_total. Rates/margins are x100, rounded half-up to 2 and
    null for a zero denominator; ranks are dense, on the rounded values."""
    rows = _with_targets(_report_sums(fact, key, with_revenue=True), targets, key, snapshot)
    rows = rows.withColumn("rate", fn.round_half_up(fn.safe_ratio("achieved", "target") * 100, 2))
    rows = dense_rank_desc(rows, "achieved", "rank")
    rows = dense_rank_desc(rows, "rate", "rate_rank")
    rows = rows.withColumn("margin", fn.round_half_up(fn.safe_ratio("achieved", "revenue") * 100, 2))
    order = [key, "target", "achieved", "rate", "rank", "rate_rank", "revenue", "margin"]
    return _finish(rows, _report_total(rows, key, True), key, order, ["rate", "margin"])


def operator_attainment(fact: DataFrame, targets: DataFrame, snapshot: int = DEFAULT_SNAPSHOT,
                        key: str = "operator") -> DataFrame:
    """As R7, but the achieved rank comes before the rate is rounded and
    numeric nulls (a zero-target rate) become 100 after ranking (Q8)."""
    rows = _with_targets(_report_sums(fact, key, with_revenue=True), targets, key, snapshot)
    rows = dense_rank_desc(rows, "achieved", "rank")
    rows = rows.withColumn("rate", fn.round_half_up(fn.safe_ratio("achieved", "target") * 100, 2))
    rows = dense_rank_desc(rows, "rate", "rate_rank")
    fill = F.lit(ZERO_TARGET_RATE_FILL)
    rows = rows.withColumns({c: F.coalesce(F.col(c), fill.cast(rows.schema[c].dataType))
                             for c in ("target", "achieved", "rate", "rank", "rate_rank", "revenue")})
    rows = rows.withColumn("margin", fn.round_half_up(fn.safe_ratio("achieved", "revenue") * 100, 2))
    order = [key, "target", "achieved", "rate", "rank", "rate_rank", "revenue", "margin"]
    return _finish(rows, _report_total(rows, key, True), key, order, ["rate", "margin"])


def department_attainment(fact: DataFrame, targets: DataFrame, snapshot: int = DEFAULT_SNAPSHOT,
                          key: str = "department") -> DataFrame:
    """Department, achieved, target, rate(+_pct), rank, rate_rank,
    is_total. Departments with a negative total are dropped (Q9); the rate is
    rounded half-even."""
    rows = _with_targets(_report_sums(fact, key, with_revenue=False, nonnegative_only=True),
                         targets, key, snapshot)
    rows = rows.withColumn("rate", fn.round_half_even(fn.safe_ratio("achieved", "target") * 100, 2))
    rows = dense_rank_desc(rows, "achieved", "rank")
    rows = dense_rank_desc(rows, "rate", "rate_rank")
    order = [key, "achieved", "target", "rate", "rank", "rate_rank"]
    return _finish(rows, _report_total(rows, key, False), key, order, ["rate"])


def target_status(fact: DataFrame, targets: DataFrame, by: str,
                  snapshot: int = DEFAULT_SNAPSHOT) -> DataFrame:
    """R9, starting from the targets (left join, Q10): every target key
    appears, sales without a target do not. Platform keys match
    case-insensitively. Division follows the sheet flavour (x/0 -> inf), ranks
    are competition ranks; the total row sums every numeric column including
    the ranks and leaves the percents null (Q11, Q28).

    Columns: <by>, target, achieved, revenue, rate, rate_pct, margin_pct,
    rate_rank, rank, is_total.
    """
    actual = (fact.where(F.col(by).isNotNull())
                  .groupBy(F.col(by).alias("__k"))
                  .agg(F.sum("profit").alias("__profit"), F.sum("revenue").alias("__revenue")))
    t = target_snapshot(targets, snapshot)
    if by == "platform":
        cond = F.lower(t["key"]) == F.lower(actual["__k"])
    else:
        cond = t["key"] == actual["__k"]
    rows = (t.join(actual, cond, "left")
             .select(t["key"].alias(by),
                     F.coalesce(t["target"], F.lit(0)).cast("decimal(18,2)").alias("target"),
                     F.coalesce("__profit", F.lit(0)).cast("decimal(28,2)").alias("achieved"),
                     F.coalesce("__revenue", F.lit(0)).cast("decimal(28,2)").alias("revenue")))
    rows = rows.withColumns({
        "rate": fn.sheet_ratio("achieved", "target"),
        "margin_pct": fn.sheet_pct_text(fn.sheet_ratio("achieved", "revenue")),
    })
    rows = competition_rank_desc(rows, "rate", "rate_rank")
    rows = rows.withColumn("rate_pct", fn.sheet_pct_text("rate"))
    rows = competition_rank_desc(rows, "achieved", "rank")
    rows = rows.withColumns({"rate_rank": F.col("rate_rank").cast("bigint"),
                             "rank": F.col("rank").cast("bigint")})
    order = [by, "target", "achieved", "revenue", "rate", "rate_pct", "margin_pct", "rate_rank", "rank"]
    rows = rows.select(*order)
    total = rows.agg(*[F.sum(c).alias(c) for c in ("target", "achieved", "revenue", "rate_rank", "rank")])
    total = total.select(
        F.lit(TOTAL_LABEL).alias(by), "target", "achieved", "revenue",
        F.lit(None).cast("double").alias("rate"), F.lit(None).cast("string").alias("rate_pct"),
        F.lit(None).cast("string").alias("margin_pct"),
        F.col("rate_rank").cast("bigint").alias("rate_rank"), F.col("rank").cast("bigint").alias("rank"),
        F.lit(True).alias("is_total"))
    both = append_total(rows, total)
    return (both.withColumns({c: fn.as_double(c) for c in ("target", "achieved", "revenue")})
                .orderBy("is_total", "rank", by))
