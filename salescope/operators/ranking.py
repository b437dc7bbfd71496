"""Global ranks.

``dense_rank_desc`` / ``competition_rank_desc`` rank with an unpartitioned
window, i.e. in one task. The reports only apply them to already aggregated
rows whose count is bounded by a dimension table (the target rows of one
snapshot, the operators, the departments), never to fact rows.

For a key set that is not bounded that way, ``distributed_dense_rank_desc`` /
``distributed_competition_rank_desc`` compute the same ranks without a
single-task sort:

1. one row per distinct value with its multiplicity (partial aggregation);
2. the values cut into ordered ranges at quantiles of the distinct values (one
   sketch, a few numbers on the driver). The range is a pure, monotone function
   of the value, so equal values share one and a recomputation cannot move a
   value; each holds about as many values, also where they cluster;
3. a rank inside each bucket (a window partitioned by bucket);
4. per-bucket offsets from a table of one row per bucket, so its running sum
   and its broadcast are bounded by the bucket count, not the data;
5. the rank joined back to the rows on the value (null-safe).

The sketch is a job of its own over the input, so the input should be a
materialised table (a ``checkpoint()`` or a written table in the shared
folder): over a long lazy plan it would be computed twice.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T


def dense_rank_desc(df: DataFrame, col: str, name: str) -> DataFrame:
    """Dense rank, highest first, nulls last."""
    return df.withColumn(name, F.dense_rank().over(Window.orderBy(F.col(col).desc_nulls_last())))


def competition_rank_desc(df: DataFrame, col: str, name: str) -> DataFrame:
    """Competition ("min") rank, highest first; ties share the lowest rank
    and leave gaps (W3, W4). +inf ranks first."""
    return df.withColumn(name, F.rank().over(Window.orderBy(F.col(col).desc_nulls_last())))


#: ranges that the values of a distributed rank are cut into, at most
MOST_RANGES = 1000


def _bucket_expr(vals: DataFrame):
    """Range of ``__v``, 0 for the highest values; nulls after all others. The
    bounds are quantiles of the distinct values, so each range holds about as
    many of them, however they cluster."""
    if not isinstance(vals.schema["__v"].dataType, T.NumericType):
        return F.when(F.col("__v").isNull(), F.lit(1)).otherwise(F.lit(0))
    n = max(1, min(MOST_RANGES, int(vals.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    value = F.col("__v").cast("double")
    # a few numbers, whatever the input
    bounds = sorted(set(vals.select(value.alias("v")).approxQuantile("v", [i / n for i in range(1, n)], 1 / (4 * n)))) if n > 1 else []
    above = F.size(F.filter(F.array(*[F.lit(float(b)) for b in bounds]), lambda b: b > value)) if bounds else F.lit(0)
    return F.when(F.col("__v").isNull(), F.lit(len(bounds) + 1)).otherwise(above)


def _global_rank(df: DataFrame, col: str, name: str, dense: bool) -> DataFrame:
    value = F.col(col)
    vals = df.groupBy(value.alias("__v")).agg(F.count(F.lit(1)).alias("__n"))
    vals = vals.withColumn("__b", _bucket_expr(vals))
    local = Window.partitionBy("__b").orderBy(F.col("__v").desc_nulls_last())
    if dense:
        vals = vals.withColumn("__local", F.row_number().over(local) - 1)
        per_bucket = vals.groupBy("__b").agg(F.count(F.lit(1)).alias("__size"))
    else:
        before = local.rowsBetween(Window.unboundedPreceding, -1)
        vals = vals.withColumn("__local", F.coalesce(F.sum("__n").over(before), F.lit(0)))
        per_bucket = vals.groupBy("__b").agg(F.sum("__n").alias("__size"))
    # one row per bucket: this running sum sees at most the bucket count
    offsets = per_bucket.select(
        "__b",
        F.coalesce(F.sum("__size").over(Window.orderBy("__b").rowsBetween(Window.unboundedPreceding, -1)),
                   F.lit(0)).alias("__offset"))
    ranks = (vals.join(F.broadcast(offsets), "__b")
                 .select("__v", (F.col("__offset") + F.col("__local") + 1).cast("int").alias(name)))
    return df.join(ranks, value.eqNullSafe(ranks["__v"]), "left").drop("__v")


def distributed_dense_rank_desc(df: DataFrame, col: str, name: str) -> DataFrame:
    """``dense_rank_desc`` for unbounded key sets (materialised input)."""
    return _global_rank(df, col, name, dense=True)


def distributed_competition_rank_desc(df: DataFrame, col: str, name: str) -> DataFrame:
    """``competition_rank_desc`` for unbounded key sets (materialised input)."""
    return _global_rank(df, col, name, dense=False)
