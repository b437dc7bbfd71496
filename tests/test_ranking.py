"""The distributed ranks equal window ranks over ORDER BY v DESC NULLS LAST."""

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import Window
from pyspark.sql import functions as F

from salescope.operators.ranking import (
    distributed_competition_rank_desc as competition_rank_desc,
    distributed_dense_rank_desc as dense_rank_desc,
)

values = st.one_of(st.none(), st.integers(-5, 5).map(float), st.sampled_from([float("inf"), float("-inf")]))


@settings(max_examples=15, deadline=None)
@given(st.lists(values, min_size=0, max_size=40))
def test_ranks_match_window(spark, vs):
    df = spark.createDataFrame([(i, v) for i, v in enumerate(vs)], "id int, v double")
    w = Window.orderBy(F.col("v").desc_nulls_last())
    want = {r.id: (r.d, r.c) for r in df.select("id", F.dense_rank().over(w).alias("d"),
                                                F.rank().over(w).alias("c")).collect()}
    got_d = {r.id: r.d for r in dense_rank_desc(df, "v", "d").collect()}
    got_c = {r.id: r.c for r in competition_rank_desc(df, "v", "c").collect()}
    assert {i: (got_d[i], got_c[i]) for i in got_d} == want


def test_rank_windows_are_partitioned(spark):
    df = spark.range(1000).select((F.col("id") % 37).cast("double").alias("v"))
    out = dense_rank_desc(df, "v", "r")
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(__b" in plan
    assert sorted({r.r for r in out.collect()}) == list(range(1, 38))
