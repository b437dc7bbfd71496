"""Percent text as a float formatter prints it; rank ranges on clustered values; report plans without needless joins."""

import math

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salescope.functions import numeric as fn
from salescope.operators import ranking
from salescope.plans import catalog as cat

SF = "/root/testdata/sf0.001"
TIES = [1.015, 1.005, 0.125, 0.375, 2.675, 1.115, -0.125, -0.001, -0.0, 0.0, 4503599627370497.5, 0.005, 0.015, 0.025, 5e-324, 1 / 3, -2.5, 99.995, 9007199254740993.0]


def test_ties_and_signs(spark):
    rng = np.random.default_rng(3)
    # near and at ties of every size
    near = [float(np.nextafter(x, y)) for x in np.round(rng.uniform(-1e4, 1e4, 3000), 1) + 0.005 for y in (-np.inf, np.inf)]
    values = TIES + near + list(rng.integers(-10**6, 10**6, 2000) / 8) + list(rng.uniform(-1e12, 1e12, 2000))
    got = [r[0] for r in spark.createDataFrame([(float(v),) for v in values], "x double").select(fn.float_fixed("x")).collect()]
    assert got == [f"{v:.2f}" for v in values]


def test_large_values_have_their_exact_decimals(spark):
    rng = np.random.default_rng(5)
    values = [238833386172828.3125, 1e14, -1e14, 2.0 ** 53, 8.9e18, *(float(v) for e in range(13, 19) for v in rng.uniform(-10.0 ** e, 10.0 ** e, 2000)),
              *(float(np.nextafter(2.0 ** 46, y)) for y in (0, np.inf)), *(10.0 ** 14 + k / 64 for k in range(64))]
    values = [v for v in values if abs(v) < 9e18]
    got = [r[0] for r in spark.createDataFrame([(v,) for v in values], "x double").select(fn.float_fixed("x")).collect()]
    assert got == [f"{v:.2f}" for v in values]
    odd = [math.inf, -math.inf, None, 1e300, 9e18]
    assert len(spark.createDataFrame([(v,) for v in odd], "x double").select(fn.float_fixed("x")).collect()) == len(odd)


@settings(max_examples=20, deadline=None)
@given(st.lists(st.tuples(st.floats(-1e9, 1e9), st.floats(-1e9, 1e9)), min_size=1, max_size=200))
def test_sheet_percent(spark, pairs):
    def python(a, b):
        ratio = a / b if b else (math.inf if a > 0 else -math.inf if a < 0 else 0.0)
        return format(ratio, ".2%")

    df = spark.createDataFrame([(float(a), float(b)) for a, b in pairs], "a double, b double")
    got = [r[0] for r in df.select(fn.sheet_pct_text(fn.sheet_ratio("a", "b"))).collect()]
    want = [python(a, b) for a, b in pairs]
    assert [g for g, w, (a, b) in zip(got, want, pairs) if abs(a / b if b else 0) < 2 ** 46] == [w for w, (a, b) in zip(want, pairs) if abs(a / b if b else 0) < 2 ** 46]


@pytest.mark.parametrize("kind", ["clustered", "equal", "few"])
def test_rank_ranges_hold_alike(spark, tmp_path, kind):
    n = 40_000
    x = {"clustered": F.when(F.col("id") % 100 == 0, F.col("id") * 1_000_000).otherwise(F.lit(5000) + F.col("id") / 1e6),
         "equal": F.when(F.col("id") % 3 > 0, F.lit(7.0)).otherwise(F.col("id").cast("double")),
         "few": F.when(F.col("id") % 5 == 0, F.lit(None)).otherwise(F.col("id") % 3)}[kind]
    spark.range(n).select("id", x.cast("double").alias("v")).write.parquet(str(tmp_path / "v"))
    df = spark.read.parquet(str(tmp_path / "v"))
    values = df.groupBy(F.col("v").alias("__v")).count()
    sizes = [r["count"] for r in values.withColumn("b", ranking._bucket_expr(values)).groupBy("b").count().collect()]
    assert max(sizes) <= 3 * sorted(sizes)[len(sizes) // 2] + 3
    out = ranking.distributed_competition_rank_desc(ranking.distributed_dense_rank_desc(df, "v", "dense"), "v", "rank").toPandas()
    assert (out["dense"] == out["v"].rank(method="dense", ascending=False, na_option="bottom")).all()
    assert (out["rank"] == out["v"].rank(method="min", ascending=False, na_option="bottom")).all()


@pytest.mark.parametrize("name,goods", [("target_status_operator", 0), ("store_week_compare", 0), ("product_week_compare", 0), ("store_dimension_week_compare", 1),
                                        ("store_movers_top", 0), ("product_movers_bottom", 0)])
def test_reports_join_what_they_put_out(spark, name, goods):
    """No report joins a goods dimension that none of its columns needs; the movers join theirs to k rows."""
    plan = cat.all_queries()[name](spark, SF)._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("product1_brand") > 0 if goods else "product1_brand" not in plan
    assert "Window" not in plan or name.startswith("target")
