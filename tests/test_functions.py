"""Scalar conventions: division by zero (Q4), rounding (Q5), text forms."""

import datetime as dt

from pyspark.sql import functions as F

from salescope.functions import numeric as fn
from salescope.functions import text as tx


def _one(spark, expr, schema, rows):
    return [r[0] for r in spark.createDataFrame(rows, schema).select(expr).collect()]


def test_sheet_ratio_and_percent(spark):
    rows = [(1.0, 0.0), (-1.0, 0.0), (0.0, 0.0), (None, 1.0), (1.0, 4.0), (15.0, -10.0), (1.0, None)]
    got = _one(spark, fn.sheet_pct_text(fn.sheet_ratio("n", "d")), "n double, d double", rows)
    assert got == ["inf%", "-inf%", "0.00%", "0.00%", "25.00%", "-150.00%", "0.00%"]


def test_safe_ratio_null_on_zero(spark):
    got = _one(spark, fn.safe_ratio("n", "d"), "n double, d double", [(1.0, 0.0), (3.0, 2.0), (None, 2.0)])
    assert got == [None, 1.5, None]


def test_report_percent_text(spark):
    rows = [("120.00",), ("93.33",), ("93.30",), ("0.00",), ("-20.00",), (None,)]
    got = _one(spark, fn.report_pct_text(F.col("x").cast("decimal(28,2)")), "x string", rows)
    assert got == ["120.0%", "93.33%", "93.3%", "0.0%", "-20.0%", None]
    one = _one(spark, fn.report_pct_text(F.col("x").cast("decimal(28,1)")), "x string", [("93.3",), ("150.0",)])
    assert one == ["93.3%", "150.0%"]


def test_rounding_modes(spark):
    rows = [(1.005,), (1.015,), (1.025,), (-2.5,)]
    up = _one(spark, fn.round_half_up("x", 2).cast("double"), "x double", rows)
    even = _one(spark, fn.round_half_even("x", 2).cast("double"), "x double", rows)
    assert up == [1.01, 1.02, 1.03, -2.5]
    assert even == [1.0, 1.02, 1.02, -2.5]
    assert _one(spark, fn.round_half_even("x", 0).cast("double"), "x double", [(2.5,), (3.5,)]) == [2.0, 4.0]


def test_growth_and_rate(spark):
    rows = [(50.0, 40.0), (30.0, None), (None, 20.0), (5.0, -10.0), (7.0, 0.0), (0.0, 0.0)]
    df = spark.createDataFrame(rows, "n double, o double")
    got = df.select(fn.growth("n", "o").alias("g"), fn.sheet_pct_text(fn.growth_rate("n", "o")).alias("r")).collect()
    assert [(r.g, r.r) for r in got] == [(10.0, "25.00%"), (30.0, "0.00%"), (-20.0, "0.00%"),
                                         (15.0, "-150.00%"), (7.0, "inf%"), (0.0, "0.00%")]


def test_text_helpers(spark):
    df = spark.createDataFrame([(12.0, None, "1,234.50", "未更新", dt.date(2021, 1, 3))],
                               "a double, b string, s string, f string, d date")
    r = df.select(tx.id_text(df, "a").alias("a"), tx.id_text(df, "b").alias("b"),
                  tx.thousands_number(df, "s", "decimal(18,2)").alias("s"),
                  tx.sentinel_number(df, "f", "decimal(18,2)").alias("f"),
                  tx.iso_week(df, "d").alias("w")).first()
    assert (r.a, r.b, float(r.s), r.f, r.w) == ("12", "", 1234.5, None, 53)


def test_period_bounds_and_anchor():
    from salescope.operators.filters import anchor_date, period_bounds
    b = period_bounds(dt.date(2020, 11, 5))
    assert (b["new_start"], b["new_end"]) == (dt.date(2020, 10, 30), dt.date(2020, 11, 5))
    assert (b["old_start"], b["old_end"]) == (dt.date(2020, 10, 23), dt.date(2020, 10, 29))
    assert anchor_date(dt.date(2020, 11, 7)) == dt.date(2020, 11, 5)
