"""Properties on the provided sf0.001 tables and on generated values."""

from decimal import Decimal

from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from salescope.functions import numeric as fn
from salescope.operators.filters import period_bounds
from salescope.operators.fills import round_money
from salescope.plans import catalog as cat
from salescope.plans import compare as cmp
from salescope.plans import movers as mv
from salescope.sources import testbed as tb

SF = "/root/testdata/sf0.001"
SUM_COLS = ["profit_new", "revenue_new", "quantity_new", "profit_old", "revenue_old", "quantity_old", "growth"]


def test_total_row_is_sum_of_rows(spark):
    df = cmp.store_week_compare(cat.cleaned(spark, SF), tb.AS_OF)
    body = df.where(~F.col("is_total")).agg(*[F.sum(c).alias(c) for c in SUM_COLS]).first()
    total = df.where(F.col("is_total")).first()
    for c in SUM_COLS:
        assert round(float(total[c]), 2) == round(float(body[c]), 2), c


def test_compare_has_every_key_of_both_periods(spark):
    fact = cat.cleaned(spark, SF)
    b = period_bounds(tb.AS_OF)
    keys = {r[0] for r in fact.where(F.col("order_date").between(b["old_start"], b["new_end"]))
            .select(F.lower("store")).distinct().collect()}
    got = {r.store for r in cmp.store_week_compare(fact, tb.AS_OF).where(~F.col("is_total")).collect()}
    assert got == keys and keys


def test_movers_are_rows_of_the_comparison(spark):
    c = cmp.product_week_compare(cat.cleaned(spark, SF), tb.AS_OF)
    rows = {(r.product, float(r.growth)) for r in c.where(~F.col("is_total")).collect()}
    picked = mv.product_movers(c, tb.goods_dim(spark, SF), "top").collect() + \
        mv.product_movers(c, tb.goods_dim(spark, SF), "bottom").collect()
    assert {(r.product, float(r.growth)) for r in picked} <= rows
    top = [float(r.growth) for r in mv.product_movers(c, tb.goods_dim(spark, SF), "top").collect()]
    assert top == sorted(top, reverse=True) and top[0] == max(g for _, g in rows)


def test_cleaning_money_is_idempotent(spark):
    money = ["revenue", "profit", "cost_total", "capital_cost"]
    once = round_money(cat.cleaned(spark, SF).select(*money), money)
    twice = round_money(once, money)
    assert once.exceptAll(twice).count() == 0 and twice.exceptAll(once).count() == 0


money = st.decimals(min_value=Decimal("-1e9"), max_value=Decimal("1e9"), places=2, allow_nan=False)


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(money, money), min_size=1, max_size=20))
def test_growth_is_antisymmetric(spark, pairs):
    df = spark.createDataFrame([(str(a), str(b)) for a, b in pairs], "a string, b string") \
        .select(F.col("a").cast("decimal(18,2)").alias("a"), F.col("b").cast("decimal(18,2)").alias("b"))
    bad = df.where(fn.growth("a", "b") != -fn.growth("b", "a")).count()
    assert bad == 0


@settings(max_examples=25, deadline=None)
@given(st.lists(st.tuples(st.floats(-1e6, 1e6), st.floats(-1e6, 1e6)), min_size=1, max_size=20))
def test_sheet_percent_text_shape(spark, pairs):
    df = spark.createDataFrame(pairs, "n double, d double")
    texts = [r[0] for r in df.select(fn.sheet_pct_text(fn.sheet_ratio("n", "d"))).collect()]
    import re
    assert all(t is None or re.fullmatch(r"-?\d+\.\d\d%|-?inf%", t) for t in texts), texts
