"""Week-over-week comparison and movers: FIXTURES.md §2 (Q15, Q16, Q23, Q27)."""

import datetime as dt

from pyspark.sql import functions as F

from salescope.plans import compare as cmp
from salescope.plans import movers as mv

AS_OF = dt.date(2020, 11, 5)
NEW, OLD = dt.date(2020, 11, 2), dt.date(2020, 10, 25)


def _fact(spark):
    rows = [
        ("a", NEW, 50), ("a", OLD, 40),
        ("b", NEW, 30),
        ("c", OLD, 20),
        ("d", NEW, 5), ("d", OLD, -10),
        ("e", NEW, 7), ("e", OLD, 0),
        ("f", NEW, 0), ("f", OLD, 0),
        ("a", dt.date(2020, 10, 22), 1000), ("a", dt.date(2020, 11, 6), 1000),   # outside both periods
        ("g", dt.date(2020, 1, 1), 5),                                            # idle store
    ]
    df = spark.createDataFrame([(s, d, float(p)) for s, d, p in rows], "store string, order_date date, profit double")
    return df.select("store", "order_date", F.col("profit").cast("decimal(18,2)").alias("profit"),
                     F.lit(100).cast("decimal(18,2)").alias("revenue"), F.lit(1.0).alias("quantity"),
                     F.col("store").alias("product"), F.lit("brand-x").alias("product1_brand"),
                     F.lit(None).cast("string").alias("product1_category"))


def test_store_week_compare(spark):
    out = {r.store: r for r in cmp.store_week_compare(_fact(spark), AS_OF).collect()}
    assert set(out) == set("abcdef") | {"总计"}
    got = {k: (float(out[k].profit_new), float(out[k].profit_old), float(out[k].growth), out[k].growth_rate)
           for k in "abcdef"}
    assert got == {"a": (50, 40, 10, "25.00%"), "b": (30, 0, 30, "0.00%"), "c": (0, 20, -20, "0.00%"),
                   "d": (5, -10, 15, "-150.00%"), "e": (7, 0, 7, "inf%"), "f": (0, 0, 0, "0.00%")}
    assert out["b"].margin_old == "0" and out["b"].margin_new == "30.00%"        # Q23
    t = out["总计"]
    assert (float(t.profit_new), float(t.profit_old), float(t.growth), t.growth_rate) == (92, 50, 42, None)


def test_week_compare_is_sorted_by_growth(spark):
    keys = [r.store for r in cmp.store_week_compare(_fact(spark), AS_OF).collect()]
    assert keys == ["b", "d", "a", "e", "f", "c", "总计"]


def test_movers(spark):
    c = cmp.store_week_compare(_fact(spark), AS_OF)
    dim = spark.createDataFrame([("B", "dep", "pf", "op")], "store string, department string, platform string, operator string")
    top = mv.store_movers(c, dim, "top", k=2).collect()
    bottom = mv.store_movers(c, dim, "bottom", k=2).collect()
    assert [r.store for r in top] == ["b", "d"]
    assert top[0].department == "dep" and top[1].department is None             # case-insensitive (Q13)
    assert [r.store for r in bottom] == ["f", "c"]


def test_movers_plan_is_top_k(spark):
    c = cmp.store_week_compare(_fact(spark), AS_OF)
    plan = mv.top_k(c, "store", 2, ["store", "growth"])._jdf.queryExecution().executedPlan().toString()
    assert "TakeOrderedAndProject" in plan


def test_store_dimension_compare(spark):
    out = cmp.store_dimension_week_compare(_fact(spark), AS_OF).collect()
    totals = {(r.store, r.dimension): r for r in out if r.is_total}
    # every store of the whole fact gets a total per dimension, idle ones as zeros (Q27)
    assert set(totals) == {(s, d) for s in "abcdefg" for d in ("product", "brand", "category")}
    assert float(totals[("g", "product")].growth) == 0.0
    body = {(r.store, r.dimension, r.value): r for r in out if not r.is_total}
    # category is null everywhere: no rows, only totals
    assert not [k for k in body if k[1] == "category"]
    # brand baseline: mean over all stores of the period (Q21)
    a = body[("a", "brand", "brand-x")]
    assert float(a.avg_profit_new) == round((50 + 30 + 5 + 7 + 0) / 5, 2)
    assert float(a.avg_profit_old) == round((40 + 20 - 10 + 0 + 0) / 5, 2)
    b = body[("b", "brand", "brand-x")]
    assert float(b.avg_profit_old) == 0.0 and b.growth_rate == "0.00%"        # absent in old period
    assert float(totals[("a", "product")].growth) == 10.0


def test_week_reports_share_one_slice(spark):
    fact = _fact(spark)
    out = cmp.week_reports(fact, AS_OF)
    try:
        for name, single in [("store_week_compare", cmp.store_week_compare(fact, AS_OF)),
                             ("product_week_compare", cmp.product_week_compare(fact, AS_OF)),
                             ("store_dimension_week_compare", cmp.store_dimension_week_compare(fact, AS_OF))]:
            shared = out[name]
            assert shared.exceptAll(single).count() == 0 and single.exceptAll(shared).count() == 0, name
        # idle store "g" still gets its totals though it is outside the slice
        assert out["store_dimension_week_compare"].where("store = 'g' AND is_total").count() == 3
    finally:
        out["slice"].unpersist()
