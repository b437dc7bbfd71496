"""Cleaning (R5) and collecting (R1-R3) on a hand-written all-text fixture."""

from decimal import Decimal

import pytest

from salescope.operators.cleaning import clean_orders
from salescope.operators.dims import duplicate_keys
from salescope.operators.fills import round_money
from salescope.plans.collect import collect_orders, merge_snapshots, repair_orders
from salescope.schema import RAW_ORDER_COLS, RAW_ORDERS_STRING


def _raw(spark):
    base = dict.fromkeys(RAW_ORDER_COLS)
    rows = []
    for i, over in enumerate([
        dict(order_date="2021-01-03", store="Shop-A", order_no=None, product="SKU-1", product2=None,
             quantity="1", unit_price="5", settle_total="1,234.50", freight_first="未更新", revenue="100",
             cost_total="40", handling_fee="1", freight_last=None, capital_cost="2", profit="57.005",
             warehouse="香港", country="de", tracking_no="777"),
        dict(order_date="2020-11-05 10:00:00", store="shop-b", order_no="12", product="SKU-2", product2="SKU-1",
             quantity="2", unit_price="7.5", settle_total="5", freight_first="3", revenue="10",
             cost_total="20", handling_fee=None, freight_last="1", capital_cost=None, profit="-10",
             warehouse="US", country="fr"),
        dict(order_date="2020-11-05", store="Shop-A", product=None, quantity="1", profit="1"),
    ]):
        r = dict(base, **over)
        rows.append(tuple(r[c] for c in RAW_ORDER_COLS))
    return spark.createDataFrame(rows, RAW_ORDERS_STRING)


def _dims(spark):
    store = spark.createDataFrame([("SHOP-A", "d1", "p1", "o1", None), (None, "dx", "px", "ox", None)],
                                  "store string, department string, platform string, operator string, updatetime date")
    goods = spark.createDataFrame([(1, "SKU-1", "b1", "c1", "m1"), (2, None, "bn", "cn", "mn")],
                                  "id long, sku string, brand string, category string, manager string")
    return store, goods


def test_clean_orders(spark):
    store, goods = _dims(spark)
    out = {r.product: r for r in clean_orders(_raw(spark), store, goods).collect()}
    assert set(out) == {"SKU-1", "SKU-2"}                      # null product dropped
    a, b = out["SKU-1"], out["SKU-2"]
    assert a.week == 53 and str(a.order_date) == "2021-01-03"
    assert float(a.settle_total) == 1234.5 and float(a.freight_first) == 0.0 and float(a.freight_last) == 0.0
    assert float(a.profit) == 57.0                             # half-even at 2 places
    assert a.order_no == "" and a.country == "DE" and a.is_loss == "否"
    assert float(a.corrected_profit) == 100 - 40 - 1 - 0 - 0 - 2
    assert (a.department, a.platform, a.operator) == ("d1", "p1", "o1")      # case-insensitive (J1)
    assert (a.product1_brand, a.product2_brand) == ("b1", None)
    assert b.is_loss == "是" and b.department is None and b.product2_manager == "m1"
    assert float(b.corrected_profit) == 10 - 20 - 0 - 3 - 1 - 0
    assert b.tracking_no == ""


def test_collect_merge_repair(spark):
    store, _ = _dims(spark)
    col = collect_orders(_raw(spark), store)
    assert col.columns[-3:] == ["platform", "department", "operator"]
    rows = col.collect()
    assert {r.store for r in rows} == {"shop-a", "shop-b"}
    assert sum(r.department == "d1" for r in rows) == 2
    merged = merge_snapshots(col, col.drop("payment_status"))
    assert merged.count() == 6 and "payment_status" in merged.columns
    rep = repair_orders(col.drop("department", "platform", "operator"), store)
    assert rep.where("department = 'd1'").count() == 2


def test_duplicate_dimension_keys_are_reported(spark):
    dim = spark.createDataFrame([("Shop-A",), ("SHOP-A",), ("b",)], "store string")
    assert [r.key for r in duplicate_keys(dim, "store").collect()] == ["shop-a"]


def test_dimension_broadcast_only_under_the_bound(spark):
    from pyspark.sql import functions as F

    from salescope.operators.dims import checked_broadcast
    fact = spark.range(2000).select(F.concat(F.lit("k"), (F.col("id") % 300).cast("string")).alias("k"))
    dim = spark.range(300).select(F.concat(F.lit("k"), F.col("id").cast("string")).alias("k"), F.lit("v").alias("v"))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        small = fact.join(checked_broadcast(dim, max_rows=1000), "k", "left")
        large = fact.join(checked_broadcast(dim, max_rows=100), "k", "left")
        p_small = small._jdf.queryExecution().executedPlan().toString()
        p_large = large._jdf.queryExecution().executedPlan().toString()
        assert "BroadcastHashJoin" in p_small
        assert "BroadcastHashJoin" not in p_large and "SortMergeJoin" in p_large
        assert small.count() == large.count() == 2000
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", str(10 * 1024 * 1024))
        spark.conf.set("spark.sql.adaptive.enabled", "true")


def test_money_range_and_single_rounding(spark):
    df = spark.createDataFrame([("2000000000000",), ("9999999999999999.99",), ("1.0050000004",), ("1.005",), ("-0.00499999999",), (None,)], "revenue string")
    got = [r[0] for r in round_money(df, ["revenue"]).collect()]
    assert got == [Decimal(x) for x in ("2000000000000.00", "9999999999999999.99", "1.01", "1.00", "0.00", "0.00")]
    with pytest.raises(Exception):
        round_money(spark.createDataFrame([("99999999999999999",)], "revenue string"), ["revenue"]).collect()
