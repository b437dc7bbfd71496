"""Attainment reports against the worked expectations of FIXTURES.md §2."""

import pytest

from salescope.plans import attainment as at

SUMS = {"A": (120, 300), "B": (30, 100), "C": (-10, 50), "D": (5, 10)}
TARGETS = {"A": 100.0, "B": 0.0, "C": 50.0, "E": 70.0}


def _fact(spark, key):
    rows = []
    for k, (p, v) in SUMS.items():
        # split each key's sums over two rows; add a row that P7 drops
        rows += [(k, f"{p / 2}", f"{v / 2}", "1"), (k, f"{p / 2}", f"{v / 2}", "3"),
                 (k, "999", "999", "0")]
    rows.append((None, "7", "7", "1"))                 # null key: removed by the inner join
    rows.append(("A", None, "5", "1"))                 # null profit: dropped (P13)
    return spark.createDataFrame(rows, f"{key} string, profit string, revenue string, quantity string")


def _targets(spark):
    rows = [(20201105, k, t) for k, t in TARGETS.items()] + [(20201001, "A", 1.0)]
    return spark.createDataFrame(rows, "snapshot long, key string, target double")


def _by_key(df, key):
    return {r[key]: r for r in df.collect()}


def test_platform_attainment(spark):
    out = _by_key(at.platform_attainment(_fact(spark, "platform"), _targets(spark)), "platform")
    assert set(out) == {"A", "B", "C", "总计"}
    a, b, c, t = out["A"], out["B"], out["C"], out["总计"]
    assert (a.target, a.achieved, a.rate_pct, a.rank, a.rate_rank, a.revenue, a.margin_pct) == \
        (100.0, 120.0, "120.0%", 1, 1, 300.0, "40.0%")
    assert (b.rate, b.rate_pct, b.rank, b.rate_rank, b.margin_pct) == (None, None, 2, 3, "30.0%")
    assert (c.rate_pct, c.rank, c.rate_rank, c.margin_pct) == ("-20.0%", 3, 2, "-20.0%")
    assert (t.target, t.achieved, t.rate_pct, t.rank, t.rate_rank, t.revenue, t.margin_pct, t.is_total) == \
        (150.0, 140.0, "93.3%", 1, 0, 450.0, "31.1%", True)


def test_operator_attainment_fills_zero_target_rate_after_ranking(spark):
    out = _by_key(at.operator_attainment(_fact(spark, "operator"), _targets(spark)), "operator")
    assert (out["B"].rate, out["B"].rate_pct, out["B"].rate_rank) == (100.0, "100.0%", 3)
    assert out["总计"].rate_pct == "93.3%"


def test_department_attainment_drops_negative_totals(spark):
    out = _by_key(at.department_attainment(_fact(spark, "department"), _targets(spark)), "department")
    assert set(out) == {"A", "B", "总计"}
    assert out["B"].rate_rank == 2
    t = out["总计"]
    assert (t.target, t.achieved, t.rate_pct, t.rank, t.rate_rank) == (100.0, 150.0, "150.0%", 1, 0)


def test_report_total_absent_on_empty_input(spark):
    empty = _fact(spark, "platform").limit(0)
    assert at.platform_attainment(empty, _targets(spark)).count() == 0


def test_target_status(spark):
    fact = spark.createDataFrame(
        [("A", 5.0, 10.0), ("B", 5.0, 10.0), ("C", 3.0, 6.0), ("Z", 9.0, 9.0), (None, 1.0, 1.0)],
        "operator string, profit double, revenue double")
    targets = spark.createDataFrame([(20201105, k, t) for k, t in {"A": 10.0, "B": 10.0, "C": 6.0, "E": 7.0}.items()],
                                    "snapshot long, key string, target double")
    out = _by_key(at.target_status(fact, targets, "operator"), "operator")
    assert set(out) == {"A", "B", "C", "E", "总计"}          # Z has no target, E no sales
    assert [out[k].rank for k in "ABCE"] == [1, 1, 3, 4]     # competition rank
    assert [out[k].rate_rank for k in "ABCE"] == [1, 1, 1, 4]
    assert [out[k].rate_pct for k in "ABCE"] == ["50.00%"] * 3 + ["0.00%"]
    t = out["总计"]
    assert (t.achieved, t.target, t.rank, t.rate_rank, t.rate_pct, t.margin_pct) == (13.0, 33.0, 9, 7, None, None)


def test_target_status_platform_is_case_insensitive(spark):
    fact = spark.createDataFrame([("asia", 4.0, 0.0)], "platform string, profit double, revenue double")
    targets = spark.createDataFrame([(20201105, "ASIA", 0.0)], "snapshot long, key string, target double")
    r = _by_key(at.target_status(fact, targets, "platform"), "platform")["ASIA"]
    assert (r.achieved, r.rate, r.rate_pct, r.margin_pct) == (4.0, float("inf"), "inf%", "inf%")


@pytest.mark.parametrize("fn", [at.platform_attainment, at.operator_attainment])
def test_rate_rank_on_rounded_values(spark, fn):
    key = "platform" if fn is at.platform_attainment else "operator"
    fact = spark.createDataFrame([("X", "1.0001", "1", "1"), ("Y", "1.0002", "1", "1")],
                                 f"{key} string, profit string, revenue string, quantity string")
    targets = spark.createDataFrame([(20201105, "X", 100.0), (20201105, "Y", 100.0)],
                                    "snapshot long, key string, target double")
    rows = [r for r in fn(fact, targets).collect() if not r.is_total]
    assert {r.rank for r in rows} == {1} and {r.rate_rank for r in rows} == {1}   # Q7: ties after rounding


@pytest.mark.parametrize("fn", [at.platform_attainment, at.operator_attainment, at.department_attainment])
def test_body_rows_keep_cents_next_to_scale_one_total(spark, fn):
    key = {at.platform_attainment: "platform", at.operator_attainment: "operator",
           at.department_attainment: "department"}[fn]
    fact = spark.createDataFrame([("X", "1.25", "3.33", "1"), ("Y", "2.05", "4.01", "1")],
                                 f"{key} string, profit string, revenue string, quantity string")
    targets = spark.createDataFrame([(20201105, "X", 10.0), (20201105, "Y", 10.0)],
                                    "snapshot long, key string, target double")
    out = {r[key]: r for r in fn(fact, targets).collect()}
    assert (out["X"].achieved, out["Y"].achieved, out["总计"].achieved) == (1.25, 2.05, 3.3)
    if key != "department":
        assert (out["X"].revenue, out["Y"].revenue) == (3.33, 4.01)


def test_sums_are_rounded_once(spark):
    from decimal import Decimal
    from salescope.plans.attainment import _report_sums
    rows = [("s", "1", "0.004", "0.0049")] * 1000
    fact = spark.createDataFrame(rows, "store string, quantity string, profit string, revenue string")
    row = _report_sums(fact, "store", with_revenue=True).first()
    assert (row["achieved"], row["revenue"]) == (Decimal("4.00"), Decimal("4.90"))
