"""Sources and sinks: CSV round trip, bad-file tolerance, positional read,
partitioned fan-out, target snapshot read."""

import os
import tempfile

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from salescope.schema import ORDER_COLS, RAW_ORDER_COLS
from salescope.sinks.files import land_snapshots, write_csv, write_partitioned, write_report
from salescope.sources.files import (read_order_files, read_order_files_checked, read_positional,
                                     read_table, read_target)


def _tmp():
    return tempfile.mkdtemp(prefix="salescope-test-")


def _write(path, text):
    with open(path, "w", encoding="utf-8") as f:
        f.write(text)


def test_multi_file_ingest_and_bad_files(spark):
    d = _tmp()
    header = ",".join(RAW_ORDER_COLS)
    good = ",".join(["2020-11-01", "", "Shop-A", "1", "SKU-1"] + ["1"] * (len(RAW_ORDER_COLS) - 5))
    _write(os.path.join(d, "store1.csv"), f"{header}\n{good}\n{good}\n")
    _write(os.path.join(d, "store2.csv"), f"{header}\n{good}\n")
    _write(os.path.join(d, "broken.csv"), f"{header}\n2020-11-01,,Shop-B\n")          # missing columns
    renamed = header.replace("profit", "gross")                                       # a required column absent
    _write(os.path.join(d, "renamed.csv"), f"{renamed}\n{good}\n")
    _write(os.path.join(d, "notes.txt"), "ignored\n")
    assert read_order_files(spark, d, glob="*.csv").count() == 5
    ok, rejected = read_order_files_checked(spark, d, glob="*.csv")
    assert ok.count() == 3 and ok.where("store = 'Shop-A'").count() == 3
    assert sorted(os.path.basename(r.source_file) for r in rejected.collect()) == ["broken.csv", "renamed.csv"]


def test_positional_read_keeps_header_row_until_filtered(spark):
    d = _tmp()
    _write(os.path.join(d, "a.csv"), ",".join(ORDER_COLS) + "\n" + ",".join(["x"] * len(ORDER_COLS)) + "\n")
    df = read_positional(spark, d)
    assert df.columns == ORDER_COLS and df.count() == 2


def test_csv_round_trip(spark):
    d = os.path.join(_tmp(), "out")
    df = spark.createDataFrame([("香港", 1.5), ("未更新", None)], "w string, x double")
    write_csv(df, d)
    back = read_table(spark, d, fmt="csv", schema=df.schema)
    assert sorted(back.collect(), key=str) == sorted(df.collect(), key=str)


def test_partitioned_fan_out(spark):
    d = os.path.join(_tmp(), "fan")
    df = spark.createDataFrame([("s1", "product", 1.0), ("s1", "brand", 2.0), ("s2", "product", 3.0)],
                               "store string, dimension string, growth double")
    write_partitioned(df, d, ["store", "dimension"], sort_within=[F.col("growth").desc()])
    assert sorted(os.listdir(os.path.join(d, "store=s1"))) == ["dimension=brand", "dimension=product"]
    assert read_table(spark, d).count() == 3


def test_fan_out_splits_a_large_key(spark):
    d = os.path.join(_tmp(), "fan-hot")
    df = spark.range(4000).selectExpr("'s1' AS store", "id AS growth")
    merge = "spark.sql.adaptive.coalescePartitions.enabled"         # so few rows would go to one task again
    before = spark.conf.get(merge)
    spark.conf.set(merge, "false")
    try:
        write_partitioned(df, d, ["store"], sort_within=["growth"], file_rows=1000)
    finally:
        spark.conf.set(merge, before)
    files = [os.path.join(d, "store=s1", f) for f in os.listdir(os.path.join(d, "store=s1")) if f.endswith(".parquet")]
    parts = [pq.read_table(f)["growth"].to_pylist() for f in files]
    assert 1 < len(parts) <= 4 and all(p == sorted(p) for p in parts)
    assert sorted(x for p in parts for x in p) == list(range(4000))


def test_landed_snapshot_must_be_named(spark):
    with pytest.raises(ValueError):
        land_snapshots(spark.range(1), spark.range(1), "jdbc:none", "t", land="newest")


def test_read_target_snapshot(spark):
    d = os.path.join(_tmp(), "targets")
    t = spark.createDataFrame([(20201105, "A", 10.0), (20201001, "A", 99.0)], "t long, k string, v double")
    write_report(t, d)
    rows = read_target(spark, d, 20201105).collect()
    assert [(r.key, float(r.target)) for r in rows] == [("A", 10.0)]
    plan = read_target(spark, d, 20201105)._jdf.queryExecution().executedPlan().toString()
    assert "PushedFilters: [IsNotNull(t), EqualTo(t,20201105)]" in plan


def test_month_partitioned_fact_prunes_periods(spark):
    import datetime as dt

    from salescope.operators.filters import period_slice
    from salescope.sinks.files import write_fact
    from salescope.sources.files import read_fact
    d = os.path.join(_tmp(), "fact")
    rows = [(dt.date(2020, m, day), f"o{m}{day}", float(m)) for m in (9, 10, 11) for day in (1, 15, 28)]
    fact = spark.createDataFrame(rows, "order_date date, order_no string, profit double")
    write_fact(fact, d)
    back = read_fact(spark, d)
    assert sorted(x for x in os.listdir(d) if x.startswith("order_month=")) == [
        "order_month=2020-09-01", "order_month=2020-10-01", "order_month=2020-11-01"]
    s = period_slice(back, dt.date(2020, 11, 5))
    plan = s._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_month" in plan and "order_month#" in plan
    assert sorted(r.order_no for r in s.collect()) == ["o1028", "o111"]


def test_damaged_or_misnamed_files_fail_by_name(spark, tmp_path):
    import gzip
    from salescope.sources.files import read_order_files
    rows = "a,b\n" + "\n".join(f"{i},{i * 7919 % 1009}" for i in range(20000)) + "\n"
    packed = gzip.compress(rows.encode())
    (tmp_path / "cut.csv.gz").write_bytes(packed[:len(packed) // 2])
    with pytest.raises(Exception, match="cut.csv.gz"):
        read_order_files(spark, str(tmp_path), columns=["a", "b"]).collect()
    other = tmp_path / "other"
    other.mkdir()
    (other / "x.csv").write_text("b,a\n1,2\n")
    with pytest.raises(Exception, match="x.csv"):
        read_order_files(spark, str(other), columns=["a", "b"]).collect()
    got = read_order_files(spark, str(other), columns=["first", "second"], header_names=["b", "a"]).collect()
    assert [tuple(r) for r in got] == [("1", "2")]


def test_landed_fact_is_in_date_order(spark, tmp_path):
    import datetime
    import glob

    import pyarrow.parquet as pq
    from salescope.sinks.files import write_fact
    day = datetime.date(2020, 1, 1)
    rows = [(day + datetime.timedelta(days=i * 37 % 90), str(i)) for i in range(500)]
    write_fact(spark.createDataFrame(rows, "order_date date, order_no string"), str(tmp_path / "fact"))
    files = glob.glob(f"{tmp_path}/fact/order_month=*/*.parquet")
    assert files
    for f in files:
        days = pq.ParquetFile(f).read()["order_date"].to_pylist()
        assert days == sorted(days)
