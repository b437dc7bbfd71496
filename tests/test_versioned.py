"""Versioned tables: whole commits, replaced partitions, two writers, daily states."""

import datetime as dt
import os

import pytest
from pyspark.sql import functions as F

from salescope.plans import catalog as cat
from salescope.plans import compare, states
from salescope.plans.collect import seed_targets
from salescope.sinks.files import write_partitioned
from salescope.sinks.versioned import VersionedTable, land, seed
from salescope.sources import testbed as tb

SCHEMA = "snapshot long, key string, target double"
SF = "/root/testdata/sf0.001"


def rows(df):
    return sorted(map(tuple, df.collect()), key=str)


def test_seeding_twice_leaves_it_once(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), "snapshot")
    with pytest.raises(ValueError):
        t.read()
    keys = spark.createDataFrame([("a", 1.0), ("b", 2.0)], "key string, target double")
    assert seed(t, seed_targets(keys, 1)) == 0
    assert seed(t, seed_targets(keys, 2)) == 1
    assert seed(t, seed_targets(keys.where("key = 'b'"), 1)) == 2
    assert rows(t.read()) == [(1, "b", 2.0), (2, "a", 1.0), (2, "b", 2.0)] and t.read().columns == ["snapshot", "key", "target"]
    assert rows(t.read(1)) == [(1, "a", 1.0), (1, "b", 2.0), (2, "a", 1.0), (2, "b", 2.0)]
    assert t.append(seed_targets(keys.where("key = 'a'"), 1)) == 3
    assert rows(t.read().where("snapshot = 1")) == [(1, "a", 1.0), (1, "b", 2.0)]
    assert "PartitionFilters: [isnotnull(snapshot" in t.read().where("snapshot = 1")._jdf.queryExecution().executedPlan().toString()
    t.overwrite(seed_targets(keys.limit(0), 1))
    assert t.read().count() == 0 and t.read().columns == ["snapshot", "key", "target"]
    with pytest.raises(ValueError, match="has the columns"):
        t.replace(keys)
    with pytest.raises(ValueError, match="no version"):
        t.read(99)


def test_reader_sees_no_half_commit(spark, tmp_path, monkeypatch):
    t = VersionedTable(spark, str(tmp_path / "t"), "snapshot")
    df = spark.createDataFrame([(1, "a", 1.0)], SCHEMA)
    t.replace(df)
    with monkeypatch.context() as m:                         # the writer is lost between its rows and its manifest
        m.setattr(VersionedTable, "_publish", lambda *a: (_ for _ in ()).throw(RuntimeError("lost")))
        with pytest.raises(RuntimeError):
            t.replace(df.withColumn("target", F.lit(2.0)))
    assert rows(t.read()) == [(1, "a", 1.0)]
    t.replace(df.withColumn("target", F.lit(3.0)))
    assert rows(t.read()) == [(1, "a", 3.0)] and t.versions() == [0, 1]


def test_two_writers(spark, tmp_path):
    """A version is taken once; the other writer merges with what it left."""
    a, b = (VersionedTable(spark, str(tmp_path / "t"), "snapshot") for _ in range(2))
    assert a._publish(0, {"x": 1}) and not b._publish(0, {"x": 2})
    assert a._read_json("versions/0000000000.json") == {"x": 1} and os.listdir(tmp_path / "t") == ["versions"]
    # the rename that other file systems use refuses as well
    link = os.link
    try:
        os.link = None
        b._fs = type("Fs", (), {"__getattr__": lambda self, n: getattr(a._fs, n),
                                "getUri": lambda self: type("U", (), {"getScheme": lambda s: "hdfs"})()})()
    finally:
        os.link = link
    c = VersionedTable(spark, str(tmp_path / "u"), "snapshot")
    seen = []
    publish = VersionedTable._publish

    def late(self, version, manifest):
        if not seen:                                         # another writer comes first
            seen.append(version)
            d = VersionedTable(spark, str(tmp_path / "u"), "snapshot")
            d.replace(spark.createDataFrame([(2, "b", 2.0)], SCHEMA))
        return publish(self, version, manifest)

    VersionedTable._publish = late
    try:
        assert c.replace(spark.createDataFrame([(1, "a", 1.0)], SCHEMA)) == 1
    finally:
        VersionedTable._publish = publish
    assert rows(c.read()) == [(1, "a", 1.0), (2, "b", 2.0)]


def test_land(spark, tmp_path):
    t = VersionedTable(spark, str(tmp_path / "t"), "snapshot")
    one, two = (spark.createDataFrame([(1, k, 1.0)], SCHEMA) for k in "ab")
    land(t, one, two)
    assert rows(t.read()) == [(1, "a", 1.0)]
    land(t, one, two, "merged")
    assert rows(t.read()) == [(1, "b", 1.0)]
    with pytest.raises(ValueError):
        land(t, one, two, "newest")


def test_states_equal_the_full_scan(spark, tmp_path):
    fact = cat.cleaned_by_store_and_product(spark, SF).where(F.col("order_date") >= dt.date(2001, 7, 10))
    fact.write.parquet(str(tmp_path / "fact"))
    fact = spark.read.parquet(str(tmp_path / "fact"))
    table = states.state_table(spark, str(tmp_path / "states"))
    middle = dt.date(2001, 7, 20)
    states.land_days(table, fact.where(F.col("order_date") <= middle))
    states.land_days(table, fact.where(F.col("order_date") >= middle))        # a day again: replaced, not doubled
    got = states.reports(table.read(), tb.AS_OF)
    want = {"store_week_compare": compare.store_week_compare(fact, tb.AS_OF), "product_week_compare": compare.product_week_compare(fact, tb.AS_OF),
            "store_dimension_week_compare": compare.store_dimension_week_compare(fact, tb.AS_OF),
            "entity_dimension_week_compare": compare.entity_dimension_week_compare(fact, tb.AS_OF)}
    for name, report in want.items():
        assert rows(cat.presentable(got[name])) == rows(cat.presentable(report)), name
    # only the days of the two weeks are read, and none of the fact
    plan = got["store_week_compare"]._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(order_date" in plan and "/fact" not in plan


def test_fan_out_by_size(spark, tmp_path):
    """A key with a third of all rows gets files in proportion, a small one gets one."""
    df = spark.range(0, 90_000, numPartitions=6).select(
        F.when(F.col("id") % 3 == 0, "hot").when(F.col("id") % 30 != 1, F.concat(F.lit("k"), (F.col("id") % 30).cast("string"))).alias("store"),
        F.col("id").alias("v"))
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    keep = {k: spark.conf.get(k) for k in (merge, "spark.sql.shuffle.partitions")}
    try:
        spark.conf.set(merge, "false")
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        write_partitioned(df, str(tmp_path / "out"), ["store"], sort_within=["v"], file_rows=3_000)
    finally:
        for k, v in keep.items():
            spark.conf.set(k, v)
    files = {d: [f for f in os.listdir(tmp_path / "out" / d) if f.startswith("part-")] for d in os.listdir(tmp_path / "out") if "=" in d}
    assert len(files.pop("store=hot")) >= 7 and {len(f) for f in files.values()} == {1} and len(files) == 20
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == 90_000 and back.where("store = 'hot'").count() == 30_000 and back.where("store is null").count() == 3_000
