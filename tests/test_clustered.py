"""Z-order landing: both a period and a store skip most row groups by their statistics."""

import datetime as dt
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from salescope.operators import dims
from salescope.sinks.files import write_clustered, z_order


def groups(path):
    for f in sorted(os.listdir(path)):
        if f.endswith(".parquet"):
            meta = pq.ParquetFile(os.path.join(path, f)).metadata
            for g in range(meta.num_row_groups):
                yield {meta.row_group(g).column(i).path_in_schema: meta.row_group(g).column(i).statistics for i in range(meta.num_columns)}


@pytest.mark.parametrize("hot", [False, True])
def test_statistics_skip_by_date_and_by_store(spark, tmp_path, hot):
    n = 64_000
    store = F.concat(F.lit("Store#"), F.lpad(((F.col("id") * 7919) % 100).cast("string"), 4, "0"))
    if hot:
        store = F.when(F.col("id") % 3 == 0, F.lit("Store#0007")).otherwise(store)
    df = spark.range(n).select(F.date_add(F.lit(dt.date(2020, 1, 1)), ((F.col("id") * 104729) % 360).cast("int")).alias("order_date"), store.alias("store"), "id")
    df = df.unionByName(spark.createDataFrame([(None, None, -1)], df.schema))
    before = spark.conf.get("spark.sql.shuffle.partitions")
    merge = "spark.sql.adaptive.coalescePartitions.enabled"
    try:
        spark.conf.set("spark.sql.shuffle.partitions", "64")
        spark.conf.set(merge, "false")
        write_clustered(df, str(tmp_path / "z"), ["order_date", "store"])
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.set(merge, "true")
    all_groups = list(groups(tmp_path / "z"))
    assert len(all_groups) > 40
    week = [g for g in all_groups if g["order_date"].has_min_max and g["order_date"].min <= dt.date(2020, 6, 7) and g["order_date"].max >= dt.date(2020, 6, 1)]
    one = [g for g in all_groups if g["store"].has_min_max and g["store"].min <= "Store#0050" <= g["store"].max]
    assert len(week) < 0.35 * len(all_groups) and len(one) < 0.35 * len(all_groups)
    if hot:                                                    # a third of all rows in one store: no file holds more than its share
        sizes = [pq.ParquetFile(tmp_path / "z" / f).metadata.num_rows for f in os.listdir(tmp_path / "z") if f.endswith(".parquet")]
        assert max(sizes) < 3 * sorted(sizes)[len(sizes) // 2]
    back = spark.read.parquet(str(tmp_path / "z"))
    assert back.count() == n + 1 and back.columns == df.columns


def test_z_order_of_empty_and_constant_columns(spark):
    df = spark.createDataFrame([(1, None), (1, None)], "a int, b string")
    assert [r[0] for r in df.select(z_order(df, ["a", "b"])).distinct().collect()] != []
    assert df.limit(0).select(z_order(df.limit(0), ["a", "b"])).count() == 0


def test_a_frame_is_counted_once(spark, monkeypatch):
    dim = spark.createDataFrame([("a", "x")], "store string, department string")
    counted = []
    limit = type(dim).limit
    monkeypatch.setattr(type(dim), "limit", lambda self, n: counted.append(n) or limit(self, n))
    for _ in range(2):
        assert "broadcast" in dims.checked_broadcast(dim.select("store"), of=dim)._jdf.queryExecution().logical().toString()
    assert len(counted) == 1
    assert "broadcast" not in dims.checked_broadcast(dim.select("store"), max_rows=0, of=dim)._jdf.queryExecution().logical().toString()
