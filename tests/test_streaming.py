"""Incremental ingest: each file is collected exactly once across runs."""

import os
import tempfile

from salescope.schema import RAW_ORDER_COLS
from salescope.streaming import ingest_order_files


def _file(d, name, stores):
    header = ",".join(RAW_ORDER_COLS)
    lines = [",".join(["2020-11-01", "", s, "1", "SKU-1"] + ["1"] * (len(RAW_ORDER_COLS) - 5)) for s in stores]
    with open(os.path.join(d, name), "w", encoding="utf-8") as f:
        f.write(header + "\n" + "\n".join(lines) + "\n")


def test_ingest_is_incremental(spark):
    base = tempfile.mkdtemp(prefix="salescope-stream-")
    src, out, ckpt = (os.path.join(base, x) for x in ("in", "out", "ckpt"))
    os.makedirs(src)
    dim = spark.createDataFrame([("SHOP-A", "d1", "p1", "o1")], "store string, department string, platform string, operator string")
    _file(src, "a.csv", ["Shop-A", "Shop-B"])
    ingest_order_files(spark, src, dim, out, checkpoint_dir=ckpt).awaitTermination(120)
    assert spark.read.parquet(out).count() == 2
    _file(src, "b.csv", ["shop-a"])
    ingest_order_files(spark, src, dim, out, checkpoint_dir=ckpt).awaitTermination(120)
    rows = spark.read.parquet(out).collect()
    assert len(rows) == 3
    assert sorted((r.store, r.department) for r in rows) == [("shop-a", "d1"), ("shop-a", "d1"), ("shop-b", None)]


def test_ingest_resumes_without_a_named_checkpoint(spark, tmp_path):
    src, out = str(tmp_path / "in"), str(tmp_path / "out")
    os.makedirs(src)
    dim = spark.createDataFrame([("a", "d", "p", "o")], "store string, department string, platform string, operator string")
    for name, stores in (("a.csv", ["a"]), ("b.csv", ["a", "b"])):
        _file(src, name, stores)
        ingest_order_files(spark, src, dim, out).awaitTermination(120)
    assert spark.read.parquet(out).count() == 3
