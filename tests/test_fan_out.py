"""Fan-out into many directories: written by Arrow in the tasks, read back by the files' own paths."""

import datetime as dt
import decimal
import glob
import os

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from salescope.plans import compare
from salescope.sinks import fan_out
from salescope.sinks.files import write_partitioned
from salescope.sources.files import read_table

ODD = ["a", "A b", "a/b#c=%41[x]^{y}", "100%", "x+y z", "line\nbreak", "'\"\\:*?", "总计é", None, "", "__x", "1"]


def odd(spark):
    rows = [(v, k, i * 3 + k, decimal.Decimal("1.25"), decimal.Decimal(10) ** 30, dt.date(2020, 1, 1 + k), dt.datetime(2020, 1, 1, 5), None, b"x", k == 1) for i, v in enumerate(ODD) for k in range(3)]
    return spark.createDataFrame(rows, "store string, `the no` int, n long, small decimal(18,2), large decimal(38,2), day date, at timestamp, none double, raw binary, flag boolean")


def test_odd_names_and_types_come_back(spark, tmp_path):
    df = odd(spark)
    path = str(tmp_path / "t=1")
    write_partitioned(df, path, ["store", "the no"], sort_within=[F.col("n").desc()])
    back = read_table(spark, path, schema=df.schema, by=["store", "the no"])
    assert back.dtypes == df.dtypes
    want = [tuple(r) for r in df.withColumn("store", F.nullif("store", F.lit(""))).collect()]
    assert sorted(map(repr, map(tuple, back.collect()))) == sorted(map(repr, want))
    # the layout is Spark's own: what its own reader and writer make of it is the same
    other = str(tmp_path / "spark")
    df.write.partitionBy("store", "the no").parquet(other)
    folders = lambda p: sorted(os.path.relpath(d, p) for d, _, files in os.walk(p) if any(f.endswith(".parquet") for f in files))
    assert folders(path) == folders(other)
    assert sorted(map(repr, spark.read.parquet(path).collect())) == sorted(map(repr, spark.read.parquet(other).collect()))
    types = lambda p: pq.ParquetFile(next(glob.iglob(f"{p}/**/*.parquet", recursive=True), None) or "").schema_arrow.remove_metadata()
    assert types(path).names == types(other).names
    assert sorted(os.listdir(tmp_path)) == ["spark", "t=1"]         # nothing is left beside it


def test_overwrite_and_error_modes(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(6).select((F.col("id") % 3).cast("string").alias("k"), "id")
    write_partitioned(df, path, ["k"])
    write_partitioned(df.where("k <> '0'"), path, ["k"])
    assert sorted(x for x in os.listdir(path) if x.startswith("k=")) == ["k=1", "k=2"]
    with pytest.raises(FileExistsError):
        write_partitioned(df, path, ["k"], mode="error")
    write_partitioned(df, path, ["k"], mode="append")                # by Spark's writer
    assert read_table(spark, path, schema=df.schema, by=["k"]).count() == 4 + 6


def test_a_failed_fan_out_leaves_the_old_one(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(6).select((F.col("id") % 3).cast("string").alias("k"), "id")
    write_partitioned(df, path, ["k"])
    with pytest.raises(Exception, match="DIVIDE_BY_ZERO"):
        fan_out.write(df.withColumn("id", F.expr("1 div (id - 5)")), path, ["k"], "overwrite", [])
    assert read_table(spark, path, schema=df.schema, by=["k"]).count() == 6 and os.listdir(tmp_path) == ["t"]


def test_long_files_are_written_in_parts(spark, tmp_path):
    path = str(tmp_path / "t")
    df = spark.range(0, 50_000, 1, 3).select(F.lit("k").alias("k"), "id", F.repeat(F.lit("x"), 2000).alias("text"))
    write_partitioned(df, path, ["k"], sort_within=["id"])
    (file,) = glob.glob(f"{path}/k=k/*.parquet")
    assert pq.ParquetFile(file).num_row_groups > 1
    assert pq.read_table(file, columns=["id"])["id"].to_pylist() == list(range(50_000))


def test_empty_fan_out_reads_as_empty(spark, tmp_path):
    df = spark.range(0).select(F.col("id").cast("string").alias("k"), "id")
    write_partitioned(df, str(tmp_path / "t"), ["k"])
    back = read_table(spark, str(tmp_path / "t"), schema=df.schema, by=["k"])
    assert back.columns == ["k", "id"] and back.count() == 0


def test_many_directories_are_not_coalesced_or_looked_up_by_spark(spark, tmp_path):
    """Tasks by number of files rather than bytes, and no partition columns of Spark's own, whose discovery is quadratic."""
    path = str(tmp_path / "t")
    df = spark.range(400).select(F.col("id").cast("string").alias("k"), "id")
    write_partitioned(df, path, ["k"])
    assert len({os.path.basename(f) for f in glob.glob(f"{path}/k=*/*.parquet")}) >= 8
    back = read_table(spark, path, schema=df.schema, by=["k"])
    assert back._jdf.queryExecution().analyzed().collectLeaves().head().relation().partitionSchema().isEmpty()
    assert sorted(tuple(r) for r in back.collect()) == sorted((str(i), i) for i in range(400))


def test_the_list_of_stores_computes_no_joined_columns(spark):
    day = F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 30).cast("int"))
    fact = spark.range(300).select(day.alias("order_date"), (F.col("id") % 7).cast("string").alias("store"), F.col("id").cast("string").alias("product"),
                                   *[F.col("id").cast("decimal(18,2)").alias(m) for m in ("profit", "revenue")], F.lit(1.0).alias("quantity"))
    dim = spark.range(300).select(F.col("id").cast("string").alias("sku"), F.lit("b").alias("product1_brand"), F.lit("c").alias("product1_category"))
    out = compare.store_dimension_week_compare(fact.join(dim, fact["product"] == dim["sku"], "left"), dt.date(2020, 1, 14))
    text = out._jdf.queryExecution().optimizedPlan().toString()
    assert text.count("Join LeftOuter, (product") == 4                # rows and means, and the totals of them; not the list
