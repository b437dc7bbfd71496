"""File and JDBC readers.

All reads use explicit schemas: no inference pass over the data. A directory
of per-store files is ONE scan (the file listing is distributed by Spark), so
stacking files is the read itself, not a driver loop over files.
"""

from __future__ import annotations

import re

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..schema import ORDER_COLS, RAW_ORDER_COLS, TARGET
from ..session import default_parallelism
from ..sinks.fan_out import NO_VALUE, escaped
from .order_files import read_named_orders


def _strings(cols: list[str]) -> T.StructType:
    return T.StructType([T.StructField(c, T.StringType()) for c in cols])


def read_order_files(spark: SparkSession, path: str, *, columns: list[str] = RAW_ORDER_COLS,
                     header: bool = True, header_names: list[str] | None = None, glob: str | None = None,
                     fmt: str = "csv", with_source: bool = False) -> DataFrame:
    """Every cell as text under fixed column names.

    ``header=True``: the first line of each file is a header (S1, S4, S12).
    ``header=False``: positional names (S3); a header line then arrives as a
    data row and is removed by a later numeric filter (P7).
    ``header_names`` are the files' own labels of ``columns``. A file whose
    header differs from them fails the read by name instead of putting values
    into other columns, and so does a damaged file.
    """
    names = (header_names or columns) if header else columns
    reader = (spark.read.format(fmt).schema(_strings(names)).option("header", header)
              .option("enforceSchema", not header).option("encoding", "UTF-8"))
    if glob:
        reader = reader.option("pathGlobFilter", glob)
    df = reader.load(path).toDF(*columns)
    return df.withColumn("source_file", F.input_file_name()) if with_source else df


def read_order_files_checked(spark: SparkSession, path: str, *,
                             columns: list[str] = RAW_ORDER_COLS,
                             header_names: list[str] | None = None,
                             glob: str | None = None) -> tuple[DataFrame, DataFrame]:
    """Bad-file tolerance (S2): (rows of good files with ``source_file``,
    rejected files with ``bad_lines`` and ``reason``). Columns are taken by
    the labels of each file's header (``order_files.read_named_orders``);
    ``header_names`` are the labels of ``columns``."""
    labels = dict(zip(columns, header_names)) if header_names else None
    found = read_named_orders(spark, path, columns=columns, labels=labels, glob=glob)
    return found.rows.select(*columns, "source_file"), found.rejected().select("source_file", "bad_lines", "reason")


def scan_splits(df: DataFrame) -> int | None:
    """Number of input splits of a plain scan (planning only, no job);
    None where the session does not expose it."""
    try:
        return df._jdf.rdd().getNumPartitions()
    except Exception:  # noqa: BLE001
        return None


def ensure_parallelism(df: DataFrame, min_partitions: int | None = None,
                       splits: int | None = None) -> DataFrame:
    """Spread an under-split input (few large row groups or files) over the
    cluster before expensive per-row work. ``splits`` is the input's split
    count (default: measured on ``df``, which should then be a plain scan).
    An input that already has enough splits -- the normal case for large
    data -- is returned unchanged, so no shuffle is added at scale."""
    want = min_partitions or default_parallelism(df.sparkSession)
    have = scan_splits(df) if splits is None else splits
    return df.repartition(want) if have is not None and have < want else df


def read_positional(spark: SparkSession, path: str, names: list[str] = ORDER_COLS) -> DataFrame:
    """Header-less read renamed by position."""
    return read_order_files(spark, path, columns=names, header=False)


def read_table(spark: SparkSession, path: str, fmt: str = "parquet",
               schema: T.StructType | None = None, header: bool = True, by: list[str] | None = None) -> DataFrame:
    """A stored table or report by path (S4-S6, S8). ``by`` names the columns
    of ``schema`` that are its directories' names, where there is one for every
    store: they are then taken from each file's own path, as the time of
    Spark's look for partitions grows with the square of their number."""
    reader = spark.read.format(fmt)
    if by:
        held = T.StructType([f for f in schema if f.name not in by])
        reader = reader.option("recursiveFileLookup", True).schema(held)
    elif schema is not None:
        reader = reader.schema(schema)
    if fmt == "csv":
        reader = reader.option("header", header)
    df = reader.load(path)
    return df.select(*[_of_path(f).alias(f.name) if f.name in by else F.col(f"`{f.name}`") for f in schema]) if by else df


def _decoded(text):
    return F.url_decode(F.replace(text, F.lit("+"), F.lit("%2B")))


def _of_path(field: T.StructField):
    """The value that a file's directory names for a column; the path is
    encoded once as a URI, the value once more as a name."""
    name = re.escape(escaped(field.name))
    value = F.regexp_extract(_decoded(F.col("_metadata.file_path")), f".*/{name}=([^/]*)/", 1)
    return F.when(value != NO_VALUE, _decoded(value)).cast(field.dataType)


def read_fact(spark: SparkSession, path: str, fmt: str = "parquet") -> DataFrame:
    """A fact landed by ``sinks.write_fact``; ``order_month`` is a DATE
    partition column, so period filters prune directories."""
    return spark.read.format(fmt).option("basePath", path).load(path)


def literal_table(spark: SparkSession, rows: list[tuple], schema: T.StructType) -> DataFrame:
    """A typed in-memory table for caller-supplied rows."""
    return spark.createDataFrame(rows, schema)


def read_target(spark: SparkSession, source: str | DataFrame, snapshot: int, *,
                jdbc_url: str | None = None, properties: dict | None = None,
                fmt: str = "parquet") -> DataFrame:
    """(key, target) of one snapshot from a target table.

    ``source`` is a DataFrame, a path, or -- with ``jdbc_url`` -- a table
    name. Columns are taken by position as (snapshot, key, target); the
    snapshot filter is pushed to the source (a JDBC WHERE clause, a Parquet
    row-group filter).
    """
    if isinstance(source, DataFrame):
        df = source
    elif jdbc_url:
        df = spark.read.jdbc(jdbc_url, source, properties=properties or {})
    else:
        df = spark.read.format(fmt).load(source)
    df = df.toDF(*TARGET.fieldNames())
    return (df.where(F.col("snapshot") == F.lit(snapshot))
              .select("key", F.col("target").cast("decimal(18,2)").alias("target")))
