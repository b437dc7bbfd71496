"""Writers (K1-K14).

Workbooks become directories: one table per sheet, one subdirectory per
report, ``partitionBy`` for the per-store fan-out. Output order is produced
by sorting within the written partitions, never by a global sort.
"""

from __future__ import annotations

from collections.abc import Callable

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..session import default_parallelism, remove_scratch, scratch_paths, staged
from . import fan_out


def write_report(df: DataFrame, path: str, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """One report or fact to one directory (K6, K7, K10-K12); ``mode='append'``
    adds to an existing report (K6)."""
    writer = df.write.mode(mode).format(fmt)
    if fmt == "csv":
        writer = writer.option("header", True).option("encoding", "UTF-8")
    writer.save(path)


def write_csv(df: DataFrame, path: str, mode: str = "overwrite",
              sort_within: list[Column | str] | None = None, order_by: list[Column | str] | None = None, compression: str = "none",
              spell: Callable[[DataFrame], DataFrame] | None = None) -> None:
    """CSV with a header line, UTF-8 (K1), ``compression`` as Spark names it
    (``gzip``: files end in ``.csv.gz``). ``sort_within`` orders rows inside
    each output file; ``order_by`` (O3) orders them over all files, which then
    follow each other by name: a sort by range, not one task. ``spell`` makes
    the written columns of narrower rows that are in order: only those are
    moved and sorted. It must keep rows where they are, so it joins nothing."""
    out = df.sortWithinPartitions(*sort_within) if sort_within else df
    if order_by:
        out = df.repartitionByRange(*order_by).sortWithinPartitions(*order_by)
    if spell:
        out = spell(out)
    out.write.mode(mode).option("header", True).option("encoding", "UTF-8").option("compression", compression).csv(path)


#: rows of a directory that go to one file, and directories with more of them that are held on the driver
FILE_ROWS = 1_000_000
MOST_LARGE = 100_000


def write_partitioned(df: DataFrame, path: str, by: list[str], *, fmt: str = "parquet",
                      mode: str = "overwrite", sort_within: list[Column | str] | None = None, file_rows: int = FILE_ROWS) -> None:
    """Fan-out (K8): one directory per value of ``by`` (e.g. per store and
    dimension), written by one job. A histogram of rows per directory, which
    reads the columns of ``by`` alone, decides its number of files: a directory
    with more than ``file_rows`` rows is dealt to as many tasks and files as it
    needs, others are one file. Order holds within each file. The rows are
    staged first: the histogram and the write read them, neither computes them.
    There are as many tasks as shuffle partitions, however few the bytes: a
    fan-out's cost is its files. Parquet that replaces what is there is written
    by ``sinks.fan_out``, all else by Spark's own writer. Many directories are
    read back by ``sources.files.read_table`` with ``by``."""
    spark = df.sparkSession
    df = staged(df, "fan-out")
    kept = scratch_paths(spark)[-1:]
    counts = df.groupBy(*by).agg(F.ceil(F.count(F.lit(1)) / file_rows).cast("int").alias("__files")).where("__files > 1")
    large = counts.limit(MOST_LARGE + 1).collect()                  # rows / file_rows of them at most
    held = F.broadcast(spark.createDataFrame(large, counts.schema)) if len(large) <= MOST_LARGE else counts
    rest = [c for c in df.columns if c not in by]
    out = df.withColumn("__file", F.lit(0))
    if large:
        # null keys match their own counts
        held = held.select(F.struct(*by).alias("__by"), "__files")
        out = df.join(held, F.struct(*[df[c] for c in by]).eqNullSafe(held["__by"]), "left").withColumn(
            "__file", F.pmod(F.xxhash64(*rest), F.coalesce("__files", F.lit(1)))).drop("__by", "__files")
    tasks = max(default_parallelism(spark), int(spark.conf.get("spark.sql.shuffle.partitions")))
    out = out.repartition(tasks, *by, "__file").drop("__file")
    if fmt == "parquet" and mode in fan_out.MODES and fan_out.takes(df, path, by):
        fan_out.write(out, path, by, mode, sort_within or [])
    else:
        out.sortWithinPartitions(*by, *(sort_within or [])).write.mode(mode).format(fmt).partitionBy(*by).save(path)
    remove_scratch(spark, kept)


#: Spark's bound on the files that a task writes side by side; 0: one, after a sort by directory
_WRITERS = "spark.sql.maxConcurrentOutputFileWriters"


def write_dealt(df: DataFrame, path: str, by: list[str], *, fmt: str = "parquet", compression: str | None = None, writers: int = 4) -> None:
    """One directory per value of ``by`` of rows that are already dealt by it:
    a task that holds at most ``writers`` values appends its rows to their
    files in the order in which they come, without the sort that Spark puts
    before such a write. A task with more values sorts the rest, as without."""
    conf = df.sparkSession.conf
    kept = conf.get(_WRITERS, None)
    writer = df.write.format(fmt).partitionBy(*by)
    if compression:
        writer = writer.option("compression", compression)
    conf.set(_WRITERS, str(writers))
    try:
        writer.save(path)
    finally:
        if kept is None:
            conf.unset(_WRITERS)
        else:
            conf.set(_WRITERS, kept)


#: one of so many orders is looked at for the spread of the days; rows of a landed fact that go to one task, about
DAYS_OF = 16
FACT_TASK_ROWS = 250_000


def deal_by_day(df: DataFrame, keys: DataFrame, date: Column, order: Column) -> DataFrame:
    """``df`` dealt to tasks in order of its days, by the rows that each day has
    in one of ``DAYS_OF`` orders of ``keys`` (order_date, order_no): a task takes
    some days that follow each other, and a day with more rows than a task's is
    spread over several by the order number. Days that were not seen, and rows
    without one, go to tasks by a hash. Only the layout depends on what was seen."""
    spark = df.sparkSession
    seen = keys.where(F.pmod(F.xxhash64("order_no"), F.lit(DAYS_OF)) == 0).groupBy(F.col("order_date").alias("day")).count()
    days = sorted(tuple(r) for r in seen.where("day is not null").limit(MOST_LARGE + 1).collect())
    if not days or len(days) > MOST_LARGE:
        return df.repartitionByRange(date, order)
    rows = sum(n for _, n in days)
    tasks = max(default_parallelism(spark), -(-rows * DAYS_OF // FACT_TASK_ROWS))
    places, before = [], 0
    for day, n in days:
        at, last = before * tasks // rows, (before + n - 1) * tasks // rows
        places.append((day, at, last - at + 1))
        before += n
    # of Arrow columns, which the plan holds: no Python worker makes them
    held = F.broadcast(spark.createDataFrame(pa.table(dict(zip(("__day", "__at", "__of"), map(list, zip(*places)))))))
    place = F.xxhash64(order)
    to = F.coalesce(F.col("__at") + F.pmod(place, F.col("__of")), F.pmod(F.when(date.isNull(), place).otherwise(F.xxhash64(date)), F.lit(tasks))).cast("int")
    out = df.join(held, date == held["__day"], "left").withColumn("__to", to).drop("__day", "__at", "__of")
    return out.repartitionById(tasks, "__to").drop("__to")


def write_fact(df: DataFrame, path: str, *, date_col: str = "order_date", mode: str = "overwrite",
               fmt: str = "parquet", keys: DataFrame | None = None, dealt: bool = False, compression: str | None = None) -> None:
    """Land a (cleaned) order fact partitioned by order month, rows sorted by
    date inside each file: period reports then prune to the month
    directories they need and skip row groups by their date statistics.

    Rows are dealt by date and order number, not hashed by month: a month -- or
    a single day -- holding a third of all rows is spread over many tasks
    instead of landing in one. ``keys`` has the date and order number of the
    rows of ``df`` where those are cheaper to get than from ``df``, whose rows
    are then computed once: Spark's own sort by range computes them twice, as
    it looks for its bounds in all of them. ``dealt`` rows came through
    ``deal_by_day`` before, when they were narrower. ``compression`` is the
    format's own if none is named."""
    out = df
    if not dealt:
        keys = (df if keys is None else keys).select(F.col(date_col).alias("order_date"), "order_no")
        out = deal_by_day(df, keys, F.col(date_col), F.col("order_no"))
    out = out.withColumn("order_month", F.trunc(F.col(date_col), "month"))
    writer = out.sortWithinPartitions("order_month", date_col).write.mode(mode).format(fmt).partitionBy("order_month")
    (writer.option("compression", compression) if compression else writer).save(path)


def write_tables(frames: dict[str, DataFrame], base: str, fmt: str = "parquet",
                 mode: str = "overwrite") -> None:
    """Several named tables side by side under one directory."""
    for name, df in frames.items():
        write_report(df, f"{base.rstrip('/')}/{name}", fmt=fmt, mode=mode)


def write_jdbc(df: DataFrame, url: str, table: str, mode: str = "append",
               properties: dict | None = None) -> None:
    """JDBC write (K2-K5): ``overwrite`` replaces the table, ``append`` adds
    (target seeding). Connection options come from the caller."""
    df.write.mode(mode).jdbc(url, table, properties=properties or {})


def land_snapshots(latest: DataFrame, merged: DataFrame, url: str, table: str,
                   land: str = "latest", properties: dict | None = None) -> None:
    """Q18: which collected fact replaces the database table, the newest
    snapshot (the reference's actual behaviour) or the merged one."""
    if land not in ("latest", "merged"):
        raise ValueError(f"land must be 'latest' or 'merged', not {land!r}")
    write_jdbc(latest if land == "latest" else merged, url, table, "overwrite", properties)


def preview(df: DataFrame, n: int = 20) -> None:
    """Console preview."""
    df.show(n, truncate=False)


def write_noop(df: DataFrame) -> None:
    """Run the whole plan without storing it (benchmarks)."""
    df.write.format("noop").mode("overwrite").save()


#: ranges of a column in a clustered table, and values that their bounds are taken from
CLUSTER_BITS = 6
_SAMPLE = 10_000


def _ranges(df: DataFrame, name: str) -> Column:
    """The range of a column's value, 0 to 2**CLUSTER_BITS - 1, nulls in 0. The
    bounds are quantiles of at most ``_SAMPLE`` distinct values, those with the
    least hashes, whatever the input; only the layout depends on them."""
    c = F.col(name)
    values = sorted(r[0] for r in df.select(name).where(c.isNotNull()).distinct().orderBy(F.xxhash64(name), name).limit(_SAMPLE).collect())
    n = 1 << CLUSTER_BITS
    bounds = sorted({values[len(values) * i // n] for i in range(1, n)}) if values else []
    if not bounds:
        return F.lit(0)
    return F.coalesce(F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b <= c)), F.lit(0))


def z_order(df: DataFrame, by: list[str]) -> Column:
    """Place on a space-filling curve over the columns' ranges: their bits in
    turn, so rows near in all columns are near on the curve."""
    ranges = [_ranges(df, c) for c in by]
    bits = [F.shiftleft(F.shiftright(r, i).bitwiseAND(1).cast("bigint"), i * len(by) + k) for i in range(CLUSTER_BITS) for k, r in enumerate(ranges)]
    return sum(bits[1:], bits[0])


def write_clustered(df: DataFrame, path: str, by: list[str], *, fmt: str = "parquet", mode: str = "overwrite") -> None:
    """Lands a table in z-order over ``by`` (K10, e.g. order date and store):
    rows near in every one of the columns share files and row groups, so a
    period slice and a single store's report both skip most of them by their
    statistics. One sort by range; a value that holds a third of all rows is
    spread by the other columns. The rows are staged first, as the ranges of each
    column and the sort's own bounds each take a look at them."""
    spark = df.sparkSession
    df = staged(df, "clustered")
    kept = scratch_paths(spark)[-1:]
    z = df.withColumn("__z", z_order(df, by))
    out = z.repartitionByRange("__z", *by).sortWithinPartitions("__z", *by).drop("__z")
    out.write.mode(mode).format(fmt).save(path)
    remove_scratch(spark, kept)
