"""What the order queries cost on larger tables: rows without a key, second computations, columns and bytes moved."""

import csv
import datetime as dt
import decimal
import glob
import gzip
import os
import re

import pytest
from pyspark.sql import functions as F

from salescope.functions.numeric import money
from salescope.operators import cleaning, dims, fills
from salescope.plans import catalog
from salescope.plans import feature_queries as fq
from salescope.plans import operator_queries as op
from salescope.schema import ORDER_COLS
from salescope.sinks import files
from salescope.sinks.files import write_clustered, write_csv, write_dealt, write_fact, write_partitioned
from salescope.sources import testbed as tb
from salescope.sources.order_files import _BLOCK, read_file, read_named_orders

SF = "/root/testdata/sf0.001"


def counted(df, n):
    """``df`` whose computed rows are added to ``n``."""
    def run(batches):
        for batch in batches:
            n.add(batch.num_rows)
            yield batch
    return df.mapInArrow(run, df.schema)


@pytest.fixture
def no_broadcast(spark, monkeypatch):
    monkeypatch.setattr(dims, "DIM_BROADCAST_MAX_ROWS", 0)
    kept = {k: spark.conf.get(k) for k in ("spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.coalescePartitions.enabled")}
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    yield
    for k, v in kept.items():
        spark.conf.set(k, v)


@pytest.mark.parametrize("by", [(), ("order_no",)])
def test_rows_without_a_key_are_spread(spark, no_broadcast, by):
    fact = spark.range(4000).select(F.col("id").cast("string").alias("order_no"), F.when(F.col("id") % 4 == 0, F.concat(F.lit("S"), (F.col("id") % 40).cast("string"))).alias("product2"))
    odd = spark.createDataFrame([("x", "-1"), ("y", "=S0"), ("z", "")], fact.schema)
    goods = spark.createDataFrame([(i, s, "b", "c", "m") for i, s in enumerate(["S0", "S0", "S4", None, "-1", ""])], "id long, sku string, brand string, category string, manager string")
    out = dims.attach_goods(fact.unionByName(odd), goods, "product2", "product2", spread_by=by).cache()
    assert out.columns == ["order_no", "product2", "product2_id", "product2_brand", "product2_category", "product2_manager"]
    found = out.groupBy("product2").agg(F.count("*").alias("n"), F.count("product2_id").alias("with")).collect()
    assert {r["product2"]: (r["n"], r["with"]) for r in found} == {
        None: (3000, 0), "S0": (200, 200), "S4": (100, 100), **{f"S{i}": (100, 0) for i in range(8, 40, 4)}, "-1": (1, 1), "=S0": (1, 0), "": (1, 1)}
    most = out.where("product2 is null").groupBy(F.spark_partition_id()).count().agg(F.max("count")).first()[0]
    out.unpersist()
    assert most < 1500


def test_typed_money_is_not_parsed(spark):
    text = ("unit_price", "settle_total", "freight_first")
    df = spark.createDataFrame([(1,), (None,)], "i int").select(
        *[(F.col("i").cast("string") if c in text else money("i")).alias(c) for c in cleaning.MONEY], F.lit(1).alias("quantity"), F.lit(0.1).alias("commission_rate"))
    out = cleaning.convert_money_text(df)
    assert dict(out.dtypes)["profit"] == "decimal(18,2)" and dict(out.dtypes)["settle_total"] == "decimal(38,18)"
    done = fills.round_money(out, cleaning.MONEY)
    assert {dict(done.dtypes)[c] for c in cleaning.MONEY} == {"decimal(18,2)"}
    assert [[str(x) for x in r] for r in done.select(*cleaning.MONEY).collect()] == [["1.00"] * len(cleaning.MONEY), ["0.00"] * len(cleaning.MONEY)]


def test_wider_decimals_are_rounded_half_even(spark):
    df = spark.createDataFrame([(decimal.Decimal("0.125"),), (decimal.Decimal("0.135"),), (None,)], "x decimal(18,3)")
    assert [str(r[0]) for r in fills.round_money(df, ["x"]).collect()] == ["0.12", "0.14", "0.00"]


@pytest.mark.parametrize("kind", ["clustered", "partitioned"])
def test_landing_computes_its_rows_once(spark, tmp_path, kind):
    n = spark.sparkContext.accumulator(0)
    df = spark.range(2000).select(F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 90).cast("int")).alias("order_date"),
                                  (F.col("id") % 7).cast("string").alias("store"), F.col("id").cast("string").alias("order_no")).repartition(3)
    path = str(tmp_path / "t")
    if kind == "clustered":
        write_clustered(counted(df, n), path, ["order_date", "store"])
    else:
        write_partitioned(counted(df, n), path, ["store"], file_rows=100)
    back = spark.read.parquet(path)
    assert sorted(r[0] for r in back.select("order_no").collect()) == sorted(str(i) for i in range(2000))
    assert n.value == 2000


@pytest.mark.parametrize("query,made", [("export_tables", "cleaned_by_store"), ("report_order", "collected")])
def test_reports_compute_their_fact_once(spark, monkeypatch, query, made):
    n = spark.sparkContext.accumulator(0)
    old = getattr(fq, made)
    rows = old(spark, SF).count()
    monkeypatch.setattr(fq, made, lambda s, d: counted(old(s, d), n))
    fq.FEATURES[query](spark, SF).collect()
    assert n.value == rows


def test_order_lines_are_shuffled_twice(spark, no_broadcast):
    text = tb.raw_orders(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert len(re.findall(r"Exchange hashpartitioning\(l_", text)) <= 3 and "hashpartitioning(o_custkey" in text
    line = next(x for x in text.splitlines() if "hashpartitioning(o_custkey" in x)
    below = text[text.index(line):].splitlines()[1:6]
    assert not any("l_" in x for x in below)                     # orders without their lines


def test_csv_compressed_and_read_back(spark, tmp_path):
    df = spark.createDataFrame([("1", 'a "q"'), ("2", None)], "a string, b string")
    write_csv(df, str(tmp_path / "c"), compression="gzip")
    assert {f.split(".", 1)[1][-6:] for f in os.listdir(tmp_path / "c") if f.startswith("part")} == {"csv.gz"}
    assert sorted(read_named_orders(spark, str(tmp_path / "c"), columns=["a", "b"], glob="*.csv.gz").rows.select("a").collect()) == [("1",), ("2",)]


def test_ordered_csv_in_one_file(spark):
    assert fq.q_ordered_csv(spark, SF).select("steps_back", "overlaps").first() == (0, 0)


def test_order_files_are_parsed_in_small_blocks_and_long_lines_whole(spark, tmp_path):
    path = tmp_path / "plain.csv"
    path.write_text("a,b\n" + "0123456789,0123456789\n" * 500_000)
    most = max(b.nbytes for b in read_file(str(path), ["a", "b"], True))
    assert most < 2 * _BLOCK < 6 << 20
    (tmp_path / "long.csv").write_text("a,b\n1,2\n" + "3," + "x" * (5 << 20) + "\n4,5\n")
    found = read_named_orders(spark, str(tmp_path), columns=["a", "b"], glob="long.csv")
    assert [tuple(r) for r in found.files.select("rows", "reason").collect()] == [(3, None)]
    assert sorted(tuple(r) for r in found.rows.select("a", F.length("b")).collect()) == [("1", 1), ("3", 5 << 20), ("4", 1)]


def test_words_beyond_the_frequent_ones_keep_their_counts(spark, monkeypatch):
    lm_score = pytest.importorskip("salescope.llm.lm_score")
    docs = spark.createDataFrame([(i, " ".join(f"w{j}" for j in range(i % 13)) + " common") for i in range(60)], "doc_id long, text string")

    def base():
        return [(r["doc_id"], r["n_known"], r["train_tokens"], round(r["base_score"], 9)) for r in lm_score.score_documents(docs).orderBy("doc_id").collect()]

    want = base()
    monkeypatch.setattr(lm_score, "FREQUENT", 3)
    assert base() == want


def test_layouts_are_dealt_once_and_not_sorted(spark, tmp_path, monkeypatch):
    """One shuffle of narrow rows and no sort of the lines for each half of the files; the setting of the write does not stay."""
    plans = []
    old = fq.write_dealt

    def kept(df, *args, **more):
        plans.append(df._jdf.queryExecution().executedPlan().toString())
        old(df, *args, **more)

    monkeypatch.setattr(fq, "write_dealt", kept)
    fq.write_layouts(spark, SF, str(tmp_path))
    assert len(plans) == 2
    for text in plans:
        dealt = text[:text.index("REPARTITION_BY_NUM")]
        assert "Sort" not in dealt and "Union" not in text
        assert "to_csv" in dealt and "to_csv" not in text[len(dealt):]
    assert spark.conf.get("spark.sql.maxConcurrentOutputFileWriters") == "0"
    lines = [open(f, encoding="utf-8").read().splitlines() for f in sorted(str(x) for x in tmp_path.glob("plain/file_no=*/part-*"))]
    assert lines and all(sum("订单号" in x for x in f) == 1 and any("订单号" in x for x in f[:2]) for f in lines)


def test_rows_of_a_directory_are_written_in_their_order(spark, tmp_path):
    rows = spark.range(0, 40_000, 1, 1).select((F.col("id") % 3).alias("k"), F.col("id").cast("string").alias("line"))
    write_dealt(rows, str(tmp_path / "t"), ["k"], fmt="text", compression="none", writers=3)
    for k in range(3):
        (f,) = (tmp_path / "t" / f"k={k}").glob("part-*")
        assert f.read_text().split() == [str(i) for i in range(k, 40_000, 3)]


def test_landed_fact_is_computed_once_and_a_large_day_is_spread(spark, tmp_path, monkeypatch):
    n = spark.sparkContext.accumulator(0)
    day = F.when(F.col("id") % 3 == 0, F.lit(dt.date(2020, 5, 5))).when(F.col("id") % 1000 == 1, F.lit(None).cast("date")).otherwise(F.date_add(F.lit(dt.date(2020, 1, 1)), (F.col("id") % 300).cast("int")))
    df = spark.range(30_000).select(day.alias("order_date"), F.col("id").cast("string").alias("order_no"))
    write_fact(counted(df, n), str(tmp_path / "t"), keys=df)
    assert n.value == 30_000
    back = spark.read.parquet(str(tmp_path / "t"))
    assert sorted(r[0] for r in back.select("order_no").collect()) == sorted(str(i) for i in range(30_000))
    assert back.where("order_month is null").count() == back.where("order_date is null").count() == 20
    files = back.withColumn("f", F.input_file_name()).groupBy("f").agg(F.sum((F.col("order_date") == dt.date(2020, 5, 5)).cast("int")).alias("n"))
    large = [r["n"] for r in files.collect() if r["n"]]
    assert sum(large) == 10_000 + df.where("order_date = date'2020-05-05' and cast(order_no as int) % 3 <> 0").count() and max(large) < 7_000


def test_ordered_csv_moves_narrow_rows_and_holds_the_collected_fact(spark, monkeypatch):
    """Rows are put in order before they are spelled out; what is written is the collected fact, in order over all files."""
    made = []
    old = fq.write_csv
    monkeypatch.setattr(fq, "write_csv", lambda df, path, **more: (made.append((df, path, more)), old(df, path, **more)))
    fq.q_ordered_csv(spark, SF).collect()
    ((df, path, more),) = made
    moved = df.repartitionByRange(*more["order_by"])._jdf.queryExecution().optimizedPlan().output().size()
    assert moved <= 20 < len(ORDER_COLS)
    text = more["spell"](df.repartitionByRange(*more["order_by"]).sortWithinPartitions(*more["order_by"]))._jdf.queryExecution().executedPlan().toString()
    assert "Join" not in text[:text.index("rangepartitioning")] and "Sort [" in text[:text.index("rangepartitioning")]
    back = spark.read.option("header", True).csv(path)
    want = fq.collected(spark, SF).select(*[F.col(c).cast("string") for c in ORDER_COLS])
    assert sorted(map(repr, back.collect())) == sorted(map(repr, want.collect()))
    rows = []
    for f in sorted(glob.glob(path.removeprefix("file:") + "/*.csv.gz")):
        with gzip.open(f, "rt", encoding="utf-8") as lines:
            rows += [(r["order_date"], r["order_no"]) for r in csv.DictReader(lines)]
    assert rows == sorted(rows) and len(rows) == back.count()


def test_lines_keep_their_rows_where_names_cannot_be_broadcast(spark, no_broadcast):
    few = sorted(map(repr, tb.raw_orders(spark, SF).collect()))
    text = tb.order_lines(spark, SF)._jdf.queryExecution().executedPlan().toString()
    assert "hashpartitioning(l_suppkey" in text
    dims.DIM_BROADCAST_MAX_ROWS = 500_000                            # put back by the fixture
    tb._SCANS.clear()
    assert sorted(map(repr, tb.raw_orders(spark, SF).collect())) == few


@pytest.mark.parametrize("held", [True, False])
def test_the_landed_fact_meets_goods_and_days_as_narrow_rows(spark, request, tmp_path, monkeypatch, held):
    """The fact is the same as from whole rows, its columns are made after the last shuffle."""
    if not held:
        request.getfixturevalue("no_broadcast")
    made = []
    monkeypatch.setattr(files, "write_fact", lambda df, path, **more: (made.append((df, path)), write_fact(df, path, **more)))
    op.q_landed_store_week_compare(spark, SF)
    ((df, path),) = made
    want = catalog.cleaned(spark, SF)
    assert df.dtypes == want.dtypes
    assert sorted(map(repr, df.collect())) == sorted(map(repr, want.collect()))
    back = spark.read.parquet(path).drop("order_month").select(want.columns)
    assert sorted(map(repr, back.collect())) == sorted(map(repr, want.collect()))
    text = df.select("*")._jdf.queryExecution().executedPlan().toString()       # a plan that has not run
    moved = text[text.index("REPARTITION_BY_NUM"):]
    assert "settle_total" not in moved and "more fields" not in moved and "settle_total" in text


@pytest.mark.parametrize("most", [1000, 4, 0])
def test_texts_of_a_dimension_come_back_from_their_number(spark, monkeypatch, most):
    monkeypatch.setattr(dims, "MOST_VALUES", most)
    rows = [(i, f"S{i}", None if i % 5 == 0 else f"b{i % 4}", "" if i % 7 == 0 else f"c{i % 6}", None) for i in range(60)]
    goods = spark.createDataFrame([*rows, rows[3], (99, None, "x", "y", "z")], "id long, sku string, brand string, category string, manager string")
    n = dims.Numbered(goods, dims.GOODS_COLS[1:])
    assert n.plain == {1000: (), 4: ("brand", "category"), 0: dims.GOODS_COLS[1:]}[most]
    back = n.rows.select("id", "sku", *[n.value(c, F.col("look")).alias(c) if c in n.values else c for c in dims.GOODS_COLS[1:]])
    assert back.dtypes == goods.dtypes and sorted(map(repr, back.collect())) == sorted(map(repr, goods.collect()))
    if n.values:
        empty = spark.createDataFrame([(None,)], "look long")
        assert [tuple(r) for r in empty.select(*[n.value(c, F.col("look")) for c in n.values]).collect()] == [(None,) * len(n.values)]
