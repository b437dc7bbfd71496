"""The daily and attainment runs on files written from the provided tables."""

import os
import tempfile

from pyspark.sql import functions as F

from salescope.cli import run_attainment, run_daily
from salescope.plans import catalog as cat
from salescope.plans import compare as cmp
from salescope.sinks.files import write_csv, write_report
from salescope.sources import testbed as tb
from salescope.sources.files import read_table

SF = "/root/testdata/sf0.001"


def test_daily_and_attainment_runs(spark):
    base = tempfile.mkdtemp(prefix="salescope-cli-")
    orders, stores, goods, out = (os.path.join(base, x) for x in ("orders", "stores", "goods", "out"))
    write_csv(cat.raw(spark, SF), orders)
    write_report(tb.store_dim(spark, SF), stores)
    write_report(tb.goods_dim(spark, SF), goods)
    written = run_daily(spark, orders, stores, goods, tb.AS_OF, out)
    assert read_table(spark, written["rejected_files"]).count() == 0
    got = read_table(spark, written["store_compare"])
    want = cmp.store_week_compare(cat.cleaned(spark, SF), tb.AS_OF)
    key = ["store", "growth", "growth_rate", "is_total"]
    assert sorted(map(tuple, got.select(*key).collect())) == sorted(map(tuple, want.select(*key).collect()))
    assert read_table(spark, written["store_movers_top"]).count() == 5
    assert "store=" in " ".join(os.listdir(written["store_dimension_compare"]))

    targets = os.path.join(base, "targets")
    write_report(tb.targets(spark, SF, "platform"), targets)
    res = run_attainment(spark, written["fact"], targets, "platform", 20201105, os.path.join(base, "att"))
    att = read_table(spark, res["attainment"])
    assert att.where(F.col("is_total")).count() == 1 and att.count() == 5
