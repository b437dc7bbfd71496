"""Order files by name: layouts, titles, extra columns, and files that cannot be taken."""

import bz2
import gzip
import os

import pytest

from salescope.operators.quarantine import parse_amounts, quarantine
from salescope.sources.order_files import read_named_orders

COLS = ["a", "b", "c"]
LABELS = {"a": "甲", "b": "乙", "c": "丙"}


def read(spark, path, **more):
    got = read_named_orders(spark, str(path), columns=COLS, labels=LABELS, **more)
    rows = sorted((os.path.basename(r["source_file"]), r["a"], r["b"], r["c"]) for r in got.rows.na.fill("NULL").collect())
    files = {os.path.basename(r["source_file"]): (r["rows"], r["bad_lines"], r["reason"]) for r in got.files.collect()}
    return rows, files


def test_layouts(spark, tmp_path):
    (tmp_path / "plain.csv").write_text("甲,乙,丙\n1,2,3\n")
    (tmp_path / "bom.csv").write_text("\ufeff甲,乙,丙\r\n4,,\"\"\r\n", encoding="utf-8")
    (tmp_path / "title.csv").write_text("orders of the month, all\n丙, 乙 ,x,甲\n3,2,9,1\n\"three\nlines\",\"q\"\"q\",9,\"1,234.50\"\n")
    (tmp_path / "twice.csv").write_text("甲,乙,乙,丙\n1,first,second,3\n")
    (tmp_path / "none.csv").write_text("甲,乙,丙\n")
    with gzip.open(tmp_path / "z.csv.gz", "wt") as f:
        f.write("乙,甲,丙\n" + "b,a,c\n" * 3)
    (tmp_path / "z.csv.bz2").write_bytes(bz2.compress("甲,乙,丙\nx,y,z\n".encode()))
    rows, files = read(spark, tmp_path)
    assert rows == sorted([
        ("plain.csv", "1", "2", "3"), ("bom.csv", "4", "NULL", ""), ("title.csv", "1", "2", "3"), ("title.csv", "1,234.50", 'q"q', "three\nlines"),
        ("twice.csv", "1", "first", "3"), ("z.csv.bz2", "x", "y", "z"), *[("z.csv.gz", "a", "b", "c")] * 3])
    assert all(reason is None for _, _, reason in files.values()) and files["none.csv"][0] == 0 and files["title.csv"][0] == 2


def test_files_that_cannot_be_taken(spark, tmp_path):
    good = "甲,乙,丙\n" + "1,2,3\n" * 2
    (tmp_path / "good.csv").write_text(good)
    whole = gzip.compress("甲,乙,丙\n".encode() + b"\n".join(os.urandom(3).hex().encode() + b",2,3" for _ in range(200_000)))
    (tmp_path / "cut.csv.gz").write_bytes(whole[:len(whole) // 2])                     # the begin is readable
    (tmp_path / "notgzip.csv.gz").write_text(good)
    (tmp_path / "short.csv").write_text(good + "1,2\n" + "1,2,3\n" * 3 + "1,2,3,4\n")
    (tmp_path / "missing.csv").write_text("甲,丙,other\n1,2,3\n")
    (tmp_path / "third.csv").write_text("x\ny\n" + good)                             # the header is too far down
    (tmp_path / "latin.csv").write_bytes("甲,乙,丙\n".encode() + b"caf\xe9,2,3\n")
    (tmp_path / "empty.csv").write_text("\n")
    os.symlink(tmp_path / "nowhere", tmp_path / "gone.txt")                            # not in the glob
    rows, files = read(spark, tmp_path, glob="*.csv*")
    assert rows == [("good.csv", "1", "2", "3")] * 2
    assert files.pop("good.csv") == (2, 0, None)
    assert files["short.csv"] == (0, 2, "2 lines are not as wide as the header")
    assert files["missing.csv"][2] == "lacks 乙" and files["latin.csv"][2] == "no UTF-8"
    assert files["third.csv"][2].startswith("lacks") and files["empty.csv"][2] == "lacks 甲, 乙, 丙"
    assert files["cut.csv.gz"][2].startswith("cannot be read") and files["notgzip.csv.gz"][2].startswith("cannot be read")
    assert all(n == 0 for n, _, _ in files.values())
    assert read(spark, tmp_path, glob="third.csv", within=3)[0] == [("third.csv", "1", "2", "3")] * 2


def test_file_lost_after_listing(spark, tmp_path):
    for name in ("a.csv", "b.csv"):
        (tmp_path / name).write_text("甲,乙,丙\n1,2,3\n")
    got = read_named_orders(spark, str(tmp_path), columns=COLS, labels=LABELS)
    os.remove(tmp_path / "b.csv")
    assert got.rows.count() == 1
    assert [os.path.basename(r["source_file"]) for r in got.rejected().collect()] == ["b.csv"]


@pytest.mark.parametrize("text,value,reason", [
    ("1,234.50", "1234.50000000", None), (" 7 ", "7.00000000", None), ("-0.5", "-0.50000000", None), ("1e3", "1000.00000000", None), ("未更新", None, None), ("", None, None),
    (None, None, None), ("n/a", None, "not a number"), ("NaN", None, "not a number"), ("1.2.3", None, "not a number"), ("9e40", None, "out of range"), ("Infinity", None, "out of range")])
def test_amounts(spark, text, value, reason):
    df = spark.createDataFrame([("k", text)], "order_no string, profit string")
    got = parse_amounts(df, ["profit"]).first()["profit"]
    assert (None if got is None else str(got)) == value
    listed = [tuple(r) for r in quarantine(df, ["profit"], ["order_no"]).collect()]
    assert listed == ([("k", "profit", text, reason)] if reason else [])


def test_typed_amounts_pass(spark):
    df = spark.createDataFrame([("k", 1.5, None), ("l", None, 2)], "order_no string, profit double, revenue int")
    assert quarantine(df, ["profit", "revenue"], ["order_no"]).count() == 0
    assert [str(r["profit"]) for r in parse_amounts(df, ["profit", "revenue"]).collect()] == ["1.50000000", "None"]
