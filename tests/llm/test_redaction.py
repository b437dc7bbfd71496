"""Redaction and the near-duplicate filter: columns with clashing names, many spans, bounds of broadcasts."""

import random
import time

import pytest
from pyspark.sql import functions as F

from salescope.llm import common, ngram_join, secret_scan
from salescope.session import scratch_path

KEY = "AKIA" + "ABCDEFGHIJKLMNOP2345"


def redacted(spark, df, **more):
    return secret_scan.redact_secrets(df, secret_scan.Ledger(spark, scratch_path(spark, "ledger"), create=True), **more)


def brute(text, spans, mark):
    out, at = "", 0
    for start, end in sorted(spans):
        if start >= at:
            out += text[at:start] + mark
        at = max(at, end)
    return out + text[at:]


def test_clashing_columns_stay(spark):
    rows = [(1, f"a {KEY} b", 7, "s", 3), (1, f"a {KEY} b", 8, "t", 4), (2, None, 9, None, 5), (3, "", 1, "u", 6)]
    df = spark.createDataFrame(rows, "doc_id long, text string, _blob int, _spans string, _parts int").withColumn("_hash", F.lit("mine")).withColumn("BLOB", F.lit("x"))
    out = redacted(spark, df)
    assert out.columns == df.columns
    got = sorted(map(tuple, out.collect()), key=str)
    assert got == sorted([(1, "a [secret] b", 7, "s", 3, "mine", "x"), (1, "a [secret] b", 8, "t", 4, "mine", "x"), (2, None, 9, None, 5, "mine", "x"), (3, "", 1, "u", 6, "mine", "x")], key=str)
    assert redacted(spark, df.limit(0)).count() == 0


def test_one_of_each_keeps_clashing_columns(spark):
    text = " ".join(f"w{i}" for i in range(40))
    df = spark.createDataFrame([(1, text, "first"), (1, text, "first"), (2, text, "second"), (3, "other words of another text", "third")], "doc_id long, text string, _hash string")
    df = df.withColumn("_id", F.lit(5)).withColumn("__hash", F.lit(6))
    out = ngram_join.one_of_each(df)
    assert out.columns == df.columns
    assert sorted(map(tuple, out.collect())) == [(1, text, "first", 5, 6), (3, "other words of another text", "third", 5, 6)]


@pytest.mark.parametrize("seed", range(3))
def test_redaction_against_brute_force(spark, seed):
    rng = random.Random(seed)
    bits = [KEY, "password=hunter22", "\ufeff", "é𝄞", " ", "token: 0123456789abcdef0123456789abcdef", "\n", "text", "eyJhbGciOiJIUzI1NiIsInR5.eyJzdWIiOiIxMjM0NTY3.abcdefghijklmnop"]
    rows = [(i, "".join(rng.choice(bits) for _ in range(rng.randint(0, 30)))) for i in range(60)]
    df = spark.createDataFrame(rows, "doc_id long, text string")
    ledger = secret_scan.Ledger(spark, scratch_path(spark, "ledger"), create=True)
    spans = {r["doc_id"]: [(s["start"], s["end"]) for s in r["spans"]] for r in secret_scan.secret_spans(df, ledger).collect()}
    assert sum(map(len, spans.values())) > 100
    got = {r["doc_id"]: r["text"] for r in redacted(spark, df, mark="[x]").collect()}
    assert got == {k: brute(t, spans[k], "[x]") for k, t in rows}


def test_many_spans_in_one_text(spark):
    n = 100_000
    df = spark.createDataFrame([(1, f"{KEY} é\n" * n)], "doc_id long, text string")
    ledger = secret_scan.Ledger(spark, scratch_path(spark, "ledger"), create=True)
    secret_scan.secret_spans(df, ledger).count()                              # scanned before: the time is that of the cuts
    begin = time.perf_counter()
    assert secret_scan.redact_secrets(df, ledger).first()["text"] == "[secret] é\n" * n
    assert time.perf_counter() - begin < 20


def test_broadcast_bound_counts_bytes(spark):
    narrow = spark.range(1000)
    wide = spark.range(1000).select(F.sequence(F.lit(0), F.lit(5000)).alias("a"))
    hinted = lambda df: "broadcast" in common.few(df)._jdf.queryExecution().logical().toString()
    assert hinted(narrow) and not hinted(wide) and not hinted(spark.range(common.BROADCAST_ROWS + 1)) and hinted(narrow.limit(0))
    assert common.free_name(spark.createDataFrame([(1, 2)], "_X int, __x int"), "_x") == "___x"
