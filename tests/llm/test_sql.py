"""The operators' SQL in DuckDB against their queries, and on odd rows."""

import duckdb
import pytest

from salescope.llm import oracle, quality_rules, queries

SF = "/root/testdata/sf0.001"


def rows(of):
    return sorted(tuple(repr(x) for x in r) for r in of)


@pytest.mark.parametrize("name", sorted(oracle.SQL))
def test_sql(spark, name):
    con = duckdb.connect()
    for t in ("documents", "pages", "benchmark"):
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    found = con.sql(oracle.SQL[name])
    df = queries.all_queries()[name](spark, SF)
    assert sorted(df.columns) == sorted(found.columns)
    assert rows(df.select(*found.columns).collect()) == rows(found.fetchall())


def test_sql_of_repeats(spark):
    run = " ".join(f"w{i}" for i in range(60))
    texts = [None, "", " \n ", "a", "a a", "a a a a a", "a b a b a b a b c", f"{run} x {run}", f"{run} {run} y {run}", "x # y\n\nx # y\n <|>",
             " ".join(f"v{i}" for i in range(130)) + " z " + " ".join(f"v{i}" for i in range(130)), "\u00a0\u00e9 \u4e2d\u6587 * " * 20]
    docs = list(enumerate(texts))
    con = duckdb.connect()
    con.execute("CREATE TABLE documents (doc_id BIGINT, text VARCHAR)")
    con.executemany("INSERT INTO documents VALUES (?, ?)", docs)
    found = con.sql(oracle.SQL["op7_quality_rules"])
    df = quality_rules.quality_report(spark.createDataFrame(docs, "doc_id long, text string"))
    assert rows(df.select(*found.columns).collect()) == rows(found.fetchall())
