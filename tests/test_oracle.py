"""Every registered query against its SQL twin in DuckDB (exact values)."""

import math
import re

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem".split()


def _norm(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v)
    return "∅" if v is None else str(v)


@pytest.fixture(scope="module")
def con():
    c = duckdb.connect()
    for t in TABLES:
        c.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{SF}/{t}.parquet')")
    return c


def _own(names):
    """Names without those of the optional training-data subpackage."""
    return {n for n in names if n != "pipeline" and not re.match(r"op\d+_", n)}


@pytest.mark.parametrize("name", sorted(_own(entry.oracle_sql())))
def test_query_matches_oracle(spark, con, name):
    sdf = entry.queries()[name](spark, SF)
    rel = con.sql(entry.oracle_sql()[name])
    assert sorted(sdf.columns) == sorted(rel.columns)
    idx = [rel.columns.index(c) for c in sdf.columns]
    s_rows = sorted(tuple(_norm(x) for x in r) for r in sdf.collect())
    o_rows = sorted(tuple(_norm(r[i]) for i in idx) for r in rel.fetchall())
    assert s_rows == o_rows


def test_every_query_has_oracle_or_is_rows_only():
    missing = _own(set(entry.queries()) - set(entry.oracle_sql()))
    assert missing == {"row_uuid"}


def test_entry_smoke(spark):
    df = entry.entry(spark)
    assert df.count() >= 0 and "platform" in df.columns
