"""Every query with SQL gives DuckDB's rows."""

import os

import duckdb
import pytest

import __spark_entry__ as entry

SF = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


@pytest.fixture(scope="module")
def duck():
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{SF}/{t}.parquet'")
    return con


def plain(v):
    return round(float(v), 9) if isinstance(v, float) else v


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    got = entry.queries()[name](spark, SF)
    done = duck.execute(entry.oracle_sql()[name])
    columns = [d[0] for d in done.description]
    assert sorted(got.columns) == sorted(columns)
    order = sorted(columns)
    want = sorted((tuple(plain(row[columns.index(c)]) for c in order) for row in done.fetchall()), key=str)
    have = sorted((tuple(plain(r[c]) for c in order) for r in got.collect()), key=str)
    assert have == want
