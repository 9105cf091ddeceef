"""Every registered query against its SQL, on the smallest tables."""

import decimal
from pathlib import Path

import pytest

import __spark_entry__ as entry

FOLDER = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
NAMES = sorted(n for n in entry.oracle_sql() if n in entry.library.QUERIES)

pytestmark = pytest.mark.skipif(not Path(FOLDER).exists(), reason="needs the driver's tables")


@pytest.fixture(scope="module")
def duck():
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.sql(f"CREATE VIEW {t} AS SELECT * FROM '{FOLDER}/{t}.parquet'")
    return con


def norm(v):
    if isinstance(v, int):
        return str(int(v))
    return f"{float(v):.9g}" if isinstance(v, float | decimal.Decimal) else str(v)


@pytest.mark.parametrize("name", NAMES)
def test_query(spark, duck, name):
    df = entry.queries()[name](spark, FOLDER)
    columns = sorted(df.columns)
    got = sorted(tuple(norm(r[c]) for c in columns) for r in df.collect())
    rel = duck.sql(entry.oracle_sql()[name])
    assert sorted(rel.columns) == columns
    at = [rel.columns.index(c) for c in columns]
    assert got == sorted(tuple(norm(r[i]) for i in at) for r in rel.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


def test_every_query_without_sql_gives_rows(spark):
    for name in sorted(set(entry.library.QUERIES) - set(entry.oracle_sql())):
        assert entry.queries()[name](spark, FOLDER).count() > 0, name
