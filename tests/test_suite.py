"""Every query that has SQL against it on the smallest tables; those of the suite all have."""

import duckdb
import pytest

import __spark_entry__ as entry
import suite
from tools.compare import TABLES, TYPES, rows

QUERIES, SQL = entry.queries(), entry.oracle_sql()


@pytest.fixture(scope="module")
def con():
    connection = duckdb.connect()
    for t in TABLES:
        connection.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('/root/testdata/sf0.001/{t}.parquet')")
    return connection


def test_every_query_of_the_suite_has_sql():
    assert set(suite.SQL) == set(suite.QUERIES)
    assert set(suite.QUERIES) <= set(QUERIES)
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", SQL)
def test_query_equals_sql(spark, sf, con, name):
    df = QUERIES[name](spark, sf)
    result = con.execute(SQL[name])
    columns = {d[0]: str(d[1]) for d in result.description}
    assert {c: TYPES[t] for c, t in df.dtypes} == columns
    assert rows(df.columns, [tuple(r) for r in df.collect()]) == rows(list(columns), result.fetchall())


def test_entry(spark):
    assert entry.entry(spark).count() > 0
