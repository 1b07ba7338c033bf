"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry_point

SF = "/root/testdata/sf0.001"
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"create view {name} as select * from '{SF}/{name}.parquet'")
    return connection


def rows_of(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(str(r[i]) for i in order) for r in rows))


def test_entry(spark):
    assert {r.lang for r in entry_point.entry(spark).collect()} == {"de", "en", "es", "fr"}


def test_every_oracle_has_a_query():
    assert set(entry_point.oracle_sql()) <= set(entry_point.queries())


@pytest.mark.parametrize("name", sorted(entry_point.queries()))
def test_query(spark, duck, name):
    df = entry_point.queries()[name](spark, SF)
    rows = df.collect()
    assert rows
    if name in entry_point.oracle_sql():
        relation = duck.sql(entry_point.oracle_sql()[name])
        assert sorted(relation.columns) == sorted(df.columns)
        assert rows_of(df.columns, rows) == rows_of(relation.columns, relation.fetchall())
