"""Every registered query against its SQL, on the smallest tables."""

import math

import duckdb
import pytest

import __spark_entry__ as checks

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()
QUERIES, ORACLES = checks.queries(), checks.oracle_sql()


@pytest.fixture(scope="module")
def sql(data):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{data}/{name}.parquet'")
    return connection


def as_set(columns, found):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    clean = lambda v: None if isinstance(v, float) and math.isnan(v) else v
    return sorted((tuple(clean(row[i]) for i in order) for row in found), key=repr)


def numbers(found):
    return [tuple(float(v) if isinstance(v, (int, float)) else v for v in row) for row in found]


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, data, sql, name):
    ours = QUERIES[name](spark, data)
    theirs = sql.execute(ORACLES[name])
    columns = [d[0] for d in theirs.description]
    assert sorted(ours.columns) == sorted(columns)
    expected = sorted(numbers(as_set(columns, theirs.fetchall())), key=repr)
    assert sorted(numbers(as_set(ours.columns, [tuple(r) for r in ours.collect()])), key=repr) == expected
    assert expected


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLES)))
def test_queries_without_sql_give_rows(spark, data, name):
    assert QUERIES[name](spark, data).count() > 0


def test_every_statement_belongs_to_a_query():
    assert set(ORACLES) <= set(QUERIES)


def test_entry(spark):
    assert checks.entry(spark).count() > 0
