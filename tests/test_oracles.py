"""Every registered query against its SQL on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as entry

SF = "/root/testdata/sf0.001"
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()
TYPES = {"string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE"}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{SF}/{name}.parquet'")
    return connection


def canonical(data, columns):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted([tuple(r[i] for i in order) for r in data], key=lambda t: tuple((v is not None, str(v)) for v in t))


@pytest.mark.parametrize("name", sorted(entry.oracle_sql()))
def test_query_equals_sql(spark, duck, name):
    df = entry.queries()[name](spark, SF)
    cursor = duck.execute(entry.oracle_sql()[name])
    types = {c[0]: str(c[1]) for c in cursor.description}
    expected = cursor.fetchall()
    assert sorted(df.columns) == sorted(types)
    assert {c: TYPES[t] for c, t in df.dtypes} == types
    got = canonical([tuple(r) for r in df.collect()], df.columns)
    assert expected and got == canonical(expected, list(types))


@pytest.mark.parametrize("name", sorted(set(entry.queries()) - set(entry.oracle_sql())))
def test_query_without_sql_gives_rows(spark, name):
    df = entry.queries()[name](spark, SF)
    assert df.columns and not df.isEmpty()


def test_entry(spark):
    assert entry.entry(spark).count() > 0
