"""Every registered query against its SQL on the same tables."""

import duckdb
import pytest

import __spark_entry__ as entry_points
from barsieve.plans.oracle import all_sql
from barsieve.plans.queries import all_queries

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()
SPARK_TO_SQL = {
    "string": "VARCHAR",
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "date": "DATE",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def sql(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"create view {name} as select * from '{sf_dir}/{name}.parquet'")
    return connection


def test_every_query_has_sql():
    assert set(all_queries()) == set(all_sql())
    assert set(all_queries()) <= set(entry_points.queries())
    assert set(all_sql()) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(all_queries()))
def test_query_matches_sql(spark, sql, sf_dir, name):
    df = all_queries()[name](spark, sf_dir)
    cursor = sql.execute(all_sql()[name])
    names = [d[0] for d in cursor.description]
    types = {d[0]: str(d[1]) for d in cursor.description}
    order = sorted(df.columns)
    assert order == sorted(names)
    assert {f.name: SPARK_TO_SQL[f.dataType.simpleString()] for f in df.schema} == {
        n: t if t != '"NULL"' else "VARCHAR" for n, t in types.items()
    }
    got = sorted(repr([r[c] for c in order]) for r in df.collect())
    want = sorted(repr([r[names.index(c)] for c in order]) for r in cursor.fetchall())
    assert got == want


def test_entry(spark):
    df = entry_points.entry(spark)
    dates = [r["generated_date"] for r in df.collect()]
    assert dates and dates == sorted(dates)
