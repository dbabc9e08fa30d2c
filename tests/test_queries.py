"""Every registered query against its SQL counterpart on the smallest tables."""

import duckdb
import pytest

import __spark_entry__ as contract
from checks.queries import ORACLE, QUERIES

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()
TYPES = {"string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "boolean": "BOOLEAN"}


@pytest.fixture(scope="module")
def database(sf_dir):
    connection = duckdb.connect()
    for name in TABLES:
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return connection


def test_every_query_has_a_counterpart():
    assert set(QUERIES) == set(ORACLE) <= set(contract.queries()) & set(contract.oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, database, name):
    df = contract.queries()[name](spark, sf_dir)
    relation = database.sql(contract.oracle_sql()[name])
    columns = sorted(df.columns)
    assert sorted(relation.columns) == columns
    types = dict(zip(relation.columns, map(str, relation.types)))
    assert {f.name: TYPES[f.dataType.simpleString()] for f in df.schema} == types
    got = sorted((tuple(r[c] for c in columns) for r in df.collect()), key=repr)
    order = [relation.columns.index(c) for c in columns]
    want = sorted((tuple(r[i] for i in order) for r in relation.fetchall()), key=repr)
    assert len(want) > 0
    assert got == want


def test_entry(spark):
    assert contract.entry(spark).count() > 0
