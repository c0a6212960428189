"""Each registered query against its SQL twin on the smallest test tables."""

from pathlib import Path

import duckdb
import pytest

import __spark_entry__ as contract_entry
from layerkit.plans.queries import ORACLES, QUERIES

FOLDER = Path("/root/testdata/sf0.001")
TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

pytestmark = pytest.mark.skipif(not FOLDER.exists(), reason="test tables are absent")


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"CREATE VIEW {table} AS SELECT * FROM '{FOLDER}/{table}.parquet'")
    return connection


def comparable(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def text(value):
        return "NULL" if value is None else value.isoformat().replace("T00:00:00", "") if hasattr(value, "isoformat") else str(value)

    return sorted(tuple(text(row[i]) for i in order) for row in rows)


def test_every_query_has_an_oracle():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(contract_entry.queries())
    assert set(contract_entry.oracle_sql()) <= set(contract_entry.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_oracle(spark, duck, name):
    df = QUERIES[name](spark, str(FOLDER))
    cursor = duck.execute(ORACLES[name])
    columns = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(columns)
    assert comparable(df.columns, df.collect()) == comparable(columns, cursor.fetchall())


def test_entry(spark):
    assert contract_entry.entry(spark).count() > 0
