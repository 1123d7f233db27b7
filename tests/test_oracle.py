"""Every query that SQL can express must equal DuckDB on the same files, value for value."""

import math
import os

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")
TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

DUCK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(
            f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{SF_DIR}/{name}.parquet')"
        )
    return connection


def comparable(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])

    def cell(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return "-"
        return repr(v)

    return sorted(tuple(cell(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_matches_sql(spark, duck, name):
    ours = contract.queries()[name](spark, SF_DIR)
    result = duck.execute(contract.oracle_sql()[name])
    names = [d[0] for d in result.description]
    types = {d[0]: str(d[1]) for d in result.description}
    assert {c: DUCK_TYPES.get(t, t) for c, t in ours.dtypes} == types
    expected = comparable(names, result.fetchall())
    actual = comparable(ours.columns, [tuple(r) for r in ours.collect()])
    assert len(actual) == len(expected)
    assert actual == expected


def test_every_oracle_has_a_query():
    assert set(contract.oracle_sql()) <= set(contract.queries())


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert len(rows) == 20
    variances = [r["variance"] for r in rows]
    assert variances == sorted(variances, reverse=True)
