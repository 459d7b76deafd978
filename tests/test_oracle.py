"""Every registered query against its SQL on the same tables, and its plan."""

import datetime
import glob
import os

import duckdb
import pytest

import __spark_entry__ as contract

SF_DIR = os.environ.get("ORACLE_SF_DIR", "/root/testdata/sf0.001")
QUERIES = {k: v for k, v in contract.queries().items() if k not in contract.llm_part("QUERIES")}
ORACLES = {k: v for k, v in contract.oracle_sql().items() if k in QUERIES}


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for path in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    yield connection
    connection.close()


def plain(value):
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def rows_by_name(columns, rows):
    """Rows as tuples with the columns in name order, sorted."""
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(plain(row[i]) for i in order) for row in rows), key=repr)


TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, duck, name):
    result = QUERIES[name](spark, SF_DIR)
    expected = duck.execute(ORACLES[name])
    columns = [item[0] for item in expected.description]
    types = {item[0]: str(item[1]) for item in expected.description}

    assert sorted(result.columns) == sorted(columns)
    assert {column: TYPES[kind] for column, kind in result.dtypes} == types
    wanted = rows_by_name(columns, expected.fetchall())
    assert rows_by_name(result.columns, result.collect()) == wanted
    assert wanted, "the comparison says nothing about an empty result"

    plan = result._jdf.queryExecution().executedPlan().toString()
    for operator in ("EvalPython", "MapInPandas", "CartesianProduct", "NestedLoopJoin"):
        assert operator not in plan
