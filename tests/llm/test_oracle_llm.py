"""Queries that SQL can express, on whole small tables."""

import duckdb
import pytest

from visitlake.llm import queries

SF_DIR = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_query_equals_sql(spark, name):
    duck = duckdb.connect()
    for table in ("documents", "pages", "embeddings"):
        duck.execute(f"CREATE VIEW {table} AS SELECT * FROM '{SF_DIR}/{table}.parquet'")
    expected = duck.execute(queries.ORACLE_SQL[name])
    columns = sorted(item[0] for item in expected.description)
    places = [[item[0] for item in expected.description].index(c) for c in columns]
    wanted = sorted((tuple(row[i] for i in places) for row in expected.fetchall()), key=repr)
    result = queries.QUERIES[name](spark, SF_DIR).select(*columns)
    assert sorted(map(tuple, result.collect()), key=repr) == wanted and wanted
