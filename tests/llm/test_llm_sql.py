"""Queries against their SQL on DuckDB."""

from collections import Counter

import duckdb
import pytest

from footfall.llm import queries

TABLES = "documents embeddings pages benchmark labels conversations".split()


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01"])
def test_matches_sql(spark, name, sf_dir):
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    expected = connection.execute(queries.oracle_sql()[name])
    columns = [item[0] for item in expected.description]
    df = queries.queries()[name](spark, sf_dir)
    assert sorted(df.columns) == sorted(columns)
    assert Counter(map(tuple, df.select(*columns).collect())) == Counter(expected.fetchall())
