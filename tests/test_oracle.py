"""Every registered query against its SQL counterpart on DuckDB."""

import math
import re
from collections import Counter

import duckdb
import pytest

import __spark_entry__ as registry

# The queries of the training-data subpackage, if it is there, have tests beside it.
OWN = sorted(name for name in registry.queries() if not re.match(r"op\d+_|pipeline$", name))
TABLES = "region nation customer supplier part orders lineitem events".split()


def _normal(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else round(value, 9)
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=columns.__getitem__)
    return Counter(tuple(_normal(row[i]) for i in order) for row in rows)


def test_every_query_has_an_oracle():
    assert set(OWN) <= set(registry.oracle_sql())


def test_entry(spark):
    assert registry.entry(spark).count() == 10


@pytest.mark.parametrize("sf", ["0.001", "0.01"])
@pytest.mark.parametrize("name", OWN)
def test_same_rows_as_sql(spark, name, sf):
    sf_dir = f"/root/testdata/sf{sf}"
    connection = duckdb.connect()
    for table in TABLES:
        connection.execute(f"create view {table} as select * from '{sf_dir}/{table}.parquet'")
    expected = connection.execute(registry.oracle_sql()[name])
    names = [d[0] for d in expected.description]
    types = [str(d[1]) for d in expected.description]
    assert not any("HUGEINT" in t or "DECIMAL" in t for t in types), types
    expected = expected.fetchall()
    df = registry.queries()[name](spark, sf_dir)
    assert sorted(df.columns) == sorted(names)
    assert _rows(df.columns, df.collect()) == _rows(names, expected)
    assert expected
