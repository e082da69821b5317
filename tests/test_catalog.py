"""Every registered query against its oracle SQL on the smallest data set."""

import math
import pathlib

import duckdb
import pytest

import __spark_entry__ as registered

DATA = pathlib.Path("/root/testdata/sf0.001")
pytestmark = pytest.mark.skipif(not DATA.exists(), reason="no test data")


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for path in DATA.glob("*.parquet"):
        connection.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return connection


def cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6f}"
    return str(value)


def content(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(columns), sorted(tuple(cell(row[i]) for i in order) for row in rows)


@pytest.mark.parametrize("name", sorted(registered.queries()))
def test_query(spark, oracle, name):
    df = registered.queries()[name](spark, str(DATA))
    got = content(df.columns, df.collect())
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "CartesianProduct" not in plan and "NestedLoop" not in plan
    sql = registered.oracle_sql().get(name)
    if sql is None:
        assert got[1]
    else:
        result = oracle.execute(sql)
        assert got == content([d[0] for d in result.description], result.fetchall())


def test_entry(spark):
    assert registered.entry(spark).count() > 0
