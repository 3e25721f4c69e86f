"""The driver's contract."""

import duckdb
import pytest

import __spark_entry__ as driver
from feedloom.plans import queries as plans

FOLDER = "/root/testdata/sf0.001"


def test_entry(spark):
    assert driver.entry(spark).count() > 0


def test_every_sql_has_a_query():
    assert set(driver.oracle_sql()) <= set(driver.queries())


def cells(value):
    if isinstance(value, float):
        return round(value, 6)
    return tuple(map(cells, value)) if isinstance(value, (list, tuple)) else value


@pytest.fixture(scope="module")
def duck():
    connection = duckdb.connect()
    for name in ("region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events", "documents", "embeddings", "pages", "benchmark", "labels", "conversations"):
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
    return connection


@pytest.mark.parametrize("name", sorted(plans.ORACLES))
def test_query_against_sql(spark, duck, name):
    made = plans.QUERIES[name](spark, FOLDER)
    columns = sorted(made.columns)
    got = sorted((tuple(cells(r[c]) for c in columns) for r in made.collect()), key=repr)
    want = duck.sql(plans.ORACLES[name])
    at = [want.columns.index(c) for c in columns]
    assert sorted(want.columns) == columns
    assert got == sorted((tuple(cells(r[i]) for i in at) for r in want.fetchall()), key=repr)


def test_one_python_function_only(spark):
    """Only the folding of accents, and products of blocks of vectors, leave the JVM."""
    for name, query in plans.QUERIES.items():
        plan = query(spark, FOLDER)._jdf.queryExecution().optimizedPlan().toString()
        assert "Python" not in plan or "_without_accents" in plan or name.startswith("knn_"), name
