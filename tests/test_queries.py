"""Every registered query against its SQL equivalent in DuckDB."""

import datetime as dt
import glob
import numbers
import os

import duckdb
import pytest
from conftest import SF_DIR

import __spark_entry__ as entry
from tickline.plans import whole  # noqa: F401  registers more queries
from tickline.plans.queries import ORACLES, QUERIES


@pytest.fixture(scope="module")
def oracle():
    connection = duckdb.connect()
    for file in glob.glob(f"{SF_DIR}/*.parquet"):
        name = os.path.basename(file).removesuffix(".parquet")
        connection.sql(f"CREATE VIEW {name} AS SELECT * FROM '{file}'")
    yield connection
    connection.close()


def comparable(columns, data):
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if isinstance(v, bool) or v is None:
            return str(v)
        if isinstance(v, numbers.Number):
            return repr(float(v))
        if isinstance(v, dt.datetime):
            return v.isoformat()
        return str(v)

    return [columns[i] for i in order], sorted(tuple(value(r[i]) for i in order) for r in data)


@pytest.mark.parametrize("name", list(QUERIES))
def test_query_equals_sql(spark, oracle, name):
    got = QUERIES[name](spark, SF_DIR)
    spark_columns, spark_rows = comparable(got.columns, got.collect())
    answer = oracle.sql(ORACLES[name])
    sql_columns, sql_rows = comparable(answer.columns, answer.fetchall())
    assert spark_columns == sql_columns
    assert spark_rows == sql_rows
    assert spark_rows or name == "price_outliers"


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry.queries()) and set(ORACLES) <= set(entry.oracle_sql())


def test_entry(spark):
    result = entry.entry(spark)
    assert result.count() > 0
    assert "moving_avg_price" in result.columns
