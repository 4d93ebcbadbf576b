"""Every query against its DuckDB twin."""

import pytest

import __spark_entry__ as entry_points
from tests.oracle import connect, duck_rows, spark_rows

SF_DIR = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def duck():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(entry_points.queries()))
def test_query_matches_twin(spark, duck, name):
    columns, rows = spark_rows(entry_points.queries()[name](spark, SF_DIR))
    sql = entry_points.oracle_sql().get(name)
    if sql is None:
        assert rows
        return
    twin_columns, twin_rows = duck_rows(duck, sql)
    assert columns == twin_columns
    assert rows == twin_rows


def test_entry(spark):
    assert entry_points.entry(spark).count() == 6
