"""Every registered query against its SQL."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from catalog import QUERIES
from oracles import ORACLES
from tools.compare import compare, database


@pytest.fixture(scope="module")
def connection(testdata):
    with database(testdata) as opened:
        yield opened


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(oracle_sql()) <= set(queries())


def test_copies_are_dropped(spark, testdata):
    for row in QUERIES["bronze_table_counts"](spark, testdata).collect():
        assert row["rows_dropped"] > 0 and row["rows_in_bronze"] == row["rows_read"] - row["rows_dropped"]


@pytest.mark.parametrize("name", sorted(oracle_sql()))
def test_matches_sql(spark, connection, testdata, name):
    assert compare(spark, connection, testdata, name) is None


def test_entry(spark):
    result = entry(spark)
    assert result.columns[:3] == ["production_line", "shift_id", "product_category"]
    assert result.count() > 0
