"""Every registered query against its SQL."""

import os

import pytest

import __spark_entry__ as entry
from millwright.operators.ordered import SLICE_ROWS_SETTING
from tests.oracle import compare, connect

SF_DIR = os.environ.get("CHECK_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.fixture
def small_slices(spark):
    """The tables are small: with small slices each machine has many, as on large data."""
    spark.conf.set(SLICE_ROWS_SETTING, "50")
    yield
    spark.conf.unset(SLICE_ROWS_SETTING)


@pytest.mark.usefixtures("small_slices")
@pytest.mark.parametrize("name", sorted(entry.queries()))
def test_query(spark, con, name):
    df = entry.queries()[name](spark, SF_DIR)
    statements = entry.oracle_sql()
    if name in statements:
        assert compare(df, con, statements[name]) is None
    else:
        assert df.count() >= 0


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["machine_id", "start", "end", "duration", "execution", "r"]
    assert df.count() > 0


def test_sql_belongs_to_queries():
    assert set(entry.oracle_sql()) <= set(entry.queries())
