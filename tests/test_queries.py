"""Every registered query against DuckDB at the smallest scale."""

import pytest

from __spark_entry__ import entry, oracle_sql, queries
from compare import connect, difference
from funil.plans.catalog import QUERIES
from oracle import ORACLE

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def db():
    return connect(FOLDER)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(queries()) and set(ORACLE) <= set(oracle_sql())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, db, name):
    assert difference(spark, db, FOLDER, queries()[name], oracle_sql()[name]) is None


def test_entry(spark):
    result = entry(spark)
    assert result.count() == 25
    assert "leads_quentes" in result.columns
