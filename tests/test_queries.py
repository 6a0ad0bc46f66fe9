"""Every registered query against its SQL twin on the smallest tables."""

import pytest

import __spark_entry__ as entry
from changeflow.plans import registry
from conftest import SMALL
from oracle import compare, connect

QUERIES, SQL = registry.QUERIES, registry.ORACLE


@pytest.fixture(scope="module")
def con():
    return connect(SMALL)


def test_every_query_has_sql():
    assert set(SQL) == set(QUERIES)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    verdict, rows, _ = compare(spark, con, SMALL, QUERIES[name], SQL[name])
    assert verdict == "ok"


def test_entry(spark):
    out = entry.entry(spark)
    assert out.count() > 0
    assert out.columns[0] == "source_event_id"
