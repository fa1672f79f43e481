"""Every registered query against its DuckDB counterpart, over the whole tables."""

from __future__ import annotations

import pytest

import __spark_entry__ as entry_point
from catalog import registry
from loadlens.sources.sinks import clean_staged
from tests.compare import connect, differences

QUERIES = registry.QUERIES
ORACLES = registry.ORACLES


@pytest.fixture(scope="module")
def con(sf_dir):
    return connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(name, spark, sf_dir, con):
    assert differences(QUERIES[name](spark, sf_dir), con, ORACLES[name]) == []
    clean_staged(spark)


def test_every_query_has_a_counterpart_and_is_registered():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_point.queries())
    assert set(ORACLES) <= set(entry_point.oracle_sql())
