"""Every registered query against its DuckDB SQL."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest
from given import DATA

ROOT = Path(__file__).resolve().parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

import __spark_entry__ as spark_entry  # noqa: E402
from check_queries import check, duckdb_on  # noqa: E402
from dockhand_queries.common import REGISTRY  # noqa: E402


@pytest.fixture(scope="module")
def connection():
    return duckdb_on(DATA)


@pytest.mark.parametrize("name", sorted(REGISTRY.queries))
def test_query_agrees_with_its_sql(spark, connection, name):
    assert check(spark, connection, DATA, name) == ""


def test_every_query_has_sql():
    assert REGISTRY.queries.keys() == REGISTRY.oracles.keys()
    assert spark_entry.queries().keys() >= REGISTRY.queries.keys()
    assert spark_entry.oracle_sql().keys() >= REGISTRY.oracles.keys()


def test_entry(spark):
    result = spark_entry.entry(spark)
    assert result.count() > 0
    assert "order_rows" in result.columns
