from __future__ import annotations

import sys
from pathlib import Path

import pytest

HERE = Path(__file__).resolve().parent
sys.path[:0] = [str(HERE), str(HERE.parent)]

from given import DATA  # noqa: E402
from session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("tests", cpus=4, shuffle_partitions=4)
    session.sql("CREATE DATABASE IF NOT EXISTS loads")
    yield session
    session.stop()


@pytest.fixture
def orders(spark):
    return spark.read.parquet(f"{DATA}/orders.parquet")


@pytest.fixture
def pairs(spark):
    """Five small rows of a key and a word."""
    return spark.createDataFrame(
        [(1, "one"), (2, "two"), (3, None), (4, ""), (5, "five")], "k bigint, w string"
    )


_names = iter(range(1_000_000))


@pytest.fixture
def make(tmp_path):
    """A spec maker with a fresh table and directory, sharing both between its calls."""
    from dockhand import LoadSpec

    name = f"t{next(_names)}"

    def spec(**options):
        values = {
            "table": f"loads.{name}", "location": f"{tmp_path}/target", "file_prefix": "load",
            "file_format": "orc", "write_mode": "append",
            "columns": [("k", "bigint"), ("w", "string")],
            **options,
        }
        return LoadSpec(**values)

    return spec
