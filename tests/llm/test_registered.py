"""The registered queries next to their SQL, on the smallest data."""

from __future__ import annotations

import sys
from pathlib import Path

import pytest

ROOT = Path(__file__).resolve().parent.parent.parent
sys.path[:0] = [str(ROOT), str(ROOT / "tools")]

import __spark_entry__ as spark_entry  # noqa: E402
from check_queries import check, duckdb_on  # noqa: E402
from dockhand.llm.queries import ORACLES, QUERIES  # noqa: E402

DATA = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_agrees_with_its_sql(spark, name):
    # Nothing is frequent enough for phrases in the smallest data.
    data = DATA.replace("0.001", "0.01") if "phrase" in name else DATA
    assert check(spark, duckdb_on(data), data, name) == ""


def test_one_query_for_each_operator():
    numbers = sorted(int(n[2:].split("_")[0]) for n in QUERIES)
    assert numbers == list(range(1, 14))
    assert {*QUERIES, "pipeline"} <= spark_entry.queries().keys()


KEYS = {"op3_warc": "page_id", "op11_url_filters": "page_id", "op12_conversation_repair": "conv_id"}
TABLES = {"page_id": "pages", "conv_id": "conversations", "doc_id": "documents"}


@pytest.mark.parametrize("name", sorted(set(QUERIES) - {"op13_phrase_collocations"}))
def test_every_row_comes_out(spark, name):
    key = KEYS.get(name, "doc_id")
    want = spark.read.parquet(f"{DATA}/{TABLES[key]}.parquet").select(key).distinct().count()
    result = spark_entry.queries()[name](spark, DATA)
    if "mixing" in name:
        assert result.count() > 0
    elif "packing" in name:
        assert result.select(key).distinct().count() == want
    else:
        assert result.count() == result.select(key).distinct().count() == want
