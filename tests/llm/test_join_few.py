"""Joins of documents with what is known of few of them, at both sizes of the small side."""

from __future__ import annotations

from collections import Counter

import pytest
from pyspark.sql import functions as F

from dockhand.llm import common
from dockhand.llm.line_dedup import drop_lines
from dockhand.llm.near_copies import first_of_near_copies


@pytest.fixture(params=["broadcast", "bitmap"])
def size(request, monkeypatch):
    if request.param == "bitmap":
        monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    return request.param


@pytest.mark.parametrize("how", ["left", "left_anti"])
@pytest.mark.parametrize("few", [0, 1, 700])
def test_against_a_plain_join(spark, size, how, few):
    df = spark.range(20_000).select(
        F.xxhash64("id").alias("h"), F.when(F.col("id") % 9 > 0, F.xxhash64(F.lit(1), "id")).alias("g"),
        F.col("id").alias("`odd.name"), F.lit("b").alias("bucket"),
    ).unionAll(spark.range(3).select(F.lit(None), F.lit(None), "id", F.lit("null")))
    small = common.written(
        df.filter("g IS NOT NULL").limit(few).select("h", "g", F.md5(F.col("h").cast("string")).alias("value")), "few"
    )
    got = common.join_few(df, small, ["h", "g"], how)
    want = df.join(small, ["h", "g"], how)
    assert got.columns == [*df.columns, *(["value"] if how == "left" else [])]
    assert Counter(map(tuple, got.collect())) == Counter(map(tuple, want.select(*[F.col(f"`{c.replace('`', '``')}`") for c in got.columns]).collect()))


def test_only_possible_partners_are_shuffled(spark, monkeypatch):
    monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    df = spark.range(50_000).select(F.xxhash64("id").alias("h"))
    small = common.written(df.limit(50), "few")
    probed = common.join_few(df, small, ["h"], "left_anti")
    assert probed.count() == 49_950
    plan = probed._jdf.queryExecution().optimizedPlan().toString()
    assert plan.count("Join LeftAnti") == 1 and "bitmap_construct_agg" in plan


def rows(df) -> Counter:
    return Counter((r.doc_id, r.text) for r in df.collect())


def test_operators_agree_at_both_sizes(spark, odd_docs, monkeypatch):
    """The same rows, texts, nulls and repeats, however the small side is joined."""
    operators = [lambda: drop_lines(odd_docs, min_docs=2), lambda: first_of_near_copies(odd_docs)]
    small = [rows(operator()) for operator in operators]
    monkeypatch.setattr(common, "BROADCAST_BYTES", -1)
    assert [rows(operator()) for operator in operators] == small
