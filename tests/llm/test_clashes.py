"""Extra columns named as the operators name their own come back as they were."""

from __future__ import annotations

from collections import Counter

import pytest
from texts import ADDED

import corpus_pipeline
from dockhand.llm.licences import scan_licences
from dockhand.llm.line_dedup import drop_lines
from dockhand.llm.mixing import mix
from dockhand.llm.quality import judge

DATA = "/root/testdata/sf0.001"
OPERATORS = {
    "judge": lambda spark, df: judge(df, df.selectExpr("doc_id"), held_out=True),
    "judge by weights": lambda spark, df: judge(df, df.selectExpr("doc_id")),
    "drop_lines": lambda spark, df: drop_lines(df, min_docs=2),
    "mix": lambda spark, df: mix(df),
    "scan_licences": lambda spark, df: scan_licences(df),
}
STAGES = {name: stage for name, stage in corpus_pipeline.STAGES if name != "packing"}


def extra(row, columns) -> tuple:
    return tuple(row[c] for c in columns)


@pytest.mark.parametrize("name", OPERATORS)
def test_operators(spark, odd_docs, name):
    result = OPERATORS[name](spark, odd_docs)
    # What an operator itself adds stands for the column of that name.
    columns = [c for c in odd_docs.columns if c not in (*ADDED, "text", "kept")]
    assert len(columns) > 50 and len(set(result.columns)) == len(result.columns)
    want = Counter(extra(r, columns) for r in odd_docs.collect())
    got = Counter(extra(r, columns) for r in result.collect())
    assert set(got) <= set(want) if name == "mix" else got == want


@pytest.mark.parametrize("name", STAGES)
def test_stages(spark, odd_docs, name):
    result = STAGES[name](spark, odd_docs, DATA)
    assert result.schema.simpleString() == odd_docs.schema.simpleString()
    columns = [c for c in odd_docs.columns if c != "text"]
    want = {extra(r, columns) for r in odd_docs.collect()}
    got = {extra(r, columns) for r in result.collect()}
    assert got <= want
    assert got == want or name in ("quality rules", "n-gram Jaccard join", "mixing sources to target weights")
