"""The corpus pipeline: documents judged, cleaned, made distinct, mixed and packed."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from dockhand.llm.common import Aside, table, written
from dockhand.llm.line_dedup import drop_lines
from dockhand.llm.mixing import mix
from dockhand.llm.near_copies import first_of_near_copies
from dockhand.llm.packing import pack
from dockhand.llm.quality import judge
from dockhand.llm.queries import PACKING_END_ID, tokenizer_path, trusted_ids

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rules keep."""
    rows = Aside(docs)
    judged = judge(rows.df, trusted_ids(spark, sf_dir), rows.name("doc_id"), rows.name("text"), held_out=True)
    kept = judged.filter("kept")
    return kept.select(*rows.own(kept))


def line_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without the lines that ten or more of them share."""
    rows = Aside(docs)
    cleaned = drop_lines(rows.df, rows.name("doc_id"), rows.name("text"))
    return cleaned.select(*rows.own(cleaned))


def jaccard_join(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The first row of each component of similar ones, by its id and place.

    Five words and 0.8 are what stages on word shingles take.
    """
    return first_of_near_copies(docs, width=5, percent=80)


def mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the weight of their source asks."""
    rows = Aside(docs)
    mixed = mix(rows.df, rows.name("doc_id"), rows.name("source"), rows.name("text"))
    return mixed.select(*rows.own(mixed))


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of the documents, with their ids and their places in sequences."""
    return pack(docs, tokenizer_path("word_bpe_49k.json"), PACKING_END_ID, special_tokens=True)


STAGES: list[tuple[str, Stage]] = [
    ("quality rules", quality_rules),
    ("line dedup", line_dedup),
    ("n-gram Jaccard join", jaccard_join),
    ("mixing sources to target weights", mixing),
    ("packing", packing),
]

# Hashes and packing plans have no SQL; the tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows of the last stage, every stage written and read again."""
    docs = table(spark, sf_dir, "documents")
    for _, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), "stage")
    return docs
