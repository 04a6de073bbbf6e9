"""One row of each group of near copies, by the Jaccard join of :mod:`dockhand.llm.jaccard_join`."""

from __future__ import annotations

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockhand.llm.common import Aside, join_few, written
from dockhand.llm.jaccard_join import jaccard_classes


def _placed(docs: DataFrame, id_col: str) -> DataFrame:
    """Documents with ``_row``, what names a row: its id, nulls last, and its place in a file.

    A place is the same whenever the file is read; frames that are not Parquet files are
    written first.
    """
    row = F.struct(
        F.col(id_col).isNull().alias("without"), F.col(id_col).alias("doc_id"),
        F.xxhash64("_metadata.file_path").alias("file"), F.col("_metadata.row_index").alias("place"),
    )
    try:
        return docs.select("*", row.alias("_row"))
    except AnalysisException:
        return written(docs, "rows").select("*", row.alias("_row"))


def first_of_near_copies(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", width: int = 5, percent: int = 80
) -> DataFrame:
    """The first row of each component of similar ones, by its id and place, with its columns.

    A row counts with its own text, also where others repeat its id or have none.  Rows
    without an id come after the others; rows without words are all kept.  Only the places of
    the rows that go are joined with the documents, whose texts are not shuffled for it.
    """
    aside = Aside(docs)
    placed = _placed(aside.df, aside.name(id_col))
    rows = placed.select("_row", F.col(aside.name(text_col)).alias("text"))
    classes = jaccard_classes(rows, id_col="_row", width=width, percent=percent)
    names = {"_file": "_row.file", "_place": "_row.place"}
    gone = written(
        classes.filter(F.col("_row") != F.col("component_id")).select(
            *[F.col(c).alias(n) for n, c in names.items()]
        ),
        "near_copies",
    )
    kept = join_few(placed.withColumns({n: F.col(c) for n, c in names.items()}), gone, list(names), "left_anti")
    return kept.select(*aside.own(kept))
