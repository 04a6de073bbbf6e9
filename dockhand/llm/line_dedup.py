"""Lines that many documents share, dropped by per-document keep bitmaps.

Every line becomes a 128-bit hash.  The hashes are range-partitioned together with their
document, with a secondary sort by position, so that a line of a third of all documents
spreads over many partitions and each partition streams past its first occurrences.  They
are counted per hash with a partial sum on the map side.  What goes back to the documents
is not text but a sparse bitmap of dropped lines: one 64-bit word per 64 lines, words
without a dropped line left out.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockhand.llm.common import SPACES, Aside, join_few, lower_ascii, text_of, written

WORD = 64
_HASH = ["h1", "h2"]
_DOC = ["doc", "version"]


def _version(id_col: str, text_col: str) -> Column:
    """Tells rows of one id apart by their text; rows equal in both are one document."""
    return F.xxhash64(F.col(id_col), text_of(text_col))


def _id_hash(id_col: str) -> Column:
    """With the version, 128 bits that stand for a document."""
    return F.xxhash64(F.lit(1), id_col)


def _lines(df: DataFrame, id_col: str, text_col: str, min_chars: int) -> DataFrame:
    key = lower_ascii(F.btrim(F.col("line"), F.lit(SPACES)))
    return (
        df.select(
            F.col(id_col).alias("doc"), _version(id_col, text_col).alias("version"),
            F.posexplode(F.split(text_of(text_col), "\n")).alias("position", "line"),
        )
        .select(*_DOC, "position", key.alias("key"))
        .filter(F.length("key") >= min_chars)
        .select(
            F.xxhash64("key").alias("h1"), F.xxhash64(F.lit(1), "key").alias("h2"), *_DOC, "position"
        )
    )


def line_bitmaps(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 1,
    min_docs: int = 10,
    keep_first: bool = False,
) -> DataFrame:
    """The dropped lines of each document that has any.

    A line's key is the line stripped of blanks at both ends, A-Z in lower case.  Keys of
    at least ``min_chars`` code points found in at least ``min_docs`` documents lose all
    their lines, or with ``keep_first`` all but the first one of the smallest document.
    Columns: ``doc``, ``version`` (:func:`_version`), ``dropped``, an array of ``word``
    and ``bits``, bit ``p % 64`` of word ``p / 64`` standing for line ``p``.
    """
    in_document = Window.partitionBy(*_HASH, *_DOC).orderBy("position")
    lines = written(
        _lines(df, id_col, text_col, min_chars)
        .repartitionByRange(*_HASH, *_DOC)
        .withColumn("first", F.row_number().over(in_document) == 1),
        "line_hashes",
    )
    repeated = written(
        lines.filter("first").groupBy(*_HASH)
        .agg(F.count("*").alias("docs"), F.min(F.struct(*_DOC, "position")).alias("earliest"))
        .filter(F.col("docs") >= min_docs).drop("docs"),
        "line_repeated",
    )
    dropped = lines.join(repeated, _HASH)
    if keep_first:
        dropped = dropped.filter(~F.col("earliest").eqNullSafe(F.struct(*_DOC, "position")))
    bit = F.expr(f"shiftleft(1L, cast(position % {WORD} as int))")
    return (
        dropped.groupBy(*_DOC, F.expr(f"cast(position div {WORD} as int)").alias("word"))
        .agg(F.bit_or(bit).alias("bits"))
        .groupBy(*_DOC)
        .agg(F.sort_array(F.collect_list(F.struct("word", "bits"))).alias("dropped"))
    )


def drop_lines(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    min_chars: int = 1,
    min_docs: int = 10,
    keep_first: bool = False,
) -> DataFrame:
    """``df`` without its shared lines, one row per input row.

    The text column holds the lines that stay, joined by a line feed.  ``n_lines`` counts
    the lines before and ``n_dropped`` those that went; columns of these names in ``df``
    give way to them.  A null or empty text is one empty line and becomes an empty text.
    Repeated rows are one document and are treated alike.
    """
    bitmaps = written(
        line_bitmaps(df, id_col, text_col, min_chars, min_docs, keep_first).select(
            F.col("version").alias("_version"), _id_hash("doc").alias("_id"), F.col("dropped").alias("_dropped")
        ),
        "line_bitmaps",
    )
    aside = Aside(df)
    text, doc = aside.name(text_col), aside.name(id_col)
    keyed = aside.df.withColumns({"_version": _version(doc, text), "_id": _id_hash(doc)})
    found = join_few(keyed, bitmaps, ["_version", "_id"], "left")
    lines = found.withColumn("_lines", F.split(text_of(text), "\n")).withColumn(
        # All words, so that a line finds its bit by position.
        "_words",
        F.expr(
            "CASE WHEN _dropped IS NOT NULL THEN transform("
            f"sequence(0, (size(_lines) - 1) div {WORD}),"
            " w -> coalesce(try_element_at(map_from_entries(_dropped), cast(w AS int)), 0L)) END"
        ),
    )
    kept = F.expr(
        "array_join(filter(_lines, (line, i) ->"
        f" shiftright(_words[cast(i div {WORD} AS int)], i % {WORD}) & 1 = 0), '\\n')"
    )
    cleaned = lines.withColumn(text, F.when(F.col("_words").isNull(), text_of(text)).otherwise(kept))
    return cleaned.select(
        *aside.own(cleaned, ["n_lines", "n_dropped"]),
        F.size("_lines").cast("bigint").alias("n_lines"),
        F.expr("coalesce(aggregate(_dropped, 0L, (n, w) -> n + bit_count(w.bits)), 0L)").alias("n_dropped"),
    )
