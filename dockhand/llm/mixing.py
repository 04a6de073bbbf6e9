"""Mixing sources to target weights by Poisson replication.

Each document draws its number of copies from a Poisson distribution whose mean is the
target repetition rate of its source.  The draw inverts the distribution at a number made
of a hash of the document's id, so it is the same on every run and every retry, and it
needs no knowledge of other documents.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockhand.llm.common import Aside, text_of, written

# Above this mean a draw is the sum of several, each of at most this mean, since
# exp(-mean) would lose all precision.
MAX_MEAN = 200.0
# Terms of the distribution beyond the mean; what lies after them is below 1e-16.
_TAIL = "cast(ceil(mean + 12 * sqrt(mean) + 20) AS int)"


def source_rates(
    df: DataFrame,
    source_col: str = "source",
    text_col: str = "text",
    weights: DataFrame | None = None,
    epochs: float = 1.0,
) -> DataFrame:
    """The mean number of copies of each source's documents.

    A source's share of the corpus is its share of characters.  ``weights`` has columns
    ``source`` and ``weight``, of any sum; sources it does not name get no copies.  Without
    it, the target share follows the square root of the characters, between the natural
    shares and equal ones.  ``epochs`` is the size of the result, in corpora.  A source
    without any character keeps each document ``epochs`` times on average.  Null is a
    source of its own.  Columns: ``source``, ``rate``.
    """
    sizes = df.groupBy(F.col(source_col).alias("source")).agg(
        F.sum(F.length(text_of(text_col))).cast("double").alias("chars")
    )
    if weights is None:
        weighted = sizes.withColumn("weight", F.sqrt("chars"))
    else:
        given = weights.select(F.col("source").alias("_s"), F.col("weight").cast("double"))
        weighted = sizes.join(given, F.col("source").eqNullSafe(F.col("_s")), "left").select(
            "source", "chars", F.coalesce("weight", F.lit(0.0)).alias("weight")
        )
    weighted = written(weighted, "mixing_sizes")
    total = weighted.agg(F.sum("chars").alias("chars"), F.sum("weight").alias("weight")).first()
    share = F.col("weight") / F.lit(total["weight"] or 1.0)
    rate = share * F.lit(total["chars"] or 0.0) / F.col("chars") * F.lit(epochs)
    return weighted.select(
        "source", F.when(F.col("chars") > 0, rate).otherwise(F.lit(epochs)).alias("rate")
    )


def mix(
    df: DataFrame,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str = "text",
    weights: DataFrame | None = None,
    epochs: float = 1.0,
    seed: int = 0,
) -> DataFrame:
    """``df`` with each row as often as drawn, in a global random order.

    Added columns, which replace columns of the same names: ``rate``, ``n_copies``,
    ``copy`` from 1, and ``shuffle_key``, a hash of id, copy and seed by which the result is
    range-partitioned and sorted.  Rows of the same id draw the same number; a row without an
    id draws by the hash of its text.  An empty table gives an empty result.
    """
    aside = Aside(df)
    own = aside.df
    text = text_of(aside.name(text_col))
    key_of = F.coalesce(F.col(aside.name(id_col)).cast("string"), F.md5(text))
    rates = written(
        source_rates(df, source_col, text_col, weights, epochs)
        .withColumn("draws", F.greatest(F.lit(1), F.ceil(F.col("rate") / MAX_MEAN)).cast("int"))
        .withColumn("mean", F.col("rate") / F.col("draws"))
        .withColumn("cdf", F.expr(
            f"transform(aggregate(sequence(1, {_TAIL}),"
            " named_struct('p', array(exp(-mean)), 's', array(exp(-mean))), (a, k) -> named_struct("
            "'p', array(a.p[0] * mean / k),"
            " 's', array_append(a.s, a.s[k - 1] + a.p[0] * mean / k))).s, x -> x)"
        ))
        .select(F.col("source").alias("_source"), F.col("rate").alias("_rate"), "draws", "cdf"),
        "mixing_rates",
    )
    unit = (
        f"conv(substr(md5(concat_ws(':', _key, '{seed}', cast(j AS string))), 1, 13), 16, 10)"
        " / 4503599627370496D"
    )
    copies = F.expr(
        "aggregate(sequence(1, draws), 0, (n, j) ->"
        f" n + size(filter(cdf, c -> c <= {unit})))"
    )
    key = F.md5(F.concat_ws(":", "_key", F.lit(str(seed)), F.lit("copy"), F.col("copy").cast("string")))
    mixed = (
        own.join(rates, F.col(aside.name(source_col)).eqNullSafe(F.col("_source")))
        .withColumn("_key", key_of)
        .withColumn("n_copies", copies)
        .filter("n_copies > 0")
        .select(
            *own.columns, F.col("_rate").alias("rate"), "n_copies", "_key",
            F.explode(F.sequence(F.lit(1), F.col("n_copies"))).alias("copy"),
        )
        .withColumn("shuffle_key", key).drop("_key")
        .repartitionByRange("shuffle_key")
        .sortWithinPartitions("shuffle_key")
    )
    added = ["rate", "n_copies", "copy", "shuffle_key"]
    return mixed.select(*aside.own(mixed, added), *added)
