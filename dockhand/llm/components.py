"""Connected components of a graph that stays distributed."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from dockhand.llm.common import written


def connected_components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the smallest node of its component, of edges ``a``, ``b``.

    Alternates two steps until nothing changes: every node hands its larger neighbours to
    its smallest one, then its smaller ones.  The edges shrink to stars in a number of
    rounds that grows with the logarithm of the nodes.  Each round is written to the shared
    folder.
    """
    current = written(
        edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .filter("a <> b").distinct(),
        "edges",
    )
    before = None
    while True:
        both = current.unionByName(current.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(least, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = written(large.filter("a <> b").distinct(), "edges")
        down = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(down, "a").select(
            F.explode(F.array(F.struct("a", "m"), F.struct(F.col("b").alias("a"), "m"))).alias("e")
        ).select("e.a", F.col("e.m").alias("b"))
        current = written(small.filter("a <> b").distinct(), "edges")
        state = current.agg(F.count("*"), F.expr("bit_xor(xxhash64(a, b))")).first()
        if state == before:
            return current.select(F.col("a").alias("node"), F.col("b").alias("root"))
        before = state
