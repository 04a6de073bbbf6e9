"""Exact duplicates by two-pass Bloom filtering.

Pass one counts, for every bit position of a Bloom filter, how many rows set it; positions
set more than once make a bitmap of bounded size.  Pass two probes each row: only rows
whose positions are all set more than once can have an equal, and only they shuffle by
their hash.  All others pass straight through.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockhand.llm.common import lower_ascii, text_of, written

# Bits of one bitmap value of Spark's bitmap functions.
BUCKET_BITS = 32768
MIN_BITS = 1 << 20
# 32 MB of broadcast bitmap at most.  More rows than it serves well pass the filter more
# often and shuffle; the result stays the same.
MAX_BITS = 1 << 28
BITS_PER_ROW = 16
PROBES = 2


def _filter_bits(rows: int, max_bits: int) -> int:
    bits = MIN_BITS
    while bits < min(max_bits, rows * BITS_PER_ROW):
        bits *= 2
    return bits


def _position(probe: int, bits: int) -> Column:
    return F.pmod(F.xxhash64(F.lit(probe), F.col("text_sha256")), F.lit(bits))


def _is_set(bitmap: Column, position: Column) -> Column:
    bit = (position % BUCKET_BITS).cast("int")
    byte = F.substring(bitmap, F.floor(bit / 8).cast("int") + 1, F.lit(1))
    value = F.conv(F.hex(byte), 16, 10).cast("int")
    return F.floor(value / F.pow(F.lit(2), bit % 8)) % 2 == 1


def possibly_repeated(hashed: DataFrame, max_bits: int = MAX_BITS) -> DataFrame:
    """``hashed`` with a boolean ``maybe``: false only where no other row has the hash."""
    bits = _filter_bits(hashed.count(), max_bits)
    positions = [_position(i, bits) for i in range(PROBES)]
    bitmaps = (
        hashed.select(F.explode(F.array(*positions)).alias("position"))
        .groupBy("position").count().filter("count > 1")
        .groupBy(F.floor(F.col("position") / BUCKET_BITS).alias("bucket"))
        .agg(F.bitmap_construct_agg(F.col("position") % BUCKET_BITS).alias("bitmap"))
    )
    maybe = F.lit(True)
    for i, position in enumerate(positions):
        # At most MAX_BITS / 8 bytes, whatever the input.
        probe = F.broadcast(bitmaps.select(
            F.col("bucket").alias(f"bucket{i}"), F.col("bitmap").alias(f"bitmap{i}")
        ))
        hashed = hashed.join(
            probe, F.floor(position / BUCKET_BITS) == F.col(f"bucket{i}"), "left"
        )
        maybe = maybe & _is_set(F.col(f"bitmap{i}"), position)
    drop = [f"{n}{i}" for i in range(PROBES) for n in ("bucket", "bitmap")]
    return hashed.withColumn("maybe", F.coalesce(maybe, F.lit(False))).drop(*drop)


def exact_duplicates(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", max_bits: int = MAX_BITS
) -> DataFrame:
    """One row per input row: its group of equal texts and whether it stays.

    Texts are equal when identical after lower-casing A-Z; null counts as empty.  The row
    with the largest id stays.  Of rows that repeat that id too, one stays.  A null id is
    smaller than any other; a group of nulls has a null ``keep_id``.  Columns: the id,
    ``keep_id``, ``group_size``, ``kept``, ``text_sha256``; an empty table gives none.
    """
    hashed = written(
        df.select(
            F.col(id_col).alias("doc"),
            F.sha2(F.encode(lower_ascii(text_of(text_col)), "UTF-8"), 256).alias("text_sha256"),
        ).withColumn("row", F.monotonically_increasing_id()),
        "exact_hashes",
    )
    probed = possibly_repeated(hashed, max_bits)
    groups = written(
        probed.filter("maybe").groupBy("text_sha256").agg(
            F.max(F.struct("doc", "row")).alias("last"), F.count("*").alias("size")
        ).filter("size > 1"),
        "exact_groups",
    )
    alone = (
        F.col("doc").alias("keep_id"), F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"),
    )
    single = probed.filter("NOT maybe").select("doc", *alone, "text_sha256")
    checked = probed.filter("maybe").join(groups, "text_sha256", "left").select(
        "doc",
        F.when(F.col("last").isNull(), F.col("doc")).otherwise(F.col("last.doc")).alias("keep_id"),
        F.coalesce("size", F.lit(1)).cast("bigint").alias("group_size"),
        F.coalesce(F.col("row") == F.col("last.row"), F.lit(True)).alias("kept"),
        "text_sha256",
    )
    return single.unionByName(checked).withColumnRenamed("doc", id_col)
