"""What the operators share: the text classes of the contracts and written intermediates."""

from __future__ import annotations

import tempfile
import zipfile
from collections.abc import Iterable
from pathlib import Path
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from dockhand.functions.sql import sql_name
from dockhand.plans.workspace import new_workspace
from dockhand.sources.files import entries

# The characters that part words, and the letters that are lower-cased.
SPACES = " \t\n\x0b\x0c\r"
SPACE_CLASS = r"[\x20\x09-\x0D]"
UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"
LOWER = "abcdefghijklmnopqrstuvwxyz"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def text_of(column: str) -> Column:
    """A text column, null counting as empty."""
    return F.coalesce(F.col(column).cast("string"), F.lit(""))


def lower_ascii(column: Column) -> Column:
    """A-Z in lower case and nothing else changed."""
    return F.translate(column, UPPER, LOWER)


def words_of(column: Column) -> Column:
    """The words of a text, an empty array where it has none."""
    trimmed = F.btrim(column, F.lit(SPACES))
    return F.when(trimmed != "", F.split(trimmed, SPACE_CLASS + "+")).otherwise(
        F.array().cast("array<string>")
    )


def written(df: DataFrame, name: str) -> DataFrame:
    """The frame as a Parquet table in the shared folder.

    It cuts the lineage in a way that outlives an executor, and Spark knows its size, so
    that it is broadcast only when it is small.
    """
    spark = df.sparkSession
    path = f"{new_workspace(spark, name)}/table"
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


class Aside:
    """A frame whose columns have numbers for names, so that none clashes with an operator's own."""

    def __init__(self, df: DataFrame) -> None:
        self.names = df.columns
        self.df = df.toDF(*[self._number(i) for i in range(len(self.names))])

    def _number(self, i: int) -> str:
        return f"in_{i}"

    def name(self, column: str) -> str:
        """What a column is called here."""
        return self._number(self.names.index(column))

    def own(self, df: DataFrame, leaving: Iterable[str] = ()) -> list[Column]:
        """The columns of ``df`` that were there first, under their names, but those that leave."""
        return [
            df[self._number(i)].alias(n) for i, n in enumerate(self.names) if n not in set(leaving)
        ]


# A written table of fewer bytes goes to every executor where it is joined with texts.
BROADCAST_BYTES = 16 << 20


def stored_bytes(df: DataFrame) -> int:
    """The size of the files of a :func:`written` frame."""
    files = df.inputFiles()
    if not files:
        return 0
    folder = unquote(files[0].rsplit("/", 1)[0])
    return sum(e.length for e in entries(df.sparkSession, folder) if not e.is_directory)


def join_few(df: DataFrame, few: DataFrame, keys: list[str], how: str) -> DataFrame:
    """``df`` joined with a :func:`written` table (``left`` or ``left_anti``) on key hashes.

    ``keys`` are columns of 64-bit hashes, of the same names in both.  A table of few bytes
    is broadcast.  For a larger one, a bitmap of its keys is, which has at most
    ``MAX_BITMAP_BITS``: rows of ``df`` whose bit is not set have no partner and pass straight
    through, and only the others are shuffled.
    """
    on = [F.col(f"a.{k}") == F.col(f"b.{k}") for k in keys]
    rest = [c for c in few.columns if c not in keys] if how == "left" else []
    columns = [F.col(f"a.{sql_name(c)}") for c in df.columns] + [F.col(f"b.{sql_name(c)}") for c in rest]
    if stored_bytes(few) <= BROADCAST_BYTES:
        return df.alias("a").join(F.broadcast(few).alias("b"), on, how).select(*columns)
    bits = MIN_BITMAP_BITS
    while bits < min(MAX_BITMAP_BITS, 16 * few.count()):
        bits *= 2

    def place(names: list[str]) -> Column:
        return F.pmod(F.xxhash64(*names), F.lit(bits))

    bitmap = few.select(place(keys).alias("place")).distinct().groupBy(
        F.floor(F.col("place") / BUCKET_BITS).alias("bucket")
    ).agg(F.bitmap_construct_agg(F.col("place") % BUCKET_BITS).alias("bitmap"))
    aside = Aside(df)
    probed = aside.df.withColumn("place", place([aside.name(k) for k in keys])).join(
        F.broadcast(bitmap), F.floor(F.col("place") / BUCKET_BITS) == F.col("bucket"), "left"
    ).withColumn("maybe", F.coalesce(is_set(F.col("bitmap"), F.col("place")), F.lit(False)))
    maybe = probed.filter("maybe").select(*aside.own(probed))
    alone = probed.filter("NOT maybe").select(
        *aside.own(probed), *[F.lit(None).cast(few.schema[c].dataType).alias(c) for c in rest]
    )
    return maybe.alias("a").join(few.alias("b"), on, how).select(*columns).unionAll(alone)


# Bits of one bitmap value of Spark's bitmap functions, and of a whole bitmap of join_few.
BUCKET_BITS = 32768
MIN_BITMAP_BITS = 1 << 20
MAX_BITMAP_BITS = 1 << 28


def is_set(bitmap: Column, place: Column) -> Column:
    """The bit of a place in the bitmap value of its bucket."""
    bit = (place % BUCKET_BITS).cast("int")
    byte = F.conv(F.hex(F.substring(bitmap, F.floor(bit / 8).cast("int") + 1, F.lit(1))), 16, 10)
    return F.floor(byte.cast("int") / F.pow(F.lit(2), bit % 8)) % 2 == 1


def shuffle_partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


_shipped: set[str] = set()


def ship_code(spark: SparkSession) -> None:
    """Give this package to the Python workers, once per application.

    The driver serves the archive, so nothing has to be installed on the executors.
    """
    context = spark.sparkContext
    if context.applicationId in _shipped:
        return
    package = Path(__file__).resolve().parent.parent
    archive = Path(tempfile.mkdtemp()) / f"{package.name}_package.zip"
    with zipfile.ZipFile(archive, "w") as out:
        for source in sorted(package.rglob("*.py")):
            out.write(source, source.relative_to(package.parent))
    context.addPyFile(str(archive))
    _shipped.add(context.applicationId)
