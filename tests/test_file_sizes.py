"""Files of a size that is asked for, out of partitions of any size."""

from __future__ import annotations

from pathlib import Path

import pytest
from pyspark.sql import functions as F

import dockhand
from dockhand import SpecError
from dockhand.operators.files import _no_pattern, odd_files
from test_loads import beside, names


def sizes(spec) -> list[int]:
    return [Path(spec.location, n).stat().st_size for n in names(spec.location)]


@pytest.fixture
def uneven(spark):
    """200 partitions, most of a few rows, some of none, one of a third of all rows."""
    rows = spark.range(0, 60_000, 1, 8)
    key = F.expr("CASE WHEN id % 3 = 0 THEN 0 WHEN id % 3 = 1 THEN id % 20 ELSE id % 180 END")
    return rows.select(
        F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("w"), key.alias("p")
    ).repartition(200, "p").select("k", "w")


@pytest.mark.parametrize("file_format,compression", [
    ("orc", "snappy"), ("parquet", "none"), ("text", "none"), ("text", "gzip"),
])
def test_sizes_out_of_uneven_partitions(spark, uneven, make, file_format, compression):
    spec = make(
        file_format=file_format, compression=compression, delimiter="|", target_file_bytes=200_000,
        location=make().location + "/odd {x} [y]",
    )
    result = dockhand.write_files(uneven, spec)
    assert all(100_000 <= n <= 400_000 for n in sizes(spec)) and len(sizes(spec)) >= 5
    assert (result.rows_read, result.rows_dirty) == (60_000, 0)
    assert sorted(result.files) == names(spec.location)
    assert all(n.startswith("load__") for n in result.files)
    path = _no_pattern(spec.location)
    if file_format == "text":
        found = dockhand.read_text(spark, path, spec.output_schema, "|")
    else:
        found = spark.read.format(file_format).load(path)
    assert found.count() == found.distinct().count() == 60_000
    assert found.exceptAll(uneven).count() == 0


def test_fitting_files_are_left_alone(spark, make):
    rows = spark.range(0, 40_000, 1, 4).select(
        F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("w")
    )
    few = spark.range(40_000, 40_100, 1, 1).select(
        F.col("id").alias("k"), F.sha2(F.col("id").cast("string"), 256).alias("w")
    )
    plain = make(file_prefix="plain")
    dockhand.write_files(rows.unionAll(few), plain)
    whole = sorted(sizes(plain))
    spec = make(target_file_bytes=whole[-1], file_prefix="fitted", location=make().location + "2")
    dockhand.write_files(rows.unionAll(few), spec)
    # The small file and the smallest other one became one; the rest were not touched.
    assert sorted(sizes(spec))[:3] == whole[2:] and len(sizes(spec)) == 4
    assert spark.read.orc(spec.location).count() == 40_100 and beside(make()) == ["target2"]


@pytest.mark.parametrize("have,target,want", [
    ([], 10, ([], 0)), ([10, 20, 5], 10, ([], 0)), ([1], 10, ([], 0)), ([1, 1], 10, ([0, 1], 1)),
    ([100], 10, ([0], 10)), ([10, 1], 10, ([0, 1], 1)), ([20, 10, 1], 10, ([1, 2], 1)),
    ([20, 1], 10, ([0, 1], 2)), ([4, 4, 4, 4, 21], 10, ([0, 1, 2, 3, 4], 4)),
])
def test_which_files_are_odd(have, target, want):
    assert odd_files(have, target) == want


def test_no_rows(spark, pairs, make):
    result = dockhand.write_files(pairs.limit(0), make(file_format="text", delimiter="|", target_file_bytes=10))
    assert result.files == [] and beside(make()) == []


def test_size_that_makes_no_sense(make):
    with pytest.raises(SpecError, match="target_file_bytes"):
        make(target_file_bytes=0)
