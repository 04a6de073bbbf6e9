"""Which input files are read again for rejected rows, and limits on those rows."""

from __future__ import annotations

import pytest
from pyspark.sql import functions as F

import dockhand
from dockhand import RejectLimitError, SpecError
from dockhand.operators import convert
from test_loads import beside, failing, names


def files_read(df) -> int:
    """How many files the scan of a frame opens."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.apply(0).metrics().get("numFiles").get().value()


@pytest.fixture
def many(spark, tmp_path):
    """64 files of 10 rows, two of which hold one row each that does not convert."""
    path = f"{tmp_path}/input"
    k = F.expr("if(id IN (17, 503), 'x', CAST(id AS STRING))")
    rows = spark.range(0, 640, 1, 64).select(k.alias("k"), F.lit("w").alias("w"))
    rows.write.parquet(path)
    return spark.read.parquet(path)


@pytest.mark.parametrize("files", [None, 3])
def test_only_files_with_rejects_are_read_again(spark, many, make, files):
    result = dockhand.write_files(many.filter("w = 'w'"), make(files=files))
    assert (result.rows_read, result.rows_dirty) == (640, 2)
    again = convert.with_rejects(result.source, result.reject_files)
    assert files_read(many.select("k")) == 64 and files_read(again) == 2
    want = convert.dirty_rows(many, make().output_schema)
    assert sorted(result.dirty.collect()) == sorted(want.collect())


def test_rejects_kept_from_those_files(spark, many, make, tmp_path):
    result = dockhand.write_files(many, make(rejects_location=f"{tmp_path}/rejects"))
    assert {r.bad_value for r in spark.read.parquet(result.rejects).collect()} == {"x"}
    assert result.dirty.count() == 2


@pytest.mark.parametrize("plan", ["join", "aggregate", "rows", "own column"])
def test_inputs_that_do_not_know_their_files(spark, many, make, plan):
    df = {
        "join": lambda: many.join(many.select("k").withColumnRenamed("k", "j"), F.col("k") == F.col("j")).drop("j"),
        "aggregate": lambda: many.groupBy("k").agg(F.first("w").alias("w")),
        "rows": lambda: spark.createDataFrame([("1", "a"), ("x", "b")], "k string, w string"),
        "own column": lambda: many.withColumnRenamed("w", "_metadata"),
    }[plan]()
    spec = make(columns=[("k", "bigint"), (df.columns[1], "string")])
    result = dockhand.write_files(df, spec)
    assert result.rows_dirty == result.dirty.count() > 0
    # A join may still know the files of one side; those are read in full on the other.
    assert plan == "join" or result.reject_files is None


def test_more_files_than_are_told_apart(many, make, monkeypatch):
    monkeypatch.setattr(convert, "MAX_FILES", 1)
    result = dockhand.write_files(many, make())
    assert convert.with_rejects(result.source, result.reject_files) is result.source
    assert result.dirty.count() == 2


def test_no_bitmap_where_nothing_can_be_rejected(many, make):
    result = dockhand.write_files(many, make(columns=[("k", "string"), ("w", "string")]))
    assert result.reject_files is None and result.dirty.count() == 0


# Limits


@pytest.mark.parametrize("probe", [0, 100_000])
@pytest.mark.parametrize("limit", [{"max_rejects": 1}, {"max_reject_share": 0.003}])
def test_over_the_limit(spark, many, make, tmp_path, limit, probe):
    dockhand.write_files(many.limit(3), make())
    before = names(make().location)
    with pytest.raises(RejectLimitError, match="rejected"):
        dockhand.write_files(many, make(
            write_mode="truncate", rejects_location=f"{tmp_path}/rejects", probe_rows=probe, **limit
        ))
    assert names(make().location) == before and beside(make()) == ["input"]


@pytest.mark.parametrize("limit", [
    {"max_rejects": 2}, {"max_reject_share": 2 / 640}, {"max_rejects": 2, "max_reject_share": 1.0},
])
def test_within_the_limit(many, make, limit):
    assert dockhand.write_files(many, make(**limit)).rows_dirty == 2


def test_hopeless_loads_stop_before_the_whole_input_is_read(spark, make):
    bad = spark.range(0, 50_000, 1, 50).select(F.lit("x").alias("k"), F.col("id").cast("string").alias("w"))
    unreadable = bad.withColumn("w", F.expr("if(w = '40000', raise_error('read too far'), w)"))
    for limit in ({"max_rejects": 10}, {"max_reject_share": 0.5}):
        with pytest.raises(RejectLimitError, match="of the first 500 rows"):
            dockhand.write_files(unreadable, make(probe_rows=500, **limit))
        with pytest.raises(Exception, match="read too far"):
            dockhand.write_files(unreadable, make(probe_rows=0, **limit))
    assert names(make().location) == []


def test_few_first_rows_do_not_stop_a_share(spark, make):
    rows = spark.range(0, 1000, 1, 4).select(
        F.expr("if(id < 5, 'x', CAST(id AS STRING))").alias("k"), F.lit("w").alias("w")
    )
    result = dockhand.write_files(rows, make(max_reject_share=0.01, probe_rows=10))
    assert result.rows_dirty == 5


def test_no_rows_no_rejects(spark, pairs, make):
    assert dockhand.write_files(pairs.limit(0), make(max_rejects=0, max_reject_share=0.0)).rows_read == 0
    with pytest.raises(Exception, match="unreadable row"):
        dockhand.write_files(failing(pairs), make(max_rejects=0))


@pytest.mark.parametrize("wrong", [{"max_rejects": -1}, {"max_reject_share": 1.5}, {"probe_rows": -1}])
def test_limits_that_make_no_sense(make, wrong):
    with pytest.raises(SpecError, match=next(iter(wrong))):
        make(**wrong)
