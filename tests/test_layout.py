"""Bloom filters and order inside files, and mode and owner of new files."""

from __future__ import annotations

import getpass
import stat
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import dockhand
from dockhand import CommitError, LoadSpec, SpecError
from dockhand.operators.files import Storage
from test_loads import beside, names
from test_spec import GOOD


def rows_read(df) -> int:
    """Rows that the scan of a frame hands on, before any filter."""
    df.collect()
    leaves = df._jdf.queryExecution().executedPlan().collectLeaves()
    return leaves.apply(0).metrics().get("numOutputRows").get().value()


@pytest.fixture
def keys(spark):
    """40,000 rows a file, of keys in no order, and even ones only."""
    key = F.col("id") * 7919 % 160_001 * 2
    return spark.range(0, 160_000, 1, 4).select(key.alias("k"), F.sha2(key.cast("string"), 256).alias("w"))


def test_bloom_filters_leave_out_parts_of_files(spark, keys, make):
    one = keys.filter("k % 1009 = 8").first()
    plain, filtered = make(), make(bloom_columns=["k", "w"], location=make().location + "2")
    for spec in (plain, filtered):
        dockhand.write_files(keys, spec)
    for condition in (F.col("k") == one.k, F.col("w") == one.w):
        found = {s.location: spark.read.orc(s.location).filter(condition) for s in (plain, filtered)}
        assert [r.k for df in found.values() for r in df.collect()] == [one.k] * 2
        assert rows_read(found[filtered.location]) <= 20_000 < rows_read(found[plain.location]) == 160_000
    assert rows_read(spark.read.orc(filtered.location).filter("k = 801")) <= 20_000


def test_order_leaves_out_parts_of_files(spark, keys, make):
    spec = make(cluster_by=["k"], target_file_bytes=2_000_000)
    dockhand.write_files(keys, spec)
    near = spark.read.orc(spec.location).filter("k BETWEEN 1000 AND 1010")
    assert sorted(r.k for r in near.collect()) == [1000, 1002, 1004, 1006, 1008, 1010]
    assert rows_read(near) <= 10_000 * len(names(spec.location)) < 160_000


def test_parquet_files_have_filters_too(spark, keys, make):
    spec = make(file_format="parquet", bloom_columns=["w"])
    dockhand.write_files(keys, spec)
    import pyarrow.parquet as pq

    path = Path(spec.location, names(spec.location)[0])
    plain = make(file_format="parquet", file_prefix="plain", location=make().location + "2")
    dockhand.write_files(keys, plain)
    without = Path(plain.location, names(plain.location)[0])
    assert pq.read_metadata(path).num_rows == pq.read_metadata(without).num_rows
    assert path.stat().st_size > without.stat().st_size + 10_000


@pytest.mark.parametrize("options", [
    {"bloom_columns": ["x"]}, {"cluster_by": ["K"]}, {"file_format": "text", "delimiter": "|", "cluster_by": ["a"]},
    {"file_mode": "9"}, {"file_mode": "rwx"}, {"file_mode": "0644"},
])
def test_refused(options):
    with pytest.raises(SpecError):
        LoadSpec(**{**GOOD, **options})


def mode(path) -> str:
    return oct(stat.S_IMODE(Path(path).stat().st_mode))[2:]


def test_mode_of_new_files_only(pairs, make):
    old = dockhand.write_files(pairs, make()).files
    before = mode(Path(make().location, old[0]))
    new = dockhand.write_files(pairs, make(file_mode="640")).files
    assert before != "640" and {mode(Path(make().location, n)) for n in old} == {before}
    assert {mode(Path(make().location, n)) for n in new} == {"640"}


def test_mode_of_a_new_target(pairs, make):
    dockhand.write_files(pairs, make(file_mode="640", file_owner=getpass.getuser()))
    assert mode(make().location) == "750" and {mode(Path(make().location, n)) for n in names(make().location)} == {"640"}


@pytest.mark.parametrize("first", [True, False])
def test_refused_change_fails_the_load(spark, pairs, make, monkeypatch, first):
    if not first:
        dockhand.load(pairs, make())
    before = names(make().location)
    access = Storage.set_access
    monkeypatch.setattr(
        Storage, "set_access", lambda self, path, *a: "-00001-" not in path and access(self, path, *a)
    )
    with pytest.raises(CommitError, match="mode, owner or group of 1 files not set"):
        dockhand.load(pairs.repartition(3), make(file_mode="600", write_mode="truncate", files=3))
    assert names(make().location) == before and beside(make()) == []


def test_unknown_owner(pairs, make):
    with pytest.raises(CommitError, match="mode, owner or group"):
        dockhand.write_files(pairs, make(file_owner="nobody-of-this-name"))
    assert names(make().location) == [] and beside(make()) == []


def test_job_with_mode_and_owner():
    job = {
        "dbName": "db", "tableName": "t", "tableType": "normal", "locationPath": "/t", "fileName": "t",
        "fileType": "orc", "writeMode": "append", "column": [{"name": "a", "type": "int"}],
    }
    spec = LoadSpec.from_job({**job, "ugoMode": "750", "hdfsUsername": "etl", "hdfsGroupname": "data"})
    assert (spec.file_mode, spec.file_owner, spec.file_group) == ("750", "etl", "data")
    assert LoadSpec.from_job(job).file_mode is None
