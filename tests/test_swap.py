"""Partitions that are replaced by one change of the catalog."""

from __future__ import annotations

from pathlib import Path

import pytest

import dockhand
from dockhand import CommitError, ConflictError, SpecError
from dockhand.operators import tables
from dockhand.operators.claims import Control
from dockhand.operators.files import Storage, write_stage
from test_loads import failing, names

PARTITION = [("p", "string", "a b"), ("q", "int", "1")]


@pytest.fixture
def swap(make):
    def spec(**options):
        return make(**{"partition": PARTITION, "write_mode": "truncate", "swap_partition": True, **options})

    return spec


def versions(spec) -> list[str]:
    return names(tables.versions_directory(spec))


@pytest.mark.parametrize("file_format", ["orc", "text"])
def test_no_renames_and_one_version(spark, pairs, swap, monkeypatch, file_format):
    spec = swap(file_format=file_format, delimiter="|")
    moves = []
    monkeypatch.setattr(Storage, "move", lambda self, s, t: moves.append(s))
    first = dockhand.load(pairs, spec)
    assert spark.table(spec.table).count() == 5
    second = dockhand.load(pairs.limit(2), spec)
    assert spark.table(spec.table).filter("p = 'a b' AND q = 1").count() == 2
    assert moves == [] and versions(spec) == [Path(second.directory).name] != [Path(first.directory).name]
    assert second.files == names(second.directory.removeprefix("file:")) and names(spec.location) == []


def test_other_partitions_stay(spark, pairs, swap):
    dockhand.load(pairs, swap())
    dockhand.load(pairs, swap(partition=[("p", "string", "a b"), ("q", "int", "2")], swap_partition=False))
    dockhand.load(pairs.limit(1), swap())
    assert {(r.q, r["count"]) for r in spark.table(swap().table).groupBy("q").count().collect()} == {(1, 1), (2, 5)}


def test_partition_that_was_loaded_by_renames(spark, pairs, swap):
    dockhand.load(pairs, swap(swap_partition=False))
    dockhand.load(pairs.limit(3), swap())
    assert spark.table(swap().table).count() == 3
    assert names(tables.target_directory(swap())) == []
    with pytest.raises(CommitError, match="set swap_partition"):
        dockhand.load(pairs, swap(swap_partition=False))


def test_other_groups_are_not_lost(spark, pairs, swap):
    dockhand.load(pairs, swap(swap_partition=False, file_prefix="other"))
    with pytest.raises(ConflictError, match="not load__"):
        dockhand.load(failing(pairs), swap())
    dockhand.load(pairs, swap(partition=[("p", "string", "z"), ("q", "int", "1")]))
    with pytest.raises(ConflictError, match="not other__"):
        dockhand.load(pairs, swap(partition=[("p", "string", "z"), ("q", "int", "1")], file_prefix="other"))


@pytest.mark.parametrize("first", [True, False])
def test_failed_loads_change_nothing(spark, pairs, swap, monkeypatch, first):
    if not first:
        dockhand.load(pairs, swap())
    before = versions(swap())
    with pytest.raises(Exception, match="unreadable row"):
        dockhand.load(failing(pairs), swap())

    def broken(*a):
        raise RuntimeError("the catalog is away")

    monkeypatch.setattr(tables, "swap_partition", broken)
    with pytest.raises(RuntimeError, match="catalog is away"):
        dockhand.load(pairs.limit(1), swap())
    assert versions(swap()) == before
    assert tables.table_exists(spark, swap().table) != first
    assert first or spark.table(swap().table).count() == 5


def dead(spark, spec, pairs, run_id):
    """What a run that died after writing leaves: its claim, long expired, and its version."""
    storage = Storage(spark, spec.location)
    stage = f"{tables.versions_directory(spec)}/{run_id}"
    write_stage(pairs, "orc", "none", stage, "load", run_id)
    control = Control(storage, spec.location, tables.target_directory(spec), "load", run_id, stage, 0.0001)
    control.storage.put_new(control._claim_path(1), f'{{"run_id": "{run_id}", "stage": "{stage}", "seconds": 0}}')
    return stage


def test_version_of_a_dead_run_goes(spark, pairs, swap):
    dockhand.load(pairs, swap())
    dead(spark, swap(), pairs, "dead")
    dockhand.load(pairs.limit(1), swap())
    assert len(versions(swap())) == 1 and spark.table(swap().table).count() == 1


def test_run_that_died_after_the_swap(spark, pairs, swap):
    dockhand.load(pairs, swap())
    stage = dead(spark, swap(), pairs.limit(4), "dead")
    tables.swap_partition(spark, Storage(spark, stage), swap(), stage)
    with pytest.raises(Exception, match="unreadable row"):
        dockhand.load(failing(pairs), swap())
    assert spark.table(swap().table).count() == 4
    dockhand.load(pairs.limit(2), swap())
    assert spark.table(swap().table).count() == 2 and len(versions(swap())) == 1


def test_no_rows(spark, pairs, swap):
    dockhand.load(pairs, swap())
    dockhand.load(pairs.limit(0), swap(file_format="orc"))
    assert spark.table(swap().table).count() == 0


@pytest.mark.parametrize("options", [{"partition": ()}, {"write_mode": "append"}])
def test_only_truncates_of_partitions(swap, options):
    with pytest.raises(SpecError, match="swap_partition"):
        swap(**options)


def test_not_without_the_catalog(pairs, swap):
    with pytest.raises(SpecError, match="only load"):
        dockhand.write_files(pairs, swap())
