"""Queries over loads that die, loads at the same time, and what the next load makes of it."""

from __future__ import annotations

import threading
import time

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import dockhand
from dockhand.operators import tables
from dockhand.operators.claims import Control, claimed
from dockhand.operators.files import Storage, new_run_id, publish, stage_path, write_stage
from dockhand_queries.common import (
    CUSTOMER_COLUMNS, REGISTRY, Target, make_spec, new_target, table,
)

# How long the dead runs of these queries are waited for.
SECONDS = 0.2


class DyingStorage(Storage):
    """A driver that dies after so many changes to the file system: none happens any more."""

    def __init__(self, spark: SparkSession, path: str, changes: int) -> None:
        super().__init__(spark, path)
        self.left = changes
        self._lock = threading.Lock()

    def _change(self) -> None:
        with self._lock:
            if self.left <= 0:
                raise OSError("the driver is gone")
            self.left -= 1

    def move(self, source: str, target: str) -> bool:
        self._change()
        return super().move(source, target)

    def put_new(self, path: str, text: str) -> bool:
        self._change()
        return super().put_new(path, text)

    def _delete(self, path: str) -> bool:
        self._change()
        return super()._delete(path)

    def touch(self, path: str) -> None:
        raise OSError("the driver is gone")

    def remove_if_empty(self, path: str) -> None:
        self._change()
        super().remove_if_empty(path)


def dying_publication(
    spark: SparkSession, rows: DataFrame, target: Target, mode: str, changes: int
) -> None:
    """Write two files and publish them, dying after so many changes."""
    run_id = new_run_id()
    stage = stage_path(target.location, run_id)
    write_stage(rows.repartition(2), "orc", "none", stage, "load", run_id)
    storage = DyingStorage(spark, target.location, changes)
    control = Control(storage, target.location, target.location, "load", run_id, stage, SECONDS)
    try:
        with claimed(control):
            publish(storage, stage, target.location, "load", mode, control)
            storage.delete(stage)
            control.close()
    except Exception:
        pass


# Changes of a truncate with two old and two new files, in order: the claim, the journal, two
# moves, two deletes, the stage, two to close the journal, two to give the claim back.
_STEPS = 11


@REGISTRY.add(
    "publish_recovers",
    "SELECT CAST(step AS INT) AS step, CASE WHEN step < 2 THEN 'nothing' WHEN step < 9 THEN 'forward'"
    " ELSE 'nothing' END AS recovered, CASE WHEN step < 2 THEN customers ELSE 0 END AS old_rows,"
    " CASE WHEN step < 2 THEN 0 ELSE customers END AS new_rows, 0 AS left_beside"
    f" FROM range(0, {_STEPS}) AS s(step), (SELECT count(*) AS customers FROM customer)",
)
def publish_recovers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A truncate that dies after each single change, then what a recovery makes of it."""
    old = table(spark, sf_dir, "customer").withColumn("c_mktsegment", F.lit("old"))
    new = old.withColumn("c_mktsegment", F.lit("new"))
    report = []
    for step in range(_STEPS):
        target = new_target(spark, "dies")
        spec = make_spec(target, CUSTOMER_COLUMNS, files=2, claim_seconds=SECONDS)
        dockhand.write_files(old, spec)
        dying_publication(spark, new, target, "truncate", step)
        time.sleep(1.5 * SECONDS)
        recovered = dockhand.recover(spark, spec) or "nothing"
        found = {r[0]: r[1] for r in spark.read.orc(target.location).groupBy("c_mktsegment").count().collect()}
        parent, name = target.location.rsplit("/", 1)
        # A run that dies before it claims anything leaves a stage that nobody knows of.
        beside = [n for n in Storage(spark, parent).names(parent) if n != name and step]
        report.append((step, recovered, found.get("old", 0), found.get("new", 0), len(beside)))
    return spark.createDataFrame(
        report, "step int, recovered string, old_rows bigint, new_rows bigint, left_beside int"
    )


def _outcome(load) -> str:
    try:
        load()
        return "loaded"
    except dockhand.ConflictError:
        return "conflict"


@REGISTRY.add(
    "group_claims",
    "SELECT attempt, outcome, times * (SELECT count(*) FROM customer) AS table_rows FROM (VALUES"
    " ('same group, claimed', 'conflict', 0), ('other group, claimed', 'loaded', 1),"
    " ('same group, claim expired', 'loaded', 2), ('the slow run, then', 'conflict', 2),"
    " ('same group, claim given back', 'loaded', 3)) AS a(attempt, outcome, times)",
)
def group_claims(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads of a table while another run holds one of its groups, and after it has been away."""
    customer = table(spark, sf_dir, "customer")
    target = new_target(spark, "claims")
    run_id = new_run_id()
    storage = Storage(spark, target.location)
    stage = stage_path(target.location, run_id)
    write_stage(customer, "orc", "none", stage, "load", run_id)
    slow = Control(storage, target.location, target.location, "load", run_id, stage, SECONDS)
    report = []

    def attempt(name: str, load) -> None:
        outcome = _outcome(load)
        there = tables.table_exists(spark, target.table)
        report.append((name, outcome, spark.table(target.table).count() if there else 0))

    def of(prefix: str):
        return lambda: dockhand.load(customer, make_spec(target, CUSTOMER_COLUMNS, file_prefix=prefix))

    slow.take()
    attempt("same group, claimed", of("load"))
    attempt("other group, claimed", of("other"))
    slow.pause()
    time.sleep(1.5 * SECONDS)
    attempt("same group, claim expired", of("load"))
    attempt("the slow run, then", lambda: publish(storage, stage, target.location, "load", "append", slow))
    attempt("same group, claim given back", of("load"))
    return spark.createDataFrame(report, "attempt string, outcome string, table_rows bigint")
