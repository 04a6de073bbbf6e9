"""One load from a DataFrame to table rows."""

from __future__ import annotations

import math
from dataclasses import dataclass
from functools import cached_property
from typing import Any

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from dockhand.errors import CommitError, RejectLimitError, SpecError
from dockhand.functions.sql import sql_any
from dockhand.operators import tables
from dockhand.operators.claims import Control, claimed, live_runs, tidy
from dockhand.operators.convert import (
    BAD, check_input, clean_rows, convert, dirty_rows, fallible, knows_files, summarize, with_rejects,
)
from dockhand.operators.files import (
    Layout, Storage, check_target, fit_files, grant, new_run_id, publish, stage_path, write_stage,
)
from dockhand.operators.text import hazards, render_lines
from dockhand.plans.spec import LoadSpec


# The chance that a load within its share of rejects is stopped early.
DOUBT = 1e-9


@dataclass(frozen=True)
class LoadResult:
    """What a load did; counts were taken while the rows were written.

    ``recovered`` tells what became of a dead load found there, see :func:`recover`.
    """

    spec: LoadSpec
    directory: str
    files: list[str]
    rows_read: int
    rows_dirty: int
    source: DataFrame
    rejects: str | None = None
    recovered: str | None = None
    reject_files: bytes | None = None

    @property
    def rows_written(self) -> int:
        return self.rows_read - self.rows_dirty

    @cached_property
    def dirty(self) -> DataFrame:
        """The rejected rows, as many as were counted.

        They are those the load left at its ``rejects_location``.  Without one the input is
        read again, once, and kept in the session's cache; of an input that is files, only
        those that had rejected rows.  An input that no longer gives them, because the load
        replaced it or it changes, is an error.
        """
        if not self.rows_dirty:
            return dirty_rows(self.source, self.spec.output_schema).limit(0)
        if self.rejects:
            return self.source.sparkSession.read.parquet(self.rejects)
        source = with_rejects(self.source, self.reject_files)
        rejected = dirty_rows(source, self.spec.output_schema).persist()
        _check_rejected(rejected.count(), self.rows_dirty)
        return rejected

    @cached_property
    def dirty_by_column(self) -> DataFrame:
        """Rejected rows per first failing column, read like :attr:`dirty`."""
        return summarize(self.dirty)


def _check_rejected(found: int, counted: int) -> None:
    if found != counted:
        raise CommitError(
            f"{counted} rows were rejected, but the input now gives {found};"
            " set rejects_location to keep them"
        )


def load(df: DataFrame, spec: LoadSpec) -> LoadResult:
    """Convert, write, put in place and register in the catalog.

    The files ``<prefix>__*`` of the target are claimed for the load, and what a dead load
    left half done there is finished or undone first.  Input, target and write mode are
    checked before any data is read.  Until the files are moved at the very end, the target
    is as it was.  A table that is missing is created once the rows are written, and goes
    again if they cannot be put in place, unless another load uses it by then.
    """
    spark = df.sparkSession
    check_input(df, spec.output_schema)
    spec = tables.normalize_partition(spark, spec)
    control = _control(spark, spec)
    storage = control.storage
    with claimed(control):
        check_target(storage, spec.location, spec.file_prefix, "append")
        missing = not tables.table_exists(spark, spec.table)
        if not missing:
            at_work = tables.made_by(spark, spec) in live_runs(storage, spec.location)
            tables.check_table(spark, storage, spec, must_be_there=not at_work)
            if spec.partition:
                tables.check_partition_location(spark, storage, spec)
        if spec.swap_partition:
            return _load_swapped(df, spec, control, missing)
        return _load_files(df, spec, control, register=True, create=missing)


def write_files(df: DataFrame, spec: LoadSpec) -> LoadResult:
    """:func:`load` without the catalog: only the files of the target directory."""
    check_input(df, spec.output_schema)
    if spec.swap_partition:
        raise SpecError("a partition is swapped in the catalog, which only load knows of")
    spec = tables.normalize_partition(df.sparkSession, spec)
    control = _control(df.sparkSession, spec)
    with claimed(control):
        return _load_files(df, spec, control)


def recover(spark: SparkSession, spec: LoadSpec) -> str | None:
    """Finish or undo what a dead load of this spec left, without loading anything.

    ``forward`` when the rows of that load are now in place, ``back`` when the target is as
    before it, nothing when there was nothing to do.  Every load does this by itself.  A
    load that still holds its claim is a :class:`ConflictError`.
    """
    spec = tables.normalize_partition(spark, spec)
    with claimed(_control(spark, spec)) as control:
        if control.recovered == "forward" and tables.table_exists(spark, spec.table):
            tables.register_load(spark, spec)
        return control.recovered


def _control(spark: SparkSession, spec: LoadSpec) -> Control:
    run_id = new_run_id()
    directory = tables.target_directory(spec)
    storage = Storage(spark, directory)
    stage = stage_path(spec.staging_path or spec.location, run_id)
    if storage.root(stage) != storage.root(directory):
        raise SpecError(
            f"staging_path is on {storage.root(stage)}, the target on {storage.root(directory)}"
        )
    if spec.swap_partition:
        stage = f"{tables.versions_directory(spec)}/{run_id}"

    def in_use(path: str) -> bool:
        if not spec.swap_partition or not tables.table_exists(spark, spec.table):
            return False
        current = tables.partition_location(spark, spec)
        return bool(current) and storage.qualified(current) == storage.qualified(path)

    return Control(
        storage, spec.location, directory, spec.file_prefix, run_id, stage, spec.claim_seconds, in_use
    )


def _load_files(
    df: DataFrame, spec: LoadSpec, control: Control, register: bool = False, create: bool = False
) -> LoadResult:
    spark, storage, directory = df.sparkSession, control.storage, control.target
    check_target(storage, directory, spec.file_prefix, spec.write_mode)
    rejects, created = _rejects_path(spec, control), False
    _stop_early(df, spec)
    try:
        counts = _write_all(df, spec, control, rejects)
        created = create and _create(spark, spec, control)
        files = publish(
            storage, control.stage, directory, spec.file_prefix, spec.write_mode, control
        )
    except BaseException:
        tidy(lambda: created and tables.drop_own_table(spark, storage, spec, control.run_id))
        tidy(lambda: rejects and Storage(spark, rejects).delete(rejects))
        tidy(lambda: control.is_open() or storage.delete(control.stage))
        raise
    tidy(lambda: storage.delete(control.stage))
    if register:
        tables.register_load(spark, spec)
    control.close()
    return _result(df, spec, control, directory, files, counts, rejects)


def _load_swapped(df: DataFrame, spec: LoadSpec, control: Control, create: bool) -> LoadResult:
    """:func:`load` into a fresh directory, which one statement makes the partition's.

    The statement is the only step that a reader can see: before it the catalog names the
    old directory, after it the new one, whole.  Old files go last; a driver that dies before
    leaves them to the next swap of the partition.
    """
    spark, storage, fresh = df.sparkSession, control.storage, control.stage
    before = None if create else tables.partition_location(spark, spec)
    tables.check_swap(storage, before or control.target, spec.file_prefix)
    rejects, created = _rejects_path(spec, control), False
    _stop_early(df, spec)
    try:
        counts = _write_all(df, spec, control, rejects)
        staged = storage.entries(fresh)
        files = sorted(e.name for e in staged if e.length and not e.is_directory)
        storage.delete_all(fresh, sorted({e.name for e in staged} - set(files)))
        created = create and _create(spark, spec, control)
        tables.check_swap(storage, before or control.target, spec.file_prefix)
        tables.swap_partition(spark, storage, spec, fresh)
    except BaseException:
        if not control.in_use(fresh):
            tidy(lambda: storage.delete(fresh))
            tidy(lambda: rejects and Storage(spark, rejects).delete(rejects))
            tidy(lambda: created and tables.drop_own_table(spark, storage, spec, control.run_id))
        raise
    tidy(lambda: tables.drop_versions(storage, spec, fresh, live_runs(storage, spec.location)))
    return _result(df, spec, control, fresh, files, counts, rejects)


def _rejects_path(spec: LoadSpec, control: Control) -> str | None:
    return spec.rejects_location and f"{spec.rejects_location}/{spec.file_prefix}__{control.run_id}"


def _write_all(df: DataFrame, spec: LoadSpec, control: Control, rejects: str | None) -> dict[str, Any]:
    """Stage the converted rows and keep the rejected ones; the target is not touched."""
    counts = _write(df.sparkSession, df, spec, control.stage, control.run_id)
    _check_limit(spec, counts["rows"], counts["dirty"])
    if counts["dirty"] and rejects:
        _keep_rejected(with_rejects(df, counts.get("files")), spec, rejects, counts["dirty"])
    control.check()
    return counts


def _create(spark: SparkSession, spec: LoadSpec, control: Control) -> bool:
    """Create the table; one that another load has made since must be as described."""
    created = tables.create_table(spark, spec, control.run_id)
    if not created:
        tables.check_table(spark, control.storage, spec, must_be_there=False)
    return created


def _result(
    df: DataFrame, spec: LoadSpec, control: Control, directory: str, files: list[str],
    counts: dict[str, Any], rejects: str | None,
) -> LoadResult:
    return LoadResult(
        spec=spec,
        directory=directory,
        files=files,
        rows_read=counts["rows"],
        rows_dirty=counts["dirty"],
        source=df,
        rejects=rejects if counts["dirty"] else None,
        recovered=control.recovered,
        reject_files=counts.get("files"),
    )


def _check_limit(spec: LoadSpec, rows: int, dirty: int) -> None:
    """Raise when more rows were rejected than the description allows."""
    if spec.max_rejects is not None and dirty > spec.max_rejects:
        raise RejectLimitError(f"{dirty} rows were rejected, {spec.max_rejects} are allowed")
    if spec.max_reject_share is not None and dirty > spec.max_reject_share * rows:
        raise RejectLimitError(
            f"{dirty} of {rows} rows were rejected, a share of {spec.max_reject_share} is allowed"
        )


def _stop_early(df: DataFrame, spec: LoadSpec) -> None:
    """Raise when the first rows already tell that the load goes over its limit.

    ``probe_rows`` of the first input partitions are converted and not written.  More rejects
    among them than are allowed in all are more in all.  A share is over the limit when the
    rows, taken as drawn from the input, would show as many only once in ``1 / DOUBT`` loads
    of the allowed share (Hoeffding's bound); inputs whose first rows are unlike the others
    set ``probe_rows=0``.
    """
    limits = spec.max_rejects, spec.max_reject_share
    if limits == (None, None) or not spec.probe_rows or not fallible(df, spec.output_schema):
        return
    first = convert(df.limit(spec.probe_rows), spec.output_schema)
    seen = first.agg(F.count(F.lit(1)).alias("rows"), F.count(BAD).alias("dirty")).first()
    rows, dirty = seen["rows"], seen["dirty"]
    if spec.max_rejects is not None and dirty > spec.max_rejects:
        raise RejectLimitError(
            f"{dirty} of the first {rows} rows are rejected, {spec.max_rejects} are allowed in all"
        )
    if spec.max_reject_share is not None and rows:
        sure = dirty / rows - math.sqrt(math.log(1 / DOUBT) / (2 * rows))
        if sure > spec.max_reject_share:
            raise RejectLimitError(
                f"{dirty} of the first {rows} rows are rejected, a share of {spec.max_reject_share} is allowed"
            )


def _keep_rejected(df: DataFrame, spec: LoadSpec, path: str, counted: int) -> None:
    """Write the rejected rows while the input is still there, all of them or none."""
    seen = Observation()
    rejected = dirty_rows(df, spec.output_schema).observe(seen, F.count(F.lit(1)).alias("rows"))
    rejected.write.mode("errorifexists").parquet(path)
    if seen.get["rows"] != counted:
        tidy(lambda: Storage(df.sparkSession, path).delete(path))
    _check_rejected(seen.get["rows"], counted)


def output_rows(df: DataFrame, spec: LoadSpec, observation: Observation) -> DataFrame:
    """The rows of a load as the file writer gets them, counted on the way."""
    may_reject = bool(fallible(df, spec.output_schema))
    return clean_rows(
        df, spec.output_schema, observation, spec.files, with_file=may_reject and knows_files(df)
    )


def _write(
    spark: SparkSession, df: DataFrame, spec: LoadSpec, stage: str, run_id: str
) -> dict[str, Any]:
    counts, unsafe = Observation(), Observation()
    rows = output_rows(df, spec, counts)
    if spec.file_format == "text":
        if spec.fail_on_hazards:
            condition = sql_any(list(hazards(spec.output_schema, spec.delimiter, spec.null_value)))
            rows = rows.observe(unsafe, F.expr(f"count_if({condition})").alias("rows"))
        rows = render_lines(rows, spec.delimiter, spec.null_value)
    made = (spec.file_format, spec.compression, stage, spec.file_prefix, run_id)
    layout = Layout(spec.bloom_columns, spec.cluster_by)
    write_stage(rows, *made, layout)
    if spec.file_format == "text" and spec.fail_on_hazards and unsafe.get["rows"]:
        raise CommitError(
            f"{unsafe.get['rows']} rows hold the delimiter, a line break or the text of null"
            " and would not read back"
        )
    if spec.target_file_bytes:
        fit_files(spark, Storage(spark, stage), rows.schema, *made, spec.target_file_bytes, layout)
    grant(Storage(spark, stage), stage, spec.file_mode, spec.file_owner, spec.file_group)
    return counts.get
