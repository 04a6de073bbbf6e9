"""Writing, putting in place, and tables."""

from __future__ import annotations

import re
import tempfile
from pathlib import Path

import pytest
from pyspark.sql import functions as F

import dockhand
from dockhand import CommitError, ConflictError, SpecError
from dockhand.operators import files, tables
from dockhand.operators.convert import DIRTY_COLUMNS
from dockhand.operators.files import Storage
from dockhand.plans.workspace import shared_folder
from dockhand.sources.files import entries


def names(folder) -> list[str]:
    path = Path(folder)
    return sorted(p.name for p in path.iterdir() if not p.name.endswith(".crc")) if path.exists() else []


def beside(spec) -> list[str]:
    """What lies next to the target: nothing but the target, unless a stage was left."""
    return [n for n in names(Path(spec.location).parent) if n != Path(spec.location).name]


def rows(df) -> list[tuple]:
    return sorted(map(tuple, df.collect()), key=repr)


def failing(df):
    """The same rows, but reading one of them fails."""
    return df.select("k", F.expr("if(k = 3, raise_error('unreadable row'), w)").alias("w"))


# Files


@pytest.mark.parametrize("file_format,compression,suffix", [
    ("text", "none", ".txt"), ("text", "gzip", ".txt.gz"), ("text", "bzip2", ".txt.bz2"),
    ("orc", "none", ".orc"), ("orc", "snappy", ".snappy.orc"),
    ("parquet", "none", ".parquet"), ("parquet", "gzip", ".gz.parquet"),
    ("parquet", "snappy", ".snappy.parquet"),
])
def test_file_names(pairs, make, file_format, compression, suffix):
    spec = make(file_format=file_format, compression=compression, delimiter="\t", files=2)
    result = dockhand.write_files(pairs, spec)
    assert names(spec.location) == result.files
    assert len(result.files) == 2
    for name in result.files:
        assert re.fullmatch(r"load__[0-9a-f]{32}-[0-9a-f-]+-c000" + re.escape(suffix), name)
    assert beside(spec) == []


def test_counts(spark, make):
    df = spark.createDataFrame([("1", "a"), ("x", "b"), (None, None), ("3 ", "d")], "k string, w string")
    result = dockhand.write_files(df, make())
    assert (result.rows_read, result.rows_written, result.rows_dirty) == (4, 2, 2)
    assert {r.bad_value for r in result.dirty.collect()} == {"x", "3 "}
    assert [(r.bad_column, r.dirty_rows) for r in result.dirty_by_column.collect()] == [("k", 2)]


def test_counts_after_a_shuffle(spark, orders, make):
    columns = [(c, "string") for c in orders.columns]
    result = dockhand.write_files(orders, make(columns=columns, files=3))
    assert result.rows_read == result.rows_written == orders.count()
    assert len(result.files) == 3


def test_no_rejected_rows_no_second_read(spark, orders, make):
    result = dockhand.write_files(orders.select("o_orderkey", "o_orderstatus"), make())
    assert result.rows_dirty == 0 and result.rows_written > 0
    rejected = result.dirty._jdf.queryExecution().optimizedPlan().toString()
    assert "LocalRelation <empty>" in rejected and "parquet" not in rejected


@pytest.fixture
def mixed(spark):
    return spark.createDataFrame([("1", "one"), ("x", "two"), ("3", "three")], "k string, w string")


@pytest.mark.parametrize("kept", [True, False])
def test_rejected_rows_after_their_input_is_replaced(spark, mixed, make, tmp_path, kept):
    first = make(columns=[("k", "string"), ("w", "string")])
    dockhand.write_files(mixed, first)
    rejects = f"{tmp_path}/rejects" if kept else None
    result = dockhand.write_files(
        spark.read.orc(first.location), make(write_mode="truncate", rejects_location=rejects)
    )
    assert (result.rows_read, result.rows_dirty) == (3, 1)
    if not kept:
        with pytest.raises(Exception, match="does not exist"):
            result.dirty
        return
    assert [(r.k, r.bad_column, r.bad_value) for r in result.dirty.collect()] == [("x", "k", "x")]
    assert [(r.bad_column, r.dirty_rows) for r in result.dirty_by_column.collect()] == [("k", 1)]
    assert result.rejects.startswith(rejects + "/load__")


def test_rejected_rows_are_as_many_as_were_counted(mixed, make, monkeypatch):
    result = dockhand.write_files(mixed, make())
    fewer = type(result)(**{**result.__dict__, "rows_dirty": 2})
    with pytest.raises(CommitError, match="2 rows were rejected, but the input now gives 1"):
        fewer.dirty
    assert result.dirty.count() == 1


def test_clean_loads_leave_no_rejects(pairs, make, tmp_path):
    result = dockhand.write_files(pairs, make(rejects_location=f"{tmp_path}/rejects"))
    assert result.rejects is None and not Path(tmp_path, "rejects").exists()


def test_rejected_rows_of_a_table_of_rejected_rows(spark, mixed):
    schema = dockhand.schema_from_columns([("k", "int"), ("w", "string")])
    rejects = dockhand.dirty_rows(mixed, schema)
    columns = [(f"c{i}", "int" if i < 2 else "string") for i in range(len(rejects.columns))]
    again = dockhand.dirty_rows(rejects, dockhand.schema_from_columns(columns))
    assert again.columns == [
        "k", "w", *[f"input_{c}" for c in DIRTY_COLUMNS], *DIRTY_COLUMNS
    ]
    row = again.first()
    assert (row.k, row.input_bad_column, row.bad_column, row.bad_value) == ("x", "k", "c0", "x")
    assert row.message == "column c0: value [x] is not a int"
    summary = dockhand.dirty_summary(rejects, dockhand.schema_from_columns(columns))
    assert [(r.bad_column, r.dirty_rows) for r in summary.collect()] == [("c0", 1)]


def test_free_names(spark):
    df = spark.createDataFrame([("x", 1, 2)], "Message string, input_message int, bad_type int")
    schema = dockhand.schema_from_columns([("a", "int"), ("b", "int"), ("c", "int")])
    assert dockhand.dirty_rows(df, schema).columns[:3] == [
        "input_input_Message", "input_message", "input_bad_type"
    ]


def test_append_keeps_everything(spark, pairs, make):
    first = dockhand.write_files(pairs, make()).files
    second = dockhand.write_files(pairs, make()).files
    assert not set(first) & set(second)
    assert names(make().location) == sorted(first + second)
    assert spark.read.orc(make().location).count() == 10


def test_truncate_replaces_its_own_group_only(pairs, make):
    spec = make()
    for prefix in ("a", "ab", "b"):
        dockhand.write_files(pairs, make(file_prefix=prefix))
    Path(spec.location, "a_other").write_text("foreign")
    before = names(spec.location)
    new = dockhand.write_files(pairs, make(file_prefix="a", write_mode="truncate")).files
    assert names(spec.location) == sorted([n for n in before if not n.startswith("a__")] + new)


def test_nonconflict_is_noticed_before_anything_is_read(pairs, make):
    dockhand.write_files(pairs, make())
    before = names(make().location)
    with pytest.raises(ConflictError):
        dockhand.write_files(failing(pairs), make(write_mode="nonconflict"))
    dockhand.write_files(pairs, make(write_mode="nonconflict", file_prefix="other"))
    assert set(before) < set(names(make().location))
    assert beside(make()) == []


@pytest.mark.parametrize("mode", ["append", "truncate"])
def test_failed_write_leaves_the_target_alone(pairs, make, mode):
    dockhand.write_files(pairs, make())
    before = names(make().location)
    with pytest.raises(Exception, match="unreadable row"):
        dockhand.write_files(failing(pairs), make(write_mode=mode))
    assert names(make().location) == before
    assert beside(make()) == []


def test_failed_first_write_leaves_nothing(pairs, make):
    with pytest.raises(Exception, match="unreadable row"):
        dockhand.write_files(failing(pairs), make())
    assert names(make().location) == []
    assert beside(make()) == []


def test_failed_move_is_undone(pairs, make, monkeypatch):
    dockhand.write_files(pairs, make(write_mode="truncate"))
    before = names(make().location)
    move = Storage.move
    monkeypatch.setattr(Storage, "move", lambda self, s, t: "-00001-" not in s and move(self, s, t))
    with pytest.raises(CommitError, match="1 of 3 files"):
        dockhand.write_files(pairs.repartition(3), make(write_mode="truncate", files=3))
    assert names(make().location) == before
    assert beside(make()) == []


def test_new_target_appears_by_one_rename(pairs, make, monkeypatch):
    moves = []
    move = Storage.move
    monkeypatch.setattr(Storage, "move", lambda self, s, t: moves.append(t) or move(self, s, t))
    dockhand.write_files(pairs, make(files=3))
    assert moves == [make().location]
    dockhand.write_files(pairs, make(files=3))
    assert len(moves) == 4


def test_target_made_by_another_load_meanwhile(spark, pairs, make, monkeypatch):
    spec = make()
    dockhand.write_files(pairs, spec)
    exists = Storage.exists
    unseen = iter([True])

    def late(self, path):
        return exists(self, path) and not (path == spec.location and next(unseen, False))

    storage = Storage(spark, spec.location)
    stage = files.stage_path(spec.location, "late")
    files.write_stage(pairs.select("k", "w"), "orc", "none", stage, "load", "late")
    staged = [n for n in names(stage)]
    monkeypatch.setattr(Storage, "exists", late)
    monkeypatch.setattr(files, "check_target", lambda *a: None)
    files.publish(storage, stage, spec.location, "load", "append")
    monkeypatch.undo()
    assert set(staged) < set(names(spec.location))
    assert not any(Path(spec.location, n).is_dir() for n in names(spec.location))
    assert spark.read.orc(spec.location).count() == 10


def test_files_without_content_are_dropped(spark, make):
    df = spark.createDataFrame([], "k bigint, w string")
    result = dockhand.write_files(df, make(file_format="text", delimiter="\t"))
    assert result.files == []
    assert names(make().location) == []
    assert dockhand.write_files(df, make()).files != []


def test_target_must_be_a_directory(pairs, make):
    Path(make().location).write_text("a file")
    with pytest.raises(CommitError, match="not a directory"):
        dockhand.write_files(pairs, make())


def test_staging_path(pairs, make, tmp_path, monkeypatch):
    stages = []
    publish = files.publish
    monkeypatch.setattr(
        "dockhand.plans.load.publish", lambda st, stage, *a: stages.append(stage) or publish(st, stage, *a)
    )
    dockhand.write_files(pairs, make(staging_path=f"{tmp_path}/stages/s"))
    assert re.fullmatch(rf"{tmp_path}/stages/s__[0-9a-f]{{32}}", stages[0])
    assert names(tmp_path / "stages") == []


def test_names(spark, pairs, make):
    for prefix in ("a", "ab"):
        dockhand.write_files(pairs, make(file_prefix=prefix, files=2))
    Path(make().location, "a__x, y").write_text("")
    storage = Storage(spark, make().location)
    assert sorted(storage.names(make().location)) == names(make().location)
    assert sorted(storage.names(make().location, "a")) == [
        n for n in names(make().location) if n.startswith("a__")
    ]
    assert storage.names(make().location, "b") == storage.names(make().location + "/none") == []


@pytest.mark.parametrize("first", [True, False])
def test_files_without_content_next_to_others(spark, pairs, make, first):
    spec = make(location=make().location + "/odd {x} [y]")
    if not first:
        dockhand.write_files(pairs, spec)
    storage = Storage(spark, spec.location)
    stage = files.stage_path(spec.location, "run")
    files.write_stage(pairs, "orc", "none", stage, "load", "run")
    Path(stage, "load__run-empty").write_text("")
    published = files.publish(storage, stage, spec.location, "load", "truncate")
    assert published == names(spec.location)
    assert published and "load__run-empty" not in published


@pytest.mark.parametrize("mode,kept", [("truncate", False), ("append", True)])
def test_empty_files_belong_to_their_group(pairs, make, mode, kept):
    dockhand.write_files(pairs, make())
    Path(make().location, "load__empty").write_text("")
    with pytest.raises(ConflictError):
        dockhand.write_files(pairs, make(write_mode="nonconflict"))
    dockhand.write_files(pairs, make(write_mode=mode))
    assert ("load__empty" in names(make().location)) == kept


@pytest.mark.parametrize("count", [10, 250])
@pytest.mark.parametrize("odd", ["directory", "empty", "hidden", "none"])
@pytest.mark.parametrize("mode", ["append", "nonconflict", "truncate"])
def test_modes_do_not_depend_on_the_number_of_files(pairs, make, count, odd, mode):
    target = Path(make().location)
    target.mkdir()
    for i in range(count):
        (target / f"other__{i}").write_text("x")
    if odd == "directory":
        (target / "load__d").mkdir()
        (target / "load__d" / "inside").write_text("x")
    elif odd != "none":
        (target / {"empty": "load__e", "hidden": ".load__h"}[odd]).write_text("")
    before = names(target)
    group = odd in ("directory", "empty")
    if (mode == "nonconflict" and group) or (mode == "truncate" and odd == "directory"):
        with pytest.raises(ConflictError, match="load__"):
            dockhand.write_files(pairs, make(write_mode=mode))
        assert names(target) == before and beside(make()) == []
        return
    new = dockhand.write_files(pairs, make(write_mode=mode)).files
    gone = {"load__e"} if mode == "truncate" and odd == "empty" else set()
    assert names(target) == sorted({*before, *new} - gone)
    if odd == "directory":
        assert names(target / "load__d") == ["inside"]


@pytest.mark.parametrize("count", [0, 3, 300])
def test_entries(spark, tmp_path, count):
    for name in ("a__x, y", "a__{b} \\ [c]", "a__é;,; isDirectory=true; length=9; modification_time=1;"):
        Path(tmp_path, name).write_text("four")
    for i in range(count):
        Path(tmp_path, f"a__{i}").write_text("x" * i)
    Path(tmp_path, ".hidden").write_text("")
    Path(tmp_path, "a__dir").mkdir()
    found = entries(spark, str(tmp_path))
    hidden = [p for p in tmp_path.iterdir()]
    assert sorted((e.name, e.is_directory, 0 if e.is_directory else e.length) for e in found) == sorted(
        (p.name, p.is_dir(), 0 if p.is_dir() else p.stat().st_size) for p in hidden
    )
    assert {e.name for e in entries(spark, str(tmp_path), "a")} == {e.name for e in found} - {".hidden"}
    assert entries(spark, f"{tmp_path}/none") == []


def test_statuses_that_print_otherwise(spark, tmp_path, monkeypatch):
    Path(tmp_path, "a__1").write_text("x")
    want = entries(spark, str(tmp_path))
    monkeypatch.setattr("dockhand.sources.files._printed", lambda *a: [])
    assert entries(spark, str(tmp_path)) == want


def test_file_listing(spark, pairs, make):
    dockhand.write_files(pairs, make(file_prefix="a", files=2))
    dockhand.write_files(pairs, make(file_prefix="b"))
    target = Path(make().location)
    (target / "a__empty").write_text("")
    (target / "_hidden").write_text("x")
    (target / "p=1").mkdir()
    (target / "p=1" / "a__below").write_text("x")
    flat = {r.file_name: r.length for r in dockhand.list_files(spark, make().location).collect()}
    assert flat == {n: (target / n).stat().st_size for n in names(target) if (target / n).is_file()}
    everything = dockhand.list_files(spark, make().location, recursive=True).collect()
    assert sorted(r.file_name for r in everything) == sorted([*flat, "a__below"])
    assert all(r.path == f"file:{target}/{r.file_name}" for r in everything if r.file_name in flat)
    group = dockhand.list_group(spark, make().location, "a").collect()
    assert sorted(r.length > 0 for r in group) == [False, True, True]
    assert all(r.file_name.startswith("a__") for r in group)


def test_refused_delete_names_the_files(pairs, make, monkeypatch):
    old = dockhand.write_files(pairs, make()).files
    delete = Storage._delete
    monkeypatch.setattr(
        Storage, "_delete", lambda self, path: not any(n in path for n in old) and delete(self, path)
    )
    with pytest.raises(CommitError, match=f"{len(old)} of {len(old)} files not deleted .*{old[0]}"):
        dockhand.write_files(pairs, make(write_mode="truncate"))


def test_stage_on_another_file_system(spark, pairs, make, monkeypatch):
    monkeypatch.setattr(Storage, "root", lambda self, path: path.split("/")[0])
    with pytest.raises(SpecError, match="staging_path is on other:"):
        dockhand.write_files(failing(pairs), make(staging_path="other://h/x"))


def test_cleaning_up_does_not_hide_the_error(pairs, make, monkeypatch):
    def broken(self, path):
        raise OSError("no cleaning up")

    monkeypatch.setattr(Storage, "delete", broken)
    with pytest.warns(UserWarning, match="no cleaning up"), pytest.raises(Exception, match="unreadable row"):
        dockhand.write_files(failing(pairs), make())


# Text


@pytest.mark.parametrize("delimiter", ["\t", "|", ".", "\\", "^", "$", "*", "'", "\x01", ",", " ", "é"])
def test_delimiters(spark, make, delimiter):
    df = spark.createDataFrame([(1, "one", None), (None, "", "x")], "k int, w string, z string")
    columns = [("k", "int"), ("w", "string"), ("z", "char")]
    spec = make(file_format="text", delimiter=delimiter, columns=columns)
    dockhand.load(df, spec)
    want = rows(spark.createDataFrame([(1, "one", ""), (None, "", "x")], "k int, w string, z string"))
    assert rows(dockhand.read_text(spark, spec.location, spec.output_schema, delimiter)) == want
    assert rows(spark.table(spec.table)) == want


def test_null_marker_keeps_nulls(spark, pairs, make):
    spec = make(file_format="text", delimiter="\t", null_value="\\N")
    dockhand.load(pairs, spec)
    assert rows(spark.table(spec.table)) == rows(pairs)


def test_line(spark):
    df = spark.sql(
        "SELECT 1Y AS a, CAST(1.5 AS FLOAT) AS b, 1e10D AS c, true AS d, date'2022-01-03' AS e,"
        " timestamp'2022-01-03 00:00:00' AS f, timestamp'2022-01-03 10:11:12.120' AS g,"
        " CAST(NULL AS INT) AS h, 'x' AS i"
    )
    assert dockhand.render_lines(df, "|").first()[0] == (
        "1|1.5|1.0E10|true|2022-01-03|2022-01-03 00:00:00.0|2022-01-03 10:11:12.12||x"
    )


def test_short_and_foreign_lines(spark):
    lines = spark.createDataFrame([("1",), ("x|y|z|more",), ("",)], "value string")
    schema = dockhand.schema_from_columns([("a", "int"), ("b", "string")])
    assert [tuple(r) for r in dockhand.parse_lines(lines, schema, "|").collect()] == [
        (1, None), (None, "y"), (None, None),
    ]


def test_hazards(spark):
    df = spark.createDataFrame([("a\tb", 1), ("a\nb", 2), ("a\rb", 3), (None, 4)], "w string, k int")
    flagged = dockhand.flag_hazards(df, "\t").orderBy("k").collect()
    assert [(r.has_delimiter, r.has_line_break) for r in flagged] == [
        (True, False), (False, True), (False, True), (False, False),
    ]
    marked = spark.createDataFrame([("\\N", 1), ("", 2), (None, 3)], "w string, k int")
    found = dockhand.flag_hazards(marked, "\t", "\\N").orderBy("k").collect()
    assert [r.has_null_text for r in found] == [True, False, False]
    assert not any(r.has_null_text for r in dockhand.flag_hazards(marked, "\t").collect())
    assert [r.has_null_text for r in dockhand.flag_hazards(marked, "\t", "2").orderBy("k").collect()] == [
        False, True, False,
    ]
    dates = spark.sql("SELECT date'2022-01-03' AS d")
    assert dockhand.flag_hazards(dates, "-").first().has_delimiter
    assert not dockhand.flag_hazards(dates, "|").first().has_delimiter


def test_hazards_can_stop_a_load(spark, make):
    df = spark.createDataFrame([(1, "fine"), (2, "a\tb")], "k bigint, w string")
    spec = make(file_format="text", delimiter="\t", fail_on_hazards=True)
    with pytest.raises(CommitError, match="1 rows"):
        dockhand.write_files(df, spec)
    assert names(spec.location) == [] and beside(spec) == []
    dockhand.write_files(df.filter("k = 1"), spec)
    assert spark.read.text(spec.location).count() == 1
    with pytest.raises(CommitError, match="1 rows"):
        dockhand.write_files(
            df.filter("k = 1"), make(file_format="text", delimiter="\t", null_value="fine", fail_on_hazards=True)
        )


def test_lines_end_in_line_feeds_only(spark, make):
    df = spark.createDataFrame([(1, "a\rb")], "k bigint, w string")
    spec = make(file_format="text", delimiter="\t")
    dockhand.load(df, spec)
    assert rows(spark.table(spec.table)) == [(1, "a\rb")]


# Tables


@pytest.mark.parametrize("file_format", ["text", "orc", "parquet"])
def test_partitions(spark, pairs, make, file_format):
    options = {"file_format": file_format, "delimiter": "\t"}
    for month in ("10", "11"):
        partition = [("year", "string", "20/22"), ("month", "int", month)]
        dockhand.load(pairs, make(partition=partition, **options))
    table = spark.table(make(**options).table)
    assert table.columns == ["k", "w", "year", "month"]
    assert dict(table.dtypes)["month"] == "int"
    assert table.filter("month = 11").count() == 5
    assert names(make().location) == ["year=20%2F22"]
    one = table.filter("year = '20/22' AND month = 11").inputFiles()
    assert one and all("month=11" in f for f in one)


def test_partition_value_must_fit_its_type(pairs, make):
    with pytest.raises(SpecError, match="month"):
        dockhand.load(pairs, make(partition=[("month", "int", "ten")]))


def test_partition_value_is_written_as_its_type_prints_it(spark, pairs, make):
    spec = make(partition=[("day", "date", "2022-01-03"), ("hour", "tinyint", "+07")])
    dockhand.load(pairs, spec)
    assert names(Path(spec.location, "day=2022-01-03")) == ["hour=7"]
    assert spark.table(spec.table).filter("hour = 7").count() == 5


def test_partition_directories_are_named_as_spark_names_them(spark):
    name_of = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.escapePathName
    for code in [*range(1, 0x180), 0x20AC, 0x65E5]:
        assert tables.escape_path_name(f"a{chr(code)}b") == name_of(f"a{chr(code)}b"), code


@pytest.mark.parametrize("empty", [
    lambda df: df.filter(F.lit(False)), lambda df: df.limit(0), lambda df: df.filter("k > 100"),
    lambda df: df.sparkSession.createDataFrame([], df.schema),
])
def test_counts_of_an_empty_load(pairs, make, empty):
    result = dockhand.load(empty(pairs), make())
    assert (result.rows_read, result.rows_written, result.rows_dirty) == (0, 0, 0)
    assert pairs.sparkSession.table(make().table).count() == 0


def test_a_table_can_be_loaded_from_itself(spark, pairs, make):
    dockhand.load(pairs, make())
    again = spark.table(make().table).select(F.col("k") + 1, "w")
    dockhand.load(again, make(write_mode="truncate"))
    assert sorted(r.k for r in spark.table(make().table).collect()) == [2, 3, 4, 5, 6]


def test_empty_load_still_makes_the_partition(spark, pairs, make):
    spec = make(file_format="text", delimiter="\t", partition=[("p", "string", "x")])
    dockhand.load(pairs.limit(0), spec)
    assert [r[0] for r in spark.sql(f"SHOW PARTITIONS {spec.table}__lines").collect()] == ["p=x"]
    assert spark.table(spec.table).count() == 0


def test_table_already_there_but_its_location_is_gone(pairs, make, tmp_path):
    spec = make()
    dockhand.load(pairs, spec)
    Path(spec.location).rename(tmp_path / "elsewhere")
    with pytest.raises(CommitError, match="does not exist"):
        dockhand.load(pairs, spec)


@pytest.mark.parametrize("changed,message", [
    ({"location": "/tmp/dockhand-nowhere"}, "not at"),
    ({"columns": [("k", "bigint"), ("v", "string")]}, "has columns"),
    ({"partition": [("p", "string", "1")]}, "is partitioned by"),
    ({"file_format": "parquet"}, "holds orc files"),
])
def test_table_that_is_something_else(pairs, make, changed, message):
    dockhand.load(pairs, make())
    with pytest.raises(CommitError, match=message):
        dockhand.load(pairs, make(**changed))


@pytest.mark.parametrize("options,changed,message", [
    ({}, {"columns": [("k", "string"), ("w", "string")]}, "column k is bigint, not string"),
    ({}, {"columns": [("k", "bigint"), ("w", "int")]}, "column w is string, not int"),
    ({"partition": [("p", "int", "1")]}, {"partition": [("p", "string", "1")]}, "column p is int"),
    ({"file_format": "text", "delimiter": "\t"}, {"delimiter": "|"}, "delimiter of character codes 9, not 124"),
    ({"file_format": "text", "delimiter": "\t"}, {"null_value": "\\N"}, "null_value of character codes none, not 92 78"),
])
def test_table_whose_rows_would_read_back_otherwise(spark, pairs, make, options, changed, message):
    dockhand.load(pairs, make(**options))
    before = rows(spark.table(make().table))
    with pytest.raises(CommitError, match=message):
        dockhand.load(failing(pairs), make(**{**options, **changed}))
    dockhand.load(pairs.limit(0), make(**options))
    assert rows(spark.table(make().table)) == before


def test_text_table_that_does_not_say_how_it_is_made(spark, pairs, make):
    spec = make(file_format="text", delimiter="|")
    dockhand.load(pairs, spec)
    lines = f"{spec.table}__lines"
    spark.sql(f"ALTER TABLE {lines} UNSET TBLPROPERTIES ('dockhand.delimiter', 'dockhand.null_value')")
    with pytest.raises(CommitError, match="does not say its delimiter"):
        dockhand.load(pairs, spec)
    dockhand.load(pairs, make(file_format="text", delimiter="|", adopt=True))
    assert spark.table(spec.table).count() == 10


@pytest.mark.parametrize("serde,stored,message", [
    ("org.apache.hadoop.hive.serde2.lazy.LazySimpleSerDe", {"field.delim": "|"}, None),
    ("org.apache.hadoop.hive.serde2.lazy.LazySimpleSerDe", {"field.delim": ","}, "delimiter"),
    ("org.apache.hadoop.hive.ql.io.orc.OrcSerde", {"field.delim": "|"}, "holds files of"),
])
def test_files_of_a_hive_table(make, serde, stored, message):
    described = {
        "provider": "hive", "serde_library": serde,
        "storage_properties": {**stored, "serialization.null.format": "\\N"},
    }
    spec = make(file_format="text", delimiter="|", null_value="\\N")
    if message is None:
        tables.check_files(described, spec)
    else:
        with pytest.raises(CommitError, match=message):
            tables.check_files(described, spec)


@pytest.mark.parametrize("file_format", ["text", "orc"])
def test_failed_first_load_can_be_repeated(spark, pairs, make, file_format):
    spec = make(file_format=file_format, delimiter="|")
    with pytest.raises(Exception, match="unreadable row"):
        dockhand.load(failing(pairs), spec)
    assert not tables.table_exists(spark, spec.table) and not Path(spec.location).exists()
    dockhand.load(pairs, spec)
    assert spark.table(spec.table).count() == 5


@pytest.mark.parametrize("file_format", ["text", "orc"])
def test_table_goes_again_when_its_files_cannot_be_moved(spark, pairs, make, monkeypatch, file_format):
    spec = make(file_format=file_format, delimiter="|")
    monkeypatch.setattr(Storage, "move", lambda self, s, t: False)
    with pytest.raises(CommitError, match="cannot rename"):
        dockhand.load(pairs, spec)
    monkeypatch.undo()
    for name in (spec.table, f"{spec.table}__lines"):
        assert not tables.table_exists(spark, name)
    dockhand.load(pairs, spec)
    assert spark.table(spec.table).count() == 5


def test_partition_kept_elsewhere(spark, pairs, make, tmp_path):
    dockhand.load(pairs, make(partition=[("p", "string", "1")]))
    spark.sql(f"ALTER TABLE {make().table} ADD PARTITION (p='2') LOCATION '{tmp_path}/other'")
    with pytest.raises(CommitError, match="keeps p=2"):
        dockhand.load(pairs, make(partition=[("p", "string", "2")]))


def test_conflict_makes_no_table(spark, pairs, make):
    dockhand.write_files(pairs, make())
    with pytest.raises(ConflictError):
        dockhand.load(pairs, make(write_mode="nonconflict"))
    assert not tables.table_exists(spark, make().table)


def test_write_mode_applies_where_files_lie_but_no_table(spark, pairs, make):
    dockhand.write_files(pairs, make())
    dockhand.load(pairs, make(write_mode="truncate"))
    assert spark.table(make().table).count() == 5


def test_table_description(spark, pairs, make):
    spec = make()
    dockhand.load(pairs, spec)
    described = tables.describe(spark, spec.table)
    assert described["comment"] == f"{spec.table_name}_table"
    assert described["type"] == "EXTERNAL"
    assert [c["comment"] for c in described["columns"]] == ["k", "w"]
    assert tables.table_location(spark, spec.table) == f"file:{spec.location}"
    spark.sql(f"DROP TABLE {spec.table}")
    assert names(spec.location) != []


@pytest.mark.parametrize("partition", [(), (("p q", "int", "1"), ("r", "string", "it's"))])
@pytest.mark.parametrize("hive", [True, False])
def test_statements_parse(spark, make, partition, hive):
    parser = spark._jsparkSession.sessionState().sqlParser()
    for options in ({"file_format": "text", "delimiter": "'"}, {"file_format": "orc"}):
        spec = make(partition=partition, columns=[("a b", "timestamp"), ("it's", "varchar")], **options)
        for statement in tables.create_statements(spec, hive):
            assert parser.parsePlan(statement) is not None


def test_hive_text_table_statement(make):
    spec = make(file_format="text", delimiter="\t", partition=[("p", "int", "1")])
    [statement] = tables.create_statements(spec, hive=True)
    assert "ROW FORMAT DELIMITED FIELDS TERMINATED BY '\t'" in statement
    assert "STORED AS TEXTFILE" in statement and "PARTITIONED BY (`p` int)" in statement


def test_odd_column_names(spark, pairs, make):
    spec = make(columns=[("k k", "bigint"), ("w.`w", "string")], file_format="text", delimiter="|")
    dockhand.load(pairs, spec)
    assert spark.table(spec.table).columns == ["k k", "w.`w"]


def test_unsafe_characters_in_paths(spark, pairs, make, tmp_path):
    spec = make(location=f"{tmp_path}/it's here/{{x}} [y]", partition=[("p", "string", "a'b \\ {c}")])
    dockhand.load(pairs, spec)
    assert spark.table(spec.table).filter("p = \"a'b \\\\ {c}\"").count() == 5


# Plans


def plan(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def test_load_plan_is_one_stage_and_converts_once(spark, orders):
    text = orders.select([F.col(c).cast("string") for c in orders.columns]).select(*orders.columns[:3])
    schema = dockhand.schema_from_columns([("a", "bigint"), ("b", "int"), ("c", "string")])
    p = plan(dockhand.clean_rows(text, schema))
    assert "Exchange" not in p and "Python" not in p
    assert p.index("Filter isnull(_bad") < p.index("CollectMetrics") < p.index("try_cast")
    assert p.count("AS _try0") == p.count("AS _out0") == 1
    assert "o_totalprice" not in p


def test_wanted_files_are_shuffled_below_the_counting(orders, make):
    from pyspark.sql import Observation

    from dockhand.plans.load import output_rows

    p = plan(output_rows(orders, make(columns=[(c, "string") for c in orders.columns], files=7), Observation()))
    assert p.count("Exchange") == 1 and "RoundRobinPartitioning(7)" in p
    assert p.index("CollectMetrics") < p.index("Exchange")
    text = orders.select(F.col("o_orderkey").cast("string"))
    p = plan(output_rows(text, make(columns=[("k", "int")], files=7), Observation()))
    assert p.index("CollectMetrics") < p.index("Exchange") < p.index("try_cast")
    assert p.count("AS _try0") == p.count("AS _out0") == 1


def test_rejected_rows_convert_once(orders):
    text = orders.select([F.col(c).cast("string") for c in orders.columns[:2]])
    p = plan(dockhand.dirty_rows(text, dockhand.schema_from_columns([("a", "int"), ("b", "int")])))
    assert p.index("Filter isnotnull(_bad") < p.index("CollectMetrics") < p.index("AS _try0")


def test_shared_folder(spark, monkeypatch):
    class Session:
        def __init__(self, master, folder):
            self.sparkContext = type("Context", (), {"master": master})
            self.conf = {"spark.checkpoint.dir": folder} if folder else {}

    assert shared_folder(Session("yarn", "hdfs://n/shared/")) == "hdfs://n/shared"
    assert shared_folder(Session("local[2]", None)) == tempfile.gettempdir()
    with pytest.raises(SpecError, match="spark.checkpoint.dir"):
        shared_folder(Session("yarn", None))
