"""Writing into a private directory and putting the files in place.

The data is written by Spark's own file writers on the executors.  What happens here on
the driver is names only: list, rename, delete.
"""

from __future__ import annotations

import re
import time
import uuid
from collections.abc import Callable
from concurrent.futures import ThreadPoolExecutor
from typing import Any, NamedTuple

from py4j.protocol import Py4JJavaError
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from dockhand.errors import CommitError, ConflictError
from dockhand.functions.sql import sql_name
from dockhand.sources.files import Entry, entries

# Renames and deletes are waits on the file system, so many run at once.
FILE_OPERATION_THREADS = 32
# Where the files of a stage wait that are written anew.
ODD = "odd"


class Storage:
    """The few file system calls a load needs, for the file system of one path."""

    def __init__(self, spark: SparkSession, path: str) -> None:
        self._spark = spark
        self._jvm = spark._jvm
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._fs = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())

    def qualified(self, path: str) -> str:
        return self._fs.makeQualified(self._path(path)).toString()

    def exists(self, path: str) -> bool:
        return self._fs.exists(self._path(path))

    def is_directory(self, path: str) -> bool:
        return self.exists(path) and self._fs.getFileStatus(self._path(path)).isDirectory()

    def entries(self, directory: str, prefix: str = "") -> list[Entry]:
        """Everything directly in a directory, or one load group in it."""
        return entries(self._spark, directory, prefix)

    def names(self, directory: str, prefix: str = "") -> list[str]:
        """The names of :meth:`entries`."""
        return [e.name for e in self.entries(directory, prefix)]

    def make_directory(self, path: str) -> None:
        if not self._fs.mkdirs(self._path(path)):
            raise CommitError(f"cannot create directory {path}")

    def make_empty_file(self, path: str) -> None:
        if not self._fs.createNewFile(self._path(path)):
            raise CommitError(f"cannot create {path}")

    def move(self, source: str, target: str) -> bool:
        return self._fs.rename(self._path(source), self._path(target))

    def root(self, path: str) -> str:
        """Scheme and authority of the file system a path lies on."""
        path = self._path(path)
        uri = path.getFileSystem(self._spark._jsc.hadoopConfiguration()).makeQualified(path).toUri()
        return f"{uri.getScheme()}://{uri.getAuthority() or ''}"

    def delete(self, path: str) -> None:
        """Delete what is there; a path that is still there afterwards is an error."""
        if not self._delete(path):
            raise CommitError(f"cannot delete {path}")

    def _delete(self, path: str) -> bool:
        return self._fs.delete(self._path(path), True) or not self.exists(path)

    def delete_all(self, directory: str, names: list[str]) -> None:
        """Delete files of a directory; an error names those that are left."""
        done = _in_parallel(lambda n: _outcome(lambda: self._delete(f"{directory}/{n}")), names)
        left = [(n, why) for n, why in zip(names, done) if why]
        if left:
            named = ", ".join(n for n, _ in left[:20])
            raise CommitError(
                f"{len(left)} of {len(names)} files not deleted from {directory}: {named} ({left[0][1]})"
            )

    def put_new(self, path: str, text: str) -> bool:
        """Make a small file unless there is one, which other writers see happen at once.

        Hadoop's local file system looks first and writes then, so Java's own call is used
        there.  Elsewhere the finished file gets its name by a rename, which does not replace.
        """
        uri = self._path(self.qualified(path)).toUri()
        if uri.getScheme() == "file":
            return self._put_new_locally(uri.getPath(), text)
        draft = f"{path}.{uuid.uuid4().hex}"
        out = self._fs.create(self._path(draft), True)
        out.write(bytearray(text.encode()))
        out.close()
        if not self.exists(path) and self.move(draft, path):
            return True
        self._delete(draft)
        return False

    def _put_new_locally(self, path: str, text: str) -> bool:
        nio = self._jvm.java.nio.file
        new_array = self._spark.sparkContext._gateway.new_array
        file = nio.Paths.get(path, new_array(self._jvm.java.lang.String, 0))
        nio.Files.createDirectories(
            file.getParent(), new_array(nio.attribute.FileAttribute, 0)
        )
        options = new_array(nio.OpenOption, 2)
        options[0], options[1] = nio.StandardOpenOption.CREATE_NEW, nio.StandardOpenOption.WRITE
        try:
            nio.Files.write(file, bytearray(text.encode()), options)
        except Py4JJavaError as e:
            if e.java_exception.getClass().getSimpleName() == "FileAlreadyExistsException":
                return False
            raise
        return True

    def read(self, path: str) -> str | None:
        """The text of a small file, nothing if it has gone."""
        try:
            stream = self._fs.open(self._path(path))
        except Py4JJavaError:
            if self.exists(path):
                raise
            return None
        try:
            return self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8")
        finally:
            stream.close()

    def touch(self, path: str) -> None:
        """Let a file be modified now."""
        self._fs.setTimes(self._path(path), int(time.time() * 1000), -1)

    def remove_if_empty(self, path: str) -> None:
        """Delete a directory in which nothing is left."""
        try:
            self._fs.delete(self._path(path), False)
        except Py4JJavaError:
            if not self.entries(path):
                raise

    def set_access(self, path: str, mode: str | None, owner: str | None, group: str | None) -> bool:
        """Set what is given of a file's mode (octal), owner and group."""
        where = self._path(path)
        if mode:
            self._fs.setPermission(where, self._jvm.org.apache.hadoop.fs.permission.FsPermission(mode))
        if owner or group:
            self._fs.setOwner(where, owner, group)
        return True

    def delete_on_exit(self, path: str) -> None:
        self._fs.deleteOnExit(self._path(path))


def _outcome(call: Callable[[], bool]) -> str | None:
    """What went wrong, if anything; all files are tried before an error is raised."""
    try:
        return None if call() else "refused"
    except Exception as e:
        return str(e)


def _in_parallel(call, items: list[str]) -> list:
    with ThreadPoolExecutor(max_workers=FILE_OPERATION_THREADS) as pool:
        return list(pool.map(call, items))


def new_run_id() -> str:
    return uuid.uuid4().hex


def stage_path(base: str, run_id: str) -> str:
    """Private directory next to ``base``, hence on the same file system."""
    return f"{base.rstrip('/')}__{run_id}"


class Layout(NamedTuple):
    """What lets readers leave out parts of ORC and Parquet files.

    Rows are sorted by ``cluster_by`` in each file, so that the smallest and largest values
    of its parts lie apart; values of ``bloom_columns`` are looked up in filters.
    """

    bloom_columns: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()

    def options(self, file_format: str) -> dict[str, str]:
        """The writer's options for the filters."""
        if not self.bloom_columns:
            return {}
        if file_format == "orc":
            return {"orc.bloom.filter.columns": ",".join(self.bloom_columns), "orc.bloom.filter.fpp": "0.01"}
        return {f"parquet.bloom.filter.enabled#{c}": "true" for c in self.bloom_columns}


def grant(storage: Storage, stage: str, mode: str | None, owner: str | None, group: str | None) -> None:
    """Set mode, owner and group of staged files and of the stage, which may become the target.

    That is before they are published, so the target never has files that are not as asked
    for, and what is refused fails the load with the target as it was.  A directory can be
    searched by those who may read it.
    """
    if not (mode or owner or group):
        return
    paths = [e.path for e in storage.entries(stage) if not e.is_directory]
    done = _in_parallel(lambda p: _outcome(lambda: storage.set_access(p, mode, owner, group)), paths)
    search = mode and "".join(str(int(c) | (int(c) & 4) >> 2) for c in mode)
    done.append(_outcome(lambda: storage.set_access(stage, search, owner, group)))
    refused = [(p, why) for p, why in zip([*paths, stage], done) if why]
    if refused:
        raise CommitError(
            f"mode, owner or group of {len(refused)} files not set, e.g. {refused[0][0]}: {refused[0][1]}"
        )


def write_stage(
    df: DataFrame, file_format: str, compression: str, stage: str, prefix: str, run_id: str,
    layout: Layout = Layout(), mode: str = "errorifexists",
) -> None:
    """Write a frame into a fresh directory, file names led by ``<prefix>__<run id>``.

    Tasks move their finished files into the stage themselves (commit algorithm 2): the
    stage is private and dropped on failure, so half a job is never seen, and the driver
    has no second list of files to move.
    """
    if layout.cluster_by:
        df = df.sortWithinPartitions(*[sql_name(c) for c in layout.cluster_by])
    (
        df.write.format(file_format)
        .options(**layout.options(file_format))
        .option("compression", compression)
        .option("lineSep", "\n")
        .option("mapreduce.output.basename", f"{prefix}__{run_id}")
        .option("mapreduce.fileoutputcommitter.algorithm.version", "2")
        .option("mapreduce.fileoutputcommitter.marksuccessfuljobs", "false")
        .mode(mode)
        .save(stage)
    )


def fit_files(
    spark: SparkSession, storage: Storage, schema: T.StructType, file_format: str, compression: str,
    stage: str, prefix: str, run_id: str, target_bytes: int, layout: Layout = Layout(),
) -> int:
    """Bring staged files to between half and twice a size; returns how many were rewritten.

    What the files weigh is known once they are written, in their format and codec, so it
    is they that are measured.  Those of a fitting size stay as they are; the rows of the
    others are dealt evenly to as many files as their bytes ask for.  Rows dealt anew may
    pack better or worse, so the new files are measured too, and dealt once more if need
    be.  All rows of fewer bytes than half the size make one file.
    """
    rewritten = 0
    for _ in range(2):
        files = [e for e in storage.entries(stage) if e.length and not e.is_directory]
        odd, count = odd_files([e.length for e in files], target_bytes)
        if not odd:
            break
        names, aside = [files[i].name for i in odd], f"{stage}/{ODD}"
        storage.make_directory(aside)
        move_files(storage, stage, aside, names)
        reader = spark.read.format(file_format).schema(schema).option("lineSep", "\n")
        rows = reader.load(_no_pattern(aside)).repartition(count)
        write_stage(rows, file_format, compression, stage, prefix, run_id, layout, "append")
        storage.delete(aside)
        rewritten += len(names)
    return rewritten


def odd_files(sizes: list[int], target: int) -> tuple[list[int], int]:
    """Which files, by their numbers, to write anew, and as how many; none if it is no use."""
    odd = [i for i, n in enumerate(sizes) if not target <= 2 * n <= 4 * target]
    if not odd:
        return [], 0
    total = sum(sizes[i] for i in odd)
    rest = sorted(set(range(len(sizes))) - set(odd), key=lambda i: sizes[i])
    if 2 * total < target and rest:  # too little for a file: it goes to the smallest other one
        odd.append(rest[0])
        total += sizes[rest[0]]
    count = max(1, round(total / target))
    return ([], 0) if count == len(odd) == 1 else (sorted(odd), count)


def _no_pattern(path: str) -> str:
    """A path as Spark's reader takes it, in which nothing stands for anything else."""
    return re.sub(r"([\\{}\[\]*?,])", r"\\\1", path)


def check_target(storage: Storage, target: str, prefix: str, mode: str) -> None:
    """Raise when the target is not a directory, or holds what the mode does not allow.

    ``nonconflict`` allows nothing of the group.  ``truncate`` replaces files of the group;
    a subdirectory of such a name is never deleted, so it is a conflict.
    """
    if storage.exists(target) and not storage.is_directory(target):
        raise CommitError(f"{target} is not a directory")
    if mode == "append":
        return
    taken = storage.entries(target, prefix)
    folders = [e for e in taken if e.is_directory]
    if mode == "nonconflict" and taken:
        raise ConflictError(f"{target} already holds {len(taken)} {prefix}__* files, e.g. {taken[0].name}")
    if mode == "truncate" and folders:
        raise ConflictError(f"{target} holds directories named {prefix}__*, e.g. {folders[0].name}")


class Publication(NamedTuple):
    """The files that go from a stage into the target, and those of the target that go."""

    stage: str
    target: str
    names: list[str]
    old: list[str]


def publish(
    storage: Storage, stage: str, target: str, prefix: str, mode: str, journal: Any = None
) -> list[str]:
    """Move staged files into the target under a write mode; returns their names.

    ``truncate`` removes the group's earlier files after the new ones are in place, so
    that no moment is without either and a failed move leaves the target as it was.
    Files without content are not published.  All is told to the ``journal`` (see
    :mod:`dockhand.operators.claims`) first, if there is one; it is left open.
    """
    check_target(storage, target, prefix, mode)
    staged = storage.entries(stage)
    names = [e.name for e in staged if e.length and not e.is_directory]
    storage.delete_all(stage, sorted({e.name for e in staged} - set(names)))
    old = storage.names(target, prefix) if mode == "truncate" else []
    if journal:
        journal.begin(Publication(stage, target, names, old))
    try:
        if not names:
            storage.make_directory(target)
        elif storage.exists(target):
            move_files(storage, stage, target, names)
        else:
            _move_directory(storage, stage, target, names)
    except BaseException as e:
        _undo(storage, target, names, journal, e)
        raise
    storage.delete_all(target, old)
    return sorted(names)


def _undo(storage: Storage, target: str, names: list[str], journal: Any, error: BaseException) -> None:
    """Take back what was moved; what cannot be taken back is noted on the error."""
    try:
        if journal:
            journal.turn_back()
        if storage.exists(target):
            storage.delete_all(target, names)
        if journal:
            journal.close()
    except Exception as e:
        error.add_note(str(e))


def _move_directory(storage: Storage, stage: str, target: str, names: list[str]) -> None:
    """A target that does not exist yet appears whole, by one rename."""
    storage.make_directory(target.rsplit("/", 1)[0])
    if not storage.move(stage, target):
        raise CommitError(f"cannot rename {stage} to {target}")
    # Had another load made the target in between, the stage now lies inside it.
    inside = f"{target}/{stage.rsplit('/', 1)[1]}"
    if storage.exists(inside):
        try:
            move_files(storage, inside, target, names)
        finally:
            storage.delete(inside)


def move_files(storage: Storage, stage: str, target: str, names: list[str]) -> None:
    """Rename files one by one; all are tried before an error is raised."""
    moved = _in_parallel(
        lambda n: _outcome(lambda: storage.move(f"{stage}/{n}", f"{target}/{n}")), names
    )
    failures = [(n, why) for n, why in zip(names, moved) if why]
    if failures:
        name, why = failures[0]
        raise CommitError(f"{len(failures)} of {len(names)} files not moved to {target}, e.g. {name}: {why}")
