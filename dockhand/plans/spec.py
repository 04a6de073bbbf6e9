"""The description of one load, checked before any Spark job starts."""

from __future__ import annotations

import codecs
import re
from collections.abc import Iterable, Mapping
from dataclasses import dataclass, field
from typing import Any, NamedTuple

from pyspark.sql import types as T

from dockhand.errors import SpecError
from dockhand.plans.parquet_text import parse_parquet_schema
from dockhand.plans.types import column_type, parquet_column_type, schema_from_columns

# Codecs each file format accepts besides "none".
COMPRESSIONS = {
    "text": ("gzip", "bzip2"),
    "orc": ("snappy",),
    "parquet": ("gzip", "snappy"),
}

# What happens to files of the same group already in the target.
WRITE_MODES = ("append", "nonconflict", "truncate")

# The option names of a JSON job description.
JOB_OPTIONS = {
    "table": "tableName",
    "database": "dbName",
    "table_type": "tableType",
    "partition": "parColumn",
    "location": "locationPath",
    "staging_path": "path",
    "file_system": "defaultFS",
    "file_prefix": "fileName",
    "file_format": "fileType",
    "columns": "column",
    "write_mode": "writeMode",
    "delimiter": "fieldDelimiter",
    "compression": "compress",
    "encoding": "encoding",
    "parquet_schema": "parquetSchema",
    "file_mode": "ugoMode",
    "file_owner": "hdfsUsername",
    "file_group": "hdfsGroupname",
}


class Column(NamedTuple):
    """One declared column."""

    name: str
    type: str


class PartitionColumn(NamedTuple):
    """One level of the static partition a load goes into."""

    name: str
    type: str
    value: str


@dataclass(frozen=True)
class LoadSpec:
    """Where the rows of a DataFrame go, as what, and in which files.

    ``files`` asks for that many output files and costs a shuffle; left out, every
    input partition writes one file.  With ``target_file_bytes`` files of less than half or
    more than twice that size are written anew, as files of about that size.  ORC and Parquet
    files get Bloom filters of ``bloom_columns`` and are sorted by ``cluster_by``, each for
    itself.  New files, and only they, get ``file_mode`` (octal digits), ``file_owner`` and
    ``file_group``.  ``swap_partition`` lets a ``truncate`` of a partition that holds no other
    group write into a fresh directory beside the table, and publish it by one change of the
    catalog: readers of the table see the old rows or the new ones.  ``null_value`` stands for null in text files.
    ``rejects_location`` is a directory in which each load that rejects rows leaves them, as
    Parquet files in a subdirectory of its own.  ``adopt`` allows text to go into a table that
    does not say how its lines are made, because something else created it.
    With more rejected rows than ``max_rejects``, or a larger share of them than
    ``max_reject_share``, a load changes nothing and leaves no rejects; the first ``probe_rows``
    rows are tried before anything is written, and may stop it early.
    ``claim_seconds`` is how long a driver may be away before another load of the same files
    takes over from it.
    ``schema`` replaces the types of ``columns`` in Parquet files, which is how DECIMAL
    and BINARY columns are written; it may be the text of a Parquet message.  Null in one of
    its columns that is not nullable is rejected.
    """

    table: str
    location: str
    file_prefix: str
    file_format: str
    columns: tuple[Column, ...]
    write_mode: str
    delimiter: str | None = None
    compression: str | None = None
    partition: tuple[PartitionColumn, ...] = ()
    staging_path: str | None = None
    encoding: str = "UTF-8"
    files: int | None = None
    target_file_bytes: int | None = None
    bloom_columns: tuple[str, ...] = ()
    cluster_by: tuple[str, ...] = ()
    file_mode: str | None = None
    file_owner: str | None = None
    file_group: str | None = None
    swap_partition: bool = False
    null_value: str = ""
    fail_on_hazards: bool = False
    rejects_location: str | None = None
    claim_seconds: float = 600
    max_rejects: int | None = None
    max_reject_share: float | None = None
    probe_rows: int = 100_000
    adopt: bool = False
    schema: T.StructType | str | None = field(default=None, compare=False)

    def __post_init__(self) -> None:
        def put(name: str, value: Any) -> None:
            object.__setattr__(self, name, value)

        put("file_format", _choice("file_format", self.file_format, COMPRESSIONS))
        put("write_mode", _choice("write_mode", self.write_mode, WRITE_MODES))
        put("compression", _compression(self.file_format, self.compression))
        if isinstance(self.schema, str):
            put("schema", parse_parquet_schema(self.schema))
        put("columns", _columns(self.columns))
        put("partition", _partition(self.partition, self.columns))
        put("location", _directory("location", self.location))
        if self.staging_path is not None:
            put("staging_path", _directory("staging_path", self.staging_path))
        if self.rejects_location is not None:
            put("rejects_location", _directory("rejects_location", self.rejects_location))
            if f"{self.rejects_location}/".startswith(f"{self.location}/"):
                raise SpecError("rejects_location must not lie in the location of the table")
        if self.max_rejects is not None and self.max_rejects < 0:
            raise SpecError("max_rejects must be at least 0")
        if self.max_reject_share is not None and not 0 <= self.max_reject_share <= 1:
            raise SpecError("max_reject_share must be from 0 to 1")
        if self.probe_rows < 0:
            raise SpecError("probe_rows must be at least 0")
        if self.claim_seconds <= 0:
            raise SpecError("claim_seconds must be above 0")
        self._check_schema()
        _check_table(self.table)
        _check_prefix(self.file_prefix)
        _check_encoding(self.encoding)
        self._check_text_options()
        if self.files is not None and self.files < 1:
            raise SpecError("files must be at least 1")
        if self.swap_partition and not (self.partition and self.write_mode == "truncate"):
            raise SpecError("swap_partition is for the truncate of a partition")
        for name in ("bloom_columns", "cluster_by"):
            put(name, self._named_columns(name))
        if self.file_mode is not None and not re.fullmatch("[0-7]{3}", self.file_mode):
            raise SpecError(f"file_mode must be three octal digits, got {self.file_mode!r}")
        if self.target_file_bytes is not None and self.target_file_bytes < 1:
            raise SpecError("target_file_bytes must be at least 1")

    @property
    def database(self) -> str:
        return self.table.split(".")[0]

    @property
    def table_name(self) -> str:
        return self.table.split(".")[1]

    @property
    def output_schema(self) -> T.StructType:
        """Schema of the written rows."""
        return self.schema or schema_from_columns(self.columns)

    @property
    def partition_schema(self) -> T.StructType:
        return schema_from_columns((p.name, p.type) for p in self.partition)

    def _check_schema(self) -> None:
        if self.schema is None:
            schema_from_columns(self.columns)
            return
        if self.file_format != "parquet":
            raise SpecError("an explicit schema applies to parquet files only")
        if [f.name for f in self.schema] != [c.name for c in self.columns]:
            raise SpecError("schema and columns must name the same columns in the same order")
        for f in self.schema:
            if parquet_column_type(f.dataType.simpleString()) != f.dataType:
                raise SpecError(f"column {f.name}: {f.dataType.simpleString()} cannot be written")

    def _named_columns(self, option: str) -> tuple[str, ...]:
        names = tuple(getattr(self, option))
        if names and self.file_format == "text":
            raise SpecError(f"{option} applies to orc and parquet files only")
        unknown = sorted(set(names) - {c.name for c in self.columns})
        if unknown:
            raise SpecError(f"{option} names {unknown}, which are no columns")
        return names

    def _check_text_options(self) -> None:
        if self.file_format != "text":
            return
        if self.delimiter is None:
            raise SpecError("text files need a delimiter")
        if len(self.delimiter) != 1:
            raise SpecError(f"delimiter must be one character, got {self.delimiter!r}")
        if self.delimiter in "\r\n":
            raise SpecError("delimiter must not be a line break")
        if any(c in self.null_value for c in (self.delimiter, "\n", "\r")):
            raise SpecError("null_value must not hold the delimiter or a line break")

    @classmethod
    def from_job(cls, parameter: Mapping[str, Any], **overrides: Any) -> LoadSpec:
        """Read the parameter block of a JSON job description.

        Connection and account options are not read: the Spark session has its own catalog,
        file systems and credentials.  Mode, owner and group of new files are set only where
        the job names them.  A Parquet schema, if there is one, goes
        before the types of the columns, and stands for the columns where they are left out.
        """
        parameter = _with_columns(parameter)
        get = {ours: parameter.get(theirs) for ours, theirs in JOB_OPTIONS.items()}
        for name in ("table", "database", "table_type", "location", "file_prefix",
                     "file_format", "columns", "write_mode"):
            if get[name] in (None, "", []):
                raise SpecError(f"{JOB_OPTIONS[name]} is required")
        kind = _choice(JOB_OPTIONS["table_type"], get["table_type"], ("normal", "partition"))
        if kind == "partition" and not get["partition"]:
            raise SpecError(f"{JOB_OPTIONS['partition']} is required for a partitioned table")
        root = (get["file_system"] or "").rstrip("/")
        values: dict[str, Any] = {
            "table": f"{get['database']}.{get['table']}",
            "location": root + get["location"],
            "staging_path": root + get["staging_path"] if get["staging_path"] else None,
            "file_prefix": get["file_prefix"],
            "file_format": get["file_format"],
            "columns": [(c.get("name"), c.get("type")) for c in get["columns"]],
            "write_mode": get["write_mode"],
            "delimiter": get["delimiter"],
            "compression": get["compression"],
            "encoding": get["encoding"] or "UTF-8",
            "schema": (get["parquet_schema"] or "").strip() or None,
            "file_mode": get["file_mode"] or None,
            "file_owner": get["file_owner"] or None,
            "file_group": get["file_group"] or None,
        }
        if kind == "partition":
            values["partition"] = [
                (p.get("name"), p.get("type"), p.get("value")) for p in get["partition"]
            ]
        return cls(**{**values, **overrides})


def _with_columns(parameter: Mapping[str, Any]) -> Mapping[str, Any]:
    names, text = JOB_OPTIONS["columns"], parameter.get(JOB_OPTIONS["parquet_schema"])
    if parameter.get(names) or not (text or "").strip():
        return parameter
    columns = [{"name": f.name, "type": f.dataType.simpleString()} for f in parse_parquet_schema(text)]
    return {**parameter, names: columns}


def _choice(option: str, value: Any, allowed: Iterable[str]) -> str:
    if value is None or not str(value).strip():
        raise SpecError(f"{option} is required")
    value = str(value).strip().lower()
    if value not in allowed:
        raise SpecError(f"{option} must be one of {sorted(allowed)}, got {value!r}")
    return value


def _compression(file_format: str, value: str | None) -> str:
    value = (value or "").strip().lower() or "none"
    if value != "none" and value not in COMPRESSIONS[file_format]:
        raise SpecError(
            f"{file_format} files take compression none or {COMPRESSIONS[file_format]}, got {value!r}"
        )
    return value


def _columns(columns: Iterable[Any]) -> tuple[Column, ...]:
    columns = tuple(Column(*c) for c in columns or ())
    if not columns:
        raise SpecError("columns must not be empty")
    for c in columns:
        if not c.name or not c.type:
            raise SpecError(f"a column needs a name and a type, got {c}")
    _check_unique([c.name for c in columns])
    return columns


def _partition(
    partition: Iterable[Any], columns: tuple[Column, ...]
) -> tuple[PartitionColumn, ...]:
    partition = tuple(PartitionColumn(*p) for p in partition or ())
    for p in partition:
        if not p.name or not p.type or p.value is None or not str(p.value).strip():
            raise SpecError(f"a partition column needs a name, a type and a value, got {p}")
        column_type(p.type)
    _check_unique([c.name for c in columns] + [p.name for p in partition])
    return tuple(p._replace(value=str(p.value)) for p in partition)


def _check_unique(names: list[str]) -> None:
    lowered = [n.lower() for n in names]
    twice = sorted({n for n in lowered if lowered.count(n) > 1})
    if twice:
        raise SpecError(f"column names must differ in more than letter case: {twice}")


def _directory(option: str, path: str) -> str:
    if not path or not re.match(r"([A-Za-z][A-Za-z0-9+.-]*:)?/", path):
        raise SpecError(f"{option} must be an absolute path, got {path!r}")
    if "*" in path or "?" in path:
        raise SpecError(f"{option} must not hold * or ?, got {path!r}")
    return path.rstrip("/") or path


def _check_table(table: str) -> None:
    if not re.fullmatch(r"[^.`]+\.[^.`]+", table or ""):
        raise SpecError(f"table must read database.table, got {table!r}")


def _check_prefix(prefix: str) -> None:
    if not prefix:
        raise SpecError("file_prefix is required")
    # "__" ends the prefix in a file name, and readers skip names led by "_" or ".".
    if "__" in prefix or prefix.endswith("_") or prefix[0] in "_.":
        raise SpecError(f"file_prefix must not hold '__', end in '_' or start with '_' or '.': {prefix!r}")
    if any(c in prefix for c in "*?[]{}\\/:"):
        raise SpecError(f"file_prefix must not hold pattern or path characters: {prefix!r}")


def _check_encoding(encoding: str) -> None:
    try:
        known = codecs.lookup(encoding.strip()).name
    except LookupError:
        raise SpecError(f"encoding {encoding!r} is not known") from None
    if known != "utf-8":
        raise SpecError(f"files are written in UTF-8 only, got {encoding!r}")
