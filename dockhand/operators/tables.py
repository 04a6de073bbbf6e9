"""The target table in the session catalog."""

from __future__ import annotations

import json
from dataclasses import replace
from typing import Any

from pyspark.errors import AnalysisException
from pyspark.sql import SparkSession
from pyspark.sql import types as T

from dockhand.errors import CommitError, ConflictError, SpecError
from dockhand.functions.casts import strict_cast
from dockhand.functions.render import parse_fields
from dockhand.functions.sql import sql_literal, sql_name, sql_type
from dockhand.operators.files import Storage
from dockhand.plans.spec import LoadSpec
from dockhand.plans.types import column_type

# Leads the properties that tell how a table's files are made.
PROPERTY = "dockhand."
RUN = PROPERTY + "run"

# What the serialization libraries of Hive tables are called, by file format.
SERDES = {"text": "LazySimpleSerDe", "orc": "OrcSerde", "parquet": "ParquetHiveSerDe"}

# Characters that are written as %XX in a partition directory name,
# besides the control characters.
ESCAPED_PATH_CHARS = "\"#%'*/:=?\\{[]^\x7f"


def escape_path_name(text: str) -> str:
    """One name or value as it stands in a partition directory."""
    return "".join(
        f"%{ord(c):02X}" if c in ESCAPED_PATH_CHARS or ord(c) < 0x20 else c for c in text
    )


def partition_path(spec: LoadSpec) -> str:
    """``name=value/name=value`` of the spec's partition, relative to the table."""
    return "/".join(
        f"{escape_path_name(p.name)}={escape_path_name(p.value)}" for p in spec.partition
    )


def target_directory(spec: LoadSpec) -> str:
    """Directory the files of this load end up in."""
    return f"{spec.location}/{partition_path(spec)}" if spec.partition else spec.location


def normalize_partition(spark: SparkSession, spec: LoadSpec) -> LoadSpec:
    """The spec with each partition value as its type prints it, ``08`` as int being 8."""
    if not spec.partition:
        return spec
    row = spark.range(1).selectExpr(
        *[
            f"CAST({strict_cast(sql_literal(p.value), T.StringType(), column_type(p.type))} AS STRING)"
            for p in spec.partition
        ]
    ).first()
    for p, value in zip(spec.partition, row):
        if value is None:
            raise SpecError(f"partition column {p.name}: {p.value!r} is not a {p.type}")
    values = tuple(p._replace(value=v) for p, v in zip(spec.partition, row))
    return replace(spec, partition=values)


def _is_hive(spark: SparkSession) -> bool:
    return spark.conf.get("spark.sql.catalogImplementation", "in-memory") == "hive"


def storage_table(spark: SparkSession, spec: LoadSpec) -> str:
    """Quoted name of the table that owns the files and partitions.

    That is the table itself, or the table of lines a text table is a view over.
    """
    lines = f"{spec.table}__lines"
    owner = lines if spec.file_format == "text" and table_exists(spark, lines) else spec.table
    return sql_name(*owner.split("."))


def table_exists(spark: SparkSession, table: str) -> bool:
    """Whether ``database.table`` is in the catalog, in any letter case."""
    return spark.catalog.tableExists(sql_name(*table.split(".")))


def describe(spark: SparkSession, quoted_table: str) -> dict[str, Any]:
    """What the catalog knows about a table."""
    return json.loads(spark.sql(f"DESCRIBE EXTENDED {quoted_table} AS JSON").first()[0])


def table_location(spark: SparkSession, quoted_table: str) -> str:
    """Directory of a table."""
    location = describe(spark, quoted_table).get("location")
    if location is None:
        raise CommitError(f"{quoted_table} has no location")
    return location


def table_properties(spec: LoadSpec) -> dict[str, str]:
    """What a table of this spec says about its files, for later loads to compare.

    Characters are given by their numbers, since catalogs differ in which they keep.
    """
    said = {PROPERTY + "format": spec.file_format}
    if spec.file_format == "text":
        said[PROPERTY + "delimiter"] = _numbers(spec.delimiter)
        said[PROPERTY + "null_value"] = _numbers(spec.null_value)
    return said


def _numbers(text: str) -> str:
    return " ".join(str(ord(c)) for c in text) or "none"


def create_statements(spec: LoadSpec, hive: bool, run_id: str | None = None) -> list[str]:
    """The DDL that makes the target table, and fails where it is there already.

    A run id is kept as a property, so that the run knows its own table again.
    """
    table = sql_name(spec.database, spec.table_name)
    columns = ", ".join(
        f"{sql_name(f.name)} {sql_type(f.dataType)} COMMENT {sql_literal(f.name)}"
        for f in spec.output_schema
    )
    keys = ", ".join(f"{sql_name(f.name)} {sql_type(f.dataType)}" for f in spec.partition_schema)
    partitioned = f" PARTITIONED BY ({keys})" if keys else ""
    comment = f" COMMENT {sql_literal(spec.table_name + '_table')}"
    location = f" LOCATION {sql_literal(spec.location)}"
    properties = table_properties(spec) | ({RUN: run_id} if run_id else {})
    listed = ", ".join(f"{sql_literal(k)} = {sql_literal(v)}" for k, v in properties.items())
    location += f" TBLPROPERTIES ({listed})"
    if spec.file_format != "text":
        options = f" OPTIONS (compression {sql_literal(spec.compression)})"
        return [
            f"CREATE TABLE {table} ({columns}) USING {spec.file_format}"
            f"{options}{partitioned}{comment}{location}"
        ]
    if hive:
        return [
            f"CREATE EXTERNAL TABLE {table} ({columns}){comment}{partitioned}"
            f" ROW FORMAT DELIMITED FIELDS TERMINATED BY {sql_literal(spec.delimiter)}"
            " COLLECTION ITEMS TERMINATED BY ',' MAP KEYS TERMINATED BY ':'"
            " LINES TERMINATED BY '\\n'"
            f" NULL DEFINED AS {sql_literal(spec.null_value or chr(92) + 'N')}"
            f" STORED AS TEXTFILE{location}"
        ]
    lines = sql_name(spec.database, spec.table_name + "__lines")
    fields = parse_fields(spec.output_schema, spec.delimiter, spec.null_value)
    names = [sql_name(p.name) for p in spec.partition]
    view_columns = [f"{sql_name(f.name)} COMMENT {sql_literal(f.name)}" for f in spec.output_schema]
    return [
        f"CREATE TABLE {lines} (value STRING) USING text"
        f" OPTIONS (lineSep '\\n'){partitioned}{comment}{location}",
        f"CREATE VIEW {table} ({', '.join(view_columns + names)}){comment}"
        f" AS SELECT {', '.join(fields + names)} FROM {lines}",
    ]


def create_table(spark: SparkSession, spec: LoadSpec, run_id: str | None = None) -> bool:
    """Create the external table of a spec; whether it was this call that did.

    ORC and Parquet tables are data source tables.  A text table is, where the catalog
    has row formats, a delimited table; elsewhere a table of lines under a view that
    splits and casts them.
    """
    for statement in create_statements(spec, _is_hive(spark), run_id):
        try:
            spark.sql(statement)
        except AnalysisException as e:
            if "ALREADY_EXISTS" not in (e.getCondition() or ""):
                raise
            if made_by(spark, spec) == run_id and run_id:
                drop_table(spark, spec)
            return False
    return True


def made_by(spark: SparkSession, spec: LoadSpec) -> str | None:
    """Id of the run that created the table that owns the files."""
    if not table_exists(spark, spec.table) and not table_exists(spark, f"{spec.table}__lines"):
        return None
    return describe(spark, storage_table(spark, spec)).get("table_properties", {}).get(RUN)


def drop_own_table(spark: SparkSession, storage: Storage, spec: LoadSpec, run_id: str) -> None:
    """Drop the table a failed run made, unless another load has put files there since."""
    if made_by(spark, spec) != run_id or storage.entries(spec.location):
        return
    table = storage_table(spark, spec)
    if not spec.partition or not spark.sql(f"SHOW PARTITIONS {table}").take(1):
        drop_table(spark, spec)


def drop_table(spark: SparkSession, spec: LoadSpec) -> None:
    """Take the table of a spec out of the catalog; its files stay."""
    table = sql_name(spec.database, spec.table_name)
    if spec.file_format == "text" and not _is_hive(spark):
        spark.sql(f"DROP VIEW IF EXISTS {table}")
        table = sql_name(spec.database, spec.table_name + "__lines")
    spark.sql(f"DROP TABLE IF EXISTS {table}")


def check_table(
    spark: SparkSession, storage: Storage, spec: LoadSpec, must_be_there: bool = True
) -> None:
    """Raise unless an existing table is where and what the spec says it is.

    Its directory must exist, unless the load that made the table is about to make that too.
    """
    described = describe(spark, storage_table(spark, spec))
    location = described.get("location")
    if location is None:
        raise CommitError(f"{spec.table} has no location")
    if storage.qualified(location) != storage.qualified(spec.location):
        raise CommitError(f"{spec.table} is at {location}, not at {spec.location}")
    if must_be_there and not storage.exists(location):
        raise CommitError(f"{spec.table} is in the catalog but {location} does not exist")
    check_files(described, spec)
    keys = [k.lower() for k in described.get("partition_columns", [])]
    if keys != [p.name.lower() for p in spec.partition]:
        raise CommitError(f"{spec.table} is partitioned by {keys}")
    columns = [
        (f.name.lower(), sql_type(f.dataType))
        for f in spark.table(sql_name(spec.database, spec.table_name)).schema
    ]
    have = [c for c in columns if c[0] not in keys]
    if [c[0] for c in have] != [c.name.lower() for c in spec.columns]:
        raise CommitError(f"{spec.table} has columns {[c[0] for c in have]}")
    declared = [*spec.output_schema, *spec.partition_schema]
    for (name, kind), field in zip(have + [c for c in columns if c[0] in keys], declared):
        if kind != sql_type(field.dataType):
            raise CommitError(f"{spec.table}: column {name} is {kind}, not {sql_type(field.dataType)}")


def check_files(described: dict[str, Any], spec: LoadSpec) -> None:
    """Raise unless the described table keeps its files in the spec's form.

    A text table tells by its properties, or a delimited one by those of its serialization
    library, how its lines are made.  One that does not is taken only with ``adopt``.
    """
    provider = described.get("provider", "").lower()
    if provider == "hive":
        serde = described.get("serde_library", "")
        if not serde.endswith(SERDES[spec.file_format]):
            raise CommitError(f"{spec.table} holds files of {serde or 'an unknown library'}")
    elif provider != spec.file_format:
        raise CommitError(f"{spec.table} holds {provider} files")
    if spec.file_format != "text":
        return
    said = described.get("table_properties", {})
    stored = described.get("storage_properties", {})
    kept = {
        name: said.get(PROPERTY + name) or (_numbers(stored[key]) if key in stored else None)
        for name, key in (("delimiter", "field.delim"), ("null_value", "serialization.null.format"))
    }
    wanted = table_properties(spec)
    for name, value in kept.items():
        if value is None and not spec.adopt:
            raise CommitError(f"{spec.table} does not say its {name}; set adopt to load it")
        if value is not None and value != wanted[PROPERTY + name]:
            raise CommitError(
                f"{spec.table} has the {name} of character codes {value}, not {wanted[PROPERTY + name]}"
            )


def partition_location(spark: SparkSession, spec: LoadSpec) -> str | None:
    """Where the catalog keeps the partition of a spec, if it has it."""
    table = storage_table(spark, spec)
    if not spark.sql(f"SHOW PARTITIONS {table} PARTITION ({_partition_sql(spec)})").take(1):
        return None
    return describe(spark, f"{table} PARTITION ({_partition_sql(spec)})")["location"]


def check_partition_location(spark: SparkSession, storage: Storage, spec: LoadSpec) -> None:
    """Raise when the catalog already has this partition, but in another directory.

    A load that swaps partitions may also find it among its own versions.
    """
    location = partition_location(spark, spec)
    if location is None or storage.qualified(location) == storage.qualified(target_directory(spec)):
        return
    if not storage.qualified(location).startswith(storage.qualified(versions_directory(spec)) + "/"):
        raise CommitError(f"{spec.table} keeps {partition_path(spec)} at {location}")
    if not spec.swap_partition:
        raise CommitError(f"{spec.table} keeps {partition_path(spec)} at {location}; set swap_partition")


def versions_directory(spec: LoadSpec) -> str:
    """Where the versions of a swapped partition lie, each in a directory of its run id."""
    return f"{spec.location}__versions/{partition_path(spec)}"


def check_swap(storage: Storage, directory: str | None, prefix: str) -> None:
    """Raise when a partition's directory has files of another group, which a swap would lose."""
    others = [
        n for n in (storage.names(directory) if directory else [])
        if not n.startswith(f"{prefix}__") and n[0] not in "_."
    ]
    if others:
        raise ConflictError(f"{directory} holds files that are not {prefix}__*, e.g. {others[0]}")


def swap_partition(spark: SparkSession, storage: Storage, spec: LoadSpec, directory: str) -> None:
    """Let the catalog keep the partition in another directory, by one statement."""
    table, partition = storage_table(spark, spec), _partition_sql(spec)
    storage.make_directory(spec.location)
    if partition_location(spark, spec) is None:
        spark.sql(f"ALTER TABLE {table} ADD PARTITION ({partition}) LOCATION {sql_literal(directory)}")
    else:
        spark.sql(f"ALTER TABLE {table} PARTITION ({partition}) SET LOCATION {sql_literal(directory)}")
    spark.sql(f"REFRESH TABLE {table}")


def drop_versions(storage: Storage, spec: LoadSpec, current: str, live: set[str]) -> None:
    """Delete what the partition held before, and what dead runs left, but no live run's files."""
    versions = versions_directory(spec)
    for e in storage.entries(versions):
        if storage.qualified(e.path) != storage.qualified(current) and e.name not in live:
            storage.delete(e.path)
    target = target_directory(spec)
    storage.delete_all(target, storage.names(target, spec.file_prefix))


def register_load(spark: SparkSession, spec: LoadSpec) -> None:
    """Make published files visible: add the partition, drop stale listings."""
    table = storage_table(spark, spec)
    if spec.partition:
        spark.sql(
            f"ALTER TABLE {table} ADD IF NOT EXISTS PARTITION ({_partition_sql(spec)})"
            f" LOCATION {sql_literal(target_directory(spec))}"
        )
    spark.sql(f"REFRESH TABLE {table}")


def _partition_sql(spec: LoadSpec) -> str:
    return ", ".join(f"{sql_name(p.name)} = {sql_literal(p.value)}" for p in spec.partition)
