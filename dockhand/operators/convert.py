"""Positional conversion: input columns onto the declared ones, good rows from bad.

Rows are tagged with the position of the first column that does not convert; clean rows
have none.  Everything is projection and filter, so no operator here shuffles except
:func:`dirty_summary`, which adds up per task first.
"""

from __future__ import annotations

import uuid

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockhand.errors import SpecError
from dockhand.functions.casts import accept, attempt, can_fail, check_pair
from dockhand.functions.sql import sql_literal, sql_name

BAD = "_bad"
FILE = "_file"

# Input files are told apart by a hash of their paths, one bit each in a bitmap of 4 KB.
FILE_BITS = 32768
FILE_BIT = f"CAST(pmod(xxhash64(_metadata.file_path), {FILE_BITS}) AS INT)"
# With rejects in more files than this, all are read again.
MAX_FILES = 2000

# What :func:`dirty_rows` adds.
DIRTY_COLUMNS = ("bad_position", "bad_column", "bad_type", "bad_value", "message")


def project(df: DataFrame, names: list[str]) -> DataFrame:
    """The i-th input column under the i-th name; input names do not matter."""
    _check_arity(df, len(names))
    return df.toDF(*names)


def check_input(df: DataFrame, schema: T.StructType) -> None:
    """Raise unless the frame has one loadable column per declared column."""
    _check_arity(df, len(schema))
    for source, target in zip(df.schema, schema):
        check_pair(target.name, source.dataType, target.dataType)


def fallible(df: DataFrame, schema: T.StructType) -> list[int]:
    """Positions, from 0, of the columns that can hold a value that does not convert."""
    pairs = zip(df.schema, schema)
    return [
        i for i, (s, t) in enumerate(pairs) if can_fail(s.dataType, t.dataType) or s.nullable and not t.nullable
    ]


def knows_files(df: DataFrame) -> bool:
    """Whether the rows of a frame still know which file each of them comes from."""
    if "_metadata" in (c.lower() for c in df.columns):
        return False
    try:
        df.selectExpr(FILE_BIT)
    except AnalysisException:
        return False
    return True


def convert(df: DataFrame, schema: T.StructType, with_file: bool = False) -> DataFrame:
    """Input columns ``_in<i>``, converted columns ``_out<i>`` and ``_bad``.

    ``_bad`` is the position of the first column, from 1, whose value is not null but
    does not convert, or is null where the schema has no nulls, else null.  Attempting, accepting and checking are projections of
    their own, so each cast is computed once for all of them.  With ``with_file`` rejected
    rows have the bit of their input file in ``_file``.
    """
    check_input(df, schema)
    types = [(s.dataType, t.dataType) for s, t in zip(df.schema, schema)]
    names = [f"_in{i}" for i in range(len(types))]
    raw = df.selectExpr("*", FILE_BIT).toDF(*names, FILE) if with_file else df.toDF(*names)
    tried = raw.selectExpr(
        "*", *[f"{attempt(f'_in{i}', *pair)} AS _try{i}" for i, pair in enumerate(types)]
    )
    converted = tried.selectExpr(
        *raw.columns,
        *[f"{accept(f'_in{i}', f'_try{i}', *pair)} AS _out{i}" for i, pair in enumerate(types)],
    )
    kept = [c for c in converted.columns if c != FILE]
    tagged = converted.selectExpr(
        *kept, *([FILE] if with_file else []), f"{_first_bad(fallible(df, schema), schema)} AS {BAD}"
    )
    if not with_file:
        return tagged
    return tagged.selectExpr(*kept, BAD, f"CASE WHEN {BAD} IS NOT NULL THEN {FILE} END AS {FILE}")


def count(converted: DataFrame, observation: Observation | None = None) -> DataFrame:
    """The rows, counted as they pass (``rows`` and ``dirty``), into the observation if given.

    Where rows have ``_file``, ``files`` is the bitmap of the input files that had rejected
    ones.  A filter on ``_bad`` stays above the counting, where without it the optimizer would
    move it down and compute every cast again.
    """
    files = [F.bitmap_construct_agg(FILE).alias("files")] if FILE in converted.columns else []
    return converted.observe(
        observation or f"dockhand-{uuid.uuid4().hex}",
        F.count(F.lit(1)).alias("rows"),
        F.count(BAD).alias("dirty"),
        *files,
    )


def tag(df: DataFrame, schema: T.StructType, observation: Observation | None = None) -> DataFrame:
    """:func:`convert`, counted by :func:`count`."""
    return count(convert(df, schema), observation)


def _first_bad(positions: list[int], schema: T.StructType) -> str:
    checks = [
        f"WHEN {f'_in{i} IS NOT NULL AND ' if schema[i].nullable else ''}_out{i} IS NULL THEN {i + 1}"
        for i in positions
    ]
    return f"CASE {' '.join(checks)} END" if checks else "CAST(NULL AS INT)"


def clean_rows(
    df: DataFrame,
    schema: T.StructType,
    observation: Observation | None = None,
    partitions: int | None = None,
    with_file: bool = False,
) -> DataFrame:
    """Rows that convert as a whole, converted; see :func:`count` for the observation.

    A filter on the result is not pushed to the scan, as it stays above the counting; filter
    the input instead where that can be.  ``partitions`` deals the rows to so many partitions
    once they are converted and before they are counted: every input task converts, only
    what is written moves, and a repeated task of the shuffle does not count twice.
    """
    rows = convert(df, schema, with_file)
    if partitions:
        tags = [BAD, FILE] if with_file else [BAD]
        rows = rows.select(*[f"_out{i}" for i in range(len(schema))], *tags).repartition(partitions)
    return count(rows, observation).filter(f"{BAD} IS NULL").selectExpr(
        *[f"_out{i} AS {sql_name(f.name)}" for i, f in enumerate(schema)]
    )


def with_rejects(df: DataFrame, files: bytes | None) -> DataFrame:
    """The rows of the input files whose bits are set in a bitmap of :func:`count`.

    The condition is on the files alone, so that others are not opened.  Two files of one
    bit are both read, which costs time and changes nothing.
    """
    if files is None:
        return df
    bits = [
        8 * i + b for i, byte in enumerate(files) if byte for b in range(8) if byte >> b & 1
    ]
    if len(bits) > MAX_FILES or not bits:
        return df
    return df.filter(f"{FILE_BIT} IN ({', '.join(map(str, bits))})")


def dirty_rows(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Rows that do not convert, as they came, with the first column that failed.

    Added columns: ``bad_position`` (from 1), ``bad_column``, ``bad_type``, ``bad_value``
    (the raw text) and ``message``.  Input columns of these names, as a table of rejected
    rows has them, come as ``input_<name>``.
    """
    positions = fallible(df, schema)

    def pick(of) -> str:
        cases = " ".join(f"WHEN {i + 1} THEN {of(i)}" for i in positions)
        return f"CASE {BAD} {cases} END" if cases else "CAST(NULL AS STRING)"

    column = pick(lambda i: sql_literal(schema[i].name))
    kind = pick(lambda i: sql_literal(schema[i].dataType.simpleString()))
    value = pick(lambda i: f"CAST(_in{i} AS STRING)")
    return tag(df, schema).filter(f"{BAD} IS NOT NULL").selectExpr(
        *[f"_in{i} AS {sql_name(name)}" for i, name in enumerate(_free_names(df.columns))],
        f"{BAD} AS bad_position",
        f"{column} AS bad_column",
        f"{kind} AS bad_type",
        f"{value} AS bad_value",
        f"format_string('column %s: value [%s] is not a %s', {column}, {value}, {kind}) AS message",
    )


def _free_names(names: list[str]) -> list[str]:
    """The input's names, those of added columns changed until they are free."""
    taken = {*DIRTY_COLUMNS, *(n.lower() for n in names)}
    out = []
    for name in names:
        if name.lower() in DIRTY_COLUMNS:
            while name.lower() in taken:
                name = f"input_{name}"
            taken.add(name.lower())
        out.append(name)
    return out


def dirty_summary(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Number of dirty rows per first failing column."""
    return summarize(dirty_rows(df, schema))


def summarize(rejected: DataFrame) -> DataFrame:
    """Number of rows of :func:`dirty_rows` per first failing column."""
    return rejected.groupBy("bad_position", "bad_column", "bad_type").agg(
        F.count(F.lit(1)).alias("dirty_rows")
    )


def _check_arity(df: DataFrame, declared: int) -> None:
    if len(df.columns) != declared:
        raise SpecError(f"{len(df.columns)} input columns for {declared} declared columns")
