"""Declared column lists as Spark schemas."""

from __future__ import annotations

import re
from collections.abc import Iterable

from pyspark.sql import types as T

from dockhand.errors import SpecError

# The declared type names a load accepts.  VARCHAR and CHAR carry no
# length and are never padded or cut, so they are plain strings; LONG is an alias.
COLUMN_TYPES: dict[str, T.DataType] = {
    "tinyint": T.ByteType(),
    "smallint": T.ShortType(),
    "int": T.IntegerType(),
    "bigint": T.LongType(),
    "float": T.FloatType(),
    "double": T.DoubleType(),
    "timestamp": T.TimestampType(),
    "date": T.DateType(),
    "string": T.StringType(),
    "varchar": T.StringType(),
    "char": T.StringType(),
    "boolean": T.BooleanType(),
    "long": T.LongType(),
}

# Precision and scale of a DECIMAL that states neither.
DEFAULT_DECIMAL = (10, 2)

_DECIMAL = re.compile(r"decimal\s*(?:\(\s*(\d+)\s*(?:,\s*(\d+)\s*)?\))?")


def column_type(type_name: str) -> T.DataType:
    """Spark type of one declared type name, any letter case."""
    try:
        return COLUMN_TYPES[type_name.strip().lower()]
    except KeyError:
        raise SpecError(
            f"column type {type_name!r} is not supported; use one of {sorted(COLUMN_TYPES)}"
        ) from None


def parquet_column_type(type_name: str) -> T.DataType:
    """Spark type for a Parquet file schema, which knows more types than a load.

    DECIMAL and BINARY are accepted as well, and a name nobody knows is BINARY.
    """
    name = type_name.strip().lower()
    if name in COLUMN_TYPES:
        return COLUMN_TYPES[name]
    decimal = _DECIMAL.fullmatch(name)
    if decimal is None:
        return T.BinaryType()
    precision, scale = decimal.groups()
    if precision is None:
        return T.DecimalType(*DEFAULT_DECIMAL)
    return T.DecimalType(int(precision), int(scale or 0))


def schema_from_columns(columns: Iterable[tuple[str, str]]) -> T.StructType:
    """``(name, type)`` pairs as a schema; every column may be null."""
    return T.StructType([T.StructField(n, column_type(t), True) for n, t in columns])


def parquet_schema_from_columns(columns: Iterable[tuple[str, str]]) -> T.StructType:
    """``(name, type)`` pairs as a Parquet schema, see :func:`parquet_column_type`."""
    return T.StructType([T.StructField(n, parquet_column_type(t), True) for n, t in columns])
