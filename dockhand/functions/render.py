"""Typed values as the fields of a text line, and text fields as typed values."""

from __future__ import annotations

from pyspark.sql import types as T

from dockhand.functions.sql import sql_literal, sql_name, sql_type

# Characters a field that is not a string can hold.
NON_STRING_FIELD_CHARS = set("0123456789+-.: ") | set("ENaInfinity") | set("truefals")


def field_text(value: str, data_type: T.DataType, null_value: str = "") -> str:
    """SQL of one value as the text of its field.

    Timestamps always show a fraction, so midnight ends in ``00:00:00.0``.
    """
    text = value if isinstance(data_type, T.StringType) else f"CAST({value} AS STRING)"
    if isinstance(data_type, T.TimestampType):
        text = f"concat({text}, if(unix_micros({value}) % 1000000 = 0, '.0', ''))"
    return f"coalesce({text}, {sql_literal(null_value)})"


def line_text(fields: list[str], delimiter: str) -> str:
    """SQL of the fields joined by the delimiter, nothing quoted or escaped."""
    return f"concat_ws({sql_literal(delimiter)}, {', '.join(fields)})"


def split_pattern(delimiter: str) -> str:
    """Regular expression that matches just the delimiter."""
    return "\\" + delimiter if delimiter in r".$|()[{^?*+\\" else delimiter


def parse_fields(
    schema: T.StructType, delimiter: str, null_value: str = "", line: str = "value"
) -> list[str]:
    """SQL of the typed columns read back from a text line.

    An empty field is an empty string in a string column and null in any other; a field
    a short line does not have is null.
    """
    parts = f"split({line}, {sql_literal(split_pattern(delimiter))}, -1)"
    columns = []
    for i, f in enumerate(schema):
        text = f"get({parts}, {i})"
        if null_value:
            text = f"nullif({text}, {sql_literal(null_value)})"
        if not isinstance(f.dataType, T.StringType):
            text = f"try_cast({text} AS {sql_type(f.dataType)})"
        columns.append(f"{text} AS {sql_name(f.name)}")
    return columns
