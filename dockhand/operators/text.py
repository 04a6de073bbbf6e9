"""Rows as delimited text lines."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from dockhand.functions.render import NON_STRING_FIELD_CHARS, field_text, line_text
from dockhand.functions.sql import sql_any, sql_literal, sql_name


def render_lines(df: DataFrame, delimiter: str, null_value: str = "") -> DataFrame:
    """A converted frame as one ``value`` column of text lines."""
    fields = [field_text(sql_name(f.name), f.dataType, null_value) for f in df.schema]
    return df.selectExpr(f"{line_text(fields, delimiter)} AS value")


def hazards(schema: T.StructType, delimiter: str, null_value: str = "") -> tuple[str, str, str]:
    """SQL for whether a field holds the delimiter, a line break, or is the text of null.

    Nothing is escaped in a line, so such a row does not read back as it was.  That an empty
    string is the text of null is documented and no hazard.
    """
    strings = [f for f in schema if isinstance(f.dataType, T.StringType)]
    others = [f for f in schema if f not in strings] if delimiter in NON_STRING_FIELD_CHARS else []

    def holds(field: T.StructField, character: str) -> str:
        return f"contains({field_text(sql_name(field.name), field.dataType)}, {sql_literal(character)})"

    has_delimiter = sql_any([holds(f, delimiter) for f in strings + others])
    has_break = sql_any([holds(f, c) for f in strings for c in "\n\r"])
    # Other types print nothing but their value, which may also read like the marker.
    is_null_text = sql_any([
        f"({sql_name(f.name)} IS NOT NULL AND {field_text(sql_name(f.name), f.dataType)} = {sql_literal(null_value)})"
        for f in schema
    ] if null_value else [])
    return has_delimiter, has_break, is_null_text


def flag_hazards(df: DataFrame, delimiter: str, null_value: str = "") -> DataFrame:
    """The frame with ``has_delimiter``, ``has_line_break`` and ``has_null_text`` added."""
    names = ("has_delimiter", "has_line_break", "has_null_text")
    found = hazards(df.schema, delimiter, null_value)
    return df.selectExpr("*", *[f"{condition} AS {name}" for condition, name in zip(found, names)])
