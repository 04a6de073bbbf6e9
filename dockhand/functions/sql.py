"""Pieces of SQL text.

Expressions are built as SQL text and handed to Spark in one call per projection: a wide
table has hundreds of small expressions, and building each through the column API costs
several round trips to the JVM apiece.
"""

from __future__ import annotations

from pyspark.sql import types as T


def sql_literal(text: str) -> str:
    """Text as a SQL string literal."""
    return "'" + text.replace("\\", "\\\\").replace("'", "\\'") + "'"


def sql_name(*parts: str) -> str:
    """A possibly qualified name, quoted."""
    return ".".join("`" + p.replace("`", "``") + "`" for p in parts)


def sql_type(data_type: T.DataType) -> str:
    """A type by a name that does not depend on session settings."""
    if isinstance(data_type, T.TimestampType):
        return "timestamp_ltz"
    return data_type.simpleString()


def sql_any(conditions: list[str]) -> str:
    """Whether at least one condition holds."""
    return " OR ".join(f"({c})" for c in conditions) or "false"
