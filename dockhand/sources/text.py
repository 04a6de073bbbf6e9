"""Typed reading of delimited text files."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T

from dockhand.functions.render import parse_fields


def parse_lines(
    lines: DataFrame, schema: T.StructType, delimiter: str, null_value: str = ""
) -> DataFrame:
    """Typed columns of a frame whose ``value`` column holds text lines."""
    return lines.selectExpr(*parse_fields(schema, delimiter, null_value))


def read_text(
    spark: SparkSession, path: str, schema: T.StructType, delimiter: str, null_value: str = ""
) -> DataFrame:
    """Typed columns of the text files in a directory; suffixes tell the codec."""
    lines = spark.read.option("lineSep", "\n").text(path)
    return parse_lines(lines, schema, delimiter, null_value)
