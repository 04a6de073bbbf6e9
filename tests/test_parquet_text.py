"""Parquet message text."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

import dockhand
from dockhand import LoadSpec, SpecError, parse_parquet_schema
from test_spec import GOOD

ALL = """message m {
  optional int32 a; required int64 b = 7;
  OPTIONAL int96 c; optional boolean d; optional float e; optional double f;
  optional binary g; optional binary h (UTF8); optional binary i (string);
  optional fixed_len_byte_array(16) j;
  optional int32 k (INT_8); optional int32 l (INTEGER(16,true)); optional int32 m (DATE);
  optional int64 n (TIMESTAMP_MILLIS); optional int64 o (TIMESTAMP(MICROS, true));
  optional int32 p (DECIMAL(9,2)); optional int64 q (DECIMAL(18)); optional binary r (decimal(38, 10)) = 3;
  optional fixed_len_byte_array(5) s (DECIMAL(11,0));
}
"""
TYPES = (
    "int bigint timestamp boolean float double binary string string binary tinyint smallint date timestamp"
    " timestamp decimal(9,2) decimal(18,0) decimal(38,10) decimal(11,0)"
).split(" ")


def test_every_type():
    schema = parse_parquet_schema(ALL)
    assert [f.name for f in schema] == list("abcdefghijklmnopqrs")
    assert [f.dataType.simpleString() for f in schema] == TYPES
    assert [f.name for f in schema if not f.nullable] == ["b"]


@pytest.mark.parametrize("text,where,why", [
    ("", "line 1, column 1, at the end", "'message' is expected"),
    ("messages m {", "column 1, at 'messages'", "'message'"),
    ("message {", "column 9, at '{'", "the name of the message"),
    ("message m optional", "at 'optional'", "'{' is expected"),
    ("message m { }", "at '}'", "a column is expected"),
    ("message m {\n  int32 a;}", "line 2, column 3, at 'int32'", "required, optional or repeated"),
    ("message m {\n optional int a; }", "line 2, column 11, at 'int'", "the type is none of"),
    ("message m { repeated int32 a; }", "at 'repeated'", "not supported"),
    ("message m { optional group a { optional int32 b; } }", "at 'group'", "groups"),
    ("message m { optional int32 ; }", "at ';'", "a column name"),
    ("message m { optional int32 a }", "at '}'", "';' is expected"),
    ("message m { optional int32 a;", "at the end", "required, optional or repeated"),
    ("message m { optional int32 a; } x", "at 'x'", "nothing is expected"),
    ("message m { optional int32 a; optional int64 A; }", "at 'A'", "already"),
    ("message m { optional int32 a (UTF8); }", "at 'UTF8'", "UTF8 of int32"),
    ("message m { optional int32 a (UINT_8); }", "at 'UINT_8'", "not supported"),
    ("message m { optional int32 a (DECIMAL(10,2)); }", "at '10'", "from 1 to 9"),
    ("message m { optional int64 a (DECIMAL(5,6)); }", "at '6'", "above the precision"),
    ("message m { optional int64 a (DECIMAL); }", "at 'DECIMAL'", "a precision and a scale"),
    ("message m { optional double a (DECIMAL(5,2)); }", "at 'DECIMAL'", "of double"),
    ("message m { optional fixed_len_byte_array(2) a (DECIMAL(5,0)); }", "at '5'", "from 1 to 4"),
    ("message m { optional fixed_len_byte_array a; }", "at 'a'", "'(' is expected"),
    ("message m { optional fixed_len_byte_array(x) a; }", "at 'x'", "a number of bytes"),
    ("message m { optional fixed_len_byte_array(0) a; }", "", "above 0"),
    ("message m { optional int32 a = b; }", "at 'b'", "a field id"),
])
def test_what_is_wrong_and_where(text, where, why):
    with pytest.raises(SpecError) as e:
        parse_parquet_schema(text)
    assert where in str(e.value) and why in str(e.value)


def test_job_with_a_parquet_schema():
    job = {
        "dbName": "db", "tableName": "t", "tableType": "normal", "locationPath": "/t", "fileName": "t",
        "fileType": "parquet", "writeMode": "append", "fieldDelimiter": "\t",
        "parquetSchema": "message m { optional int32 a; optional binary b (DECIMAL(12,2)); }",
    }
    spec = LoadSpec.from_job(job)
    assert [tuple(c) for c in spec.columns] == [("a", "int"), ("b", "decimal(12,2)")]
    assert spec.output_schema["b"].dataType == T.DecimalType(12, 2)
    named = LoadSpec.from_job({**job, "column": [{"name": "a", "type": "string"}, {"name": "b", "type": "string"}]})
    assert named.output_schema == spec.output_schema
    with pytest.raises(SpecError, match="same columns"):
        LoadSpec.from_job({**job, "column": [{"name": "b", "type": "string"}]})
    with pytest.raises(SpecError, match="parquet files only"):
        LoadSpec.from_job({**job, "fileType": "orc"})
    assert LoadSpec.from_job({**job, "parquetSchema": " ", "column": [{"name": "a", "type": "int"}]}).schema is None


def test_spec_with_text():
    spec = LoadSpec(**{**GOOD, "file_format": "parquet", "schema": "message m { required int32 a; }"})
    assert spec.schema == T.StructType([T.StructField("a", T.IntegerType(), False)])


def test_null_in_a_required_column_is_rejected(spark, pairs, make):
    spec = make(file_format="parquet", schema="message m { required int64 k; required binary w (UTF8); }")
    result = dockhand.load(pairs, spec)
    assert (result.rows_read, result.rows_dirty) == (5, 1)
    assert [(r.k, r.bad_column, r.bad_value) for r in result.dirty.collect()] == [(3, "w", None)]
    assert spark.table(spec.table).filter("w IS NULL").count() == 0
