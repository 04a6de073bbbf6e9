"""What a load description may hold."""

from __future__ import annotations

import pytest
from pyspark.sql import types as T

from dockhand import LoadSpec, SpecError, parquet_schema_from_columns, schema_from_columns

GOOD = {
    "table": "db.t", "location": "/data/t", "file_prefix": "t", "file_format": "orc",
    "columns": [("a", "int")], "write_mode": "append",
}

BAD_OPTIONS = [
    {"columns": []}, {"columns": [("a", "")]}, {"columns": [("", "int")]},
    {"columns": [("a", "int"), ("A", "string")]}, {"columns": [("a", "blob")]},
    {"file_format": "csv"}, {"file_format": ""}, {"write_mode": "overwrite"}, {"write_mode": None},
    {"location": "data/t"}, {"location": "/data/*"}, {"location": "/data/?"}, {"location": ""},
    {"staging_path": "stage"}, {"staging_path": "/stage*"}, {"rejects_location": "rejects"},
    {"file_prefix": ""}, {"file_prefix": "a__b"}, {"file_prefix": "a_"}, {"file_prefix": "_a"},
    {"file_prefix": ".a"}, {"file_prefix": "a*"}, {"file_prefix": "a/b"},
    {"table": "t"}, {"table": "a.b.c"}, {"table": ""},
    {"compression": "gzip"}, {"file_format": "parquet", "compression": "bzip2"},
    {"file_format": "text"}, {"file_format": "text", "delimiter": "||"},
    {"file_format": "text", "delimiter": ""}, {"file_format": "text", "delimiter": "\n"},
    {"file_format": "text", "delimiter": "\t", "compression": "snappy"},
    {"file_format": "text", "delimiter": "N", "null_value": "\\N"},
    {"encoding": "latin-1"}, {"encoding": "no such"}, {"files": 0},
    {"partition": [("p", "int", "")]}, {"partition": [("p", "int", None)]},
    {"partition": [("p", "", "1")]}, {"partition": [("a", "int", "1")]},
    {"partition": [("p", "array", "1")]},
    {"schema": T.StructType([T.StructField("a", T.IntegerType())])},
    {"file_format": "parquet", "schema": T.StructType([T.StructField("b", T.IntegerType())])},
    {"file_format": "parquet",
     "schema": T.StructType([T.StructField("a", T.ArrayType(T.IntegerType()))])},
]


@pytest.mark.parametrize("options", BAD_OPTIONS)
def test_refused(options):
    with pytest.raises(SpecError):
        LoadSpec(**{**GOOD, **options})


def test_values_are_normalized():
    spec = LoadSpec(**{
        **GOOD, "write_mode": " nonConflict ", "file_format": "TEXT", "compression": " GZip ",
        "delimiter": "\t", "location": "hdfs://name:8020/data/t/", "encoding": " utf8 ",
    })
    assert (spec.write_mode, spec.file_format, spec.compression) == ("nonconflict", "text", "gzip")
    assert spec.location == "hdfs://name:8020/data/t"


@pytest.mark.parametrize("file_format", ["text", "orc", "parquet"])
@pytest.mark.parametrize("compression", [None, "", " ", "NONE"])
def test_no_compression(file_format, compression):
    spec = LoadSpec(**{**GOOD, "file_format": file_format, "delimiter": "|", "compression": compression})
    assert spec.compression == "none"


def test_type_names_in_any_case():
    schema = schema_from_columns([("a", "TinyInt"), ("b", " LONG "), ("c", "char")])
    assert [f.dataType for f in schema] == [T.ByteType(), T.LongType(), T.StringType()]
    assert all(f.nullable for f in schema)


def test_parquet_types():
    names = ["tinyint", "long", "decimal", "decimal(12,3)", "DECIMAL( 8 )", "binary", "varchar", "map<a,b>"]
    schema = parquet_schema_from_columns([(f"c{i}", n) for i, n in enumerate(names)])
    assert [f.dataType for f in schema] == [
        T.ByteType(), T.LongType(), T.DecimalType(10, 2), T.DecimalType(12, 3), T.DecimalType(8, 0),
        T.BinaryType(), T.StringType(), T.BinaryType(),
    ]


JOB = {
    "dbName": "ledger", "tableName": "entries", "tableType": "partition",
    "locationPath": "/ledger/entries", "path": "/scratch/in", "defaultFS": "hdfs://store:9820/",
    "fileName": "nightly", "fileType": "text", "writeMode": "truncate", "fieldDelimiter": "|",
    "compress": "bzip2",
    "column": [
        {"name": "entry", "type": "int"}, {"name": "amount", "type": "double"},
        {"name": "booked", "type": "date"},
    ],
    "parColumn": [
        {"name": "branch", "type": "string", "value": "west"},
        {"name": "shift", "type": "tinyint", "value": "3"},
    ],
}


def test_job_description():
    spec = LoadSpec.from_job(JOB)
    assert spec.table == "ledger.entries"
    assert spec.location == "hdfs://store:9820/ledger/entries"
    assert spec.staging_path == "hdfs://store:9820/scratch/in"
    assert spec.partition == (("branch", "string", "west"), ("shift", "tinyint", "3"))
    assert spec.columns == (("entry", "int"), ("amount", "double"), ("booked", "date"))


def test_job_for_a_normal_table_ignores_partition_columns():
    assert LoadSpec.from_job({**JOB, "tableType": "normal"}).partition == ()


@pytest.mark.parametrize("missing", [
    "dbName", "tableName", "tableType", "locationPath", "fileName", "fileType", "writeMode", "column",
    "parColumn", "fieldDelimiter",
])
def test_job_without_a_required_option(missing):
    with pytest.raises(SpecError):
        LoadSpec.from_job({k: v for k, v in JOB.items() if k != missing})


def test_job_with_an_unknown_table_type():
    with pytest.raises(SpecError):
        LoadSpec.from_job({**JOB, "tableType": "bucketed"})
