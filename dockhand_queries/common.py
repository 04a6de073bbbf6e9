"""What the registered queries share: tables, planted errors, a registry."""

from __future__ import annotations

import uuid
from collections.abc import Callable
from dataclasses import dataclass, field

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockhand import LoadSpec
from dockhand.functions.sql import sql_literal
from dockhand.plans.workspace import new_workspace

Query = Callable[[SparkSession, str], DataFrame]


@dataclass
class Registry:
    """Queries by name, with the SQL each must agree with."""

    queries: dict[str, Query] = field(default_factory=dict)
    oracles: dict[str, str] = field(default_factory=dict)

    def add(self, name: str, sql: str) -> Callable[[Query], Query]:
        def register(query: Query) -> Query:
            self.queries[name] = query
            self.oracles[name] = sql
            return query

        return register


REGISTRY = Registry()


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def from_sql(spark: SparkSession, sf_dir: str, name: str, sql: str) -> DataFrame:
    """A SELECT over one given table, ``{src}`` standing for the table."""
    return spark.sql(sql.replace("{src}", "{t}"), t=table(spark, sf_dir, name))


def for_oracle(sql: str, name: str) -> str:
    """The same SELECT over the table's view."""
    return sql.replace("{src}", name)


# Planted errors, in SQL that means the same to both engines.

MESSY_ORDERS = """
SELECT o_orderkey,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL
       WHEN o_orderkey % 13 = 0 THEN concat(' ', CAST(o_custkey AS STRING))
       WHEN o_orderkey % 11 = 0 THEN concat(CAST(o_custkey AS STRING), '.5')
       ELSE CAST(o_custkey AS STRING) END AS custkey_raw,
  CASE WHEN o_orderkey % 19 = 0 THEN '1,5'
       WHEN o_orderkey % 23 = 0 THEN 'nan'
       WHEN o_orderkey % 41 = 0 THEN 'Infinity'
       ELSE CAST(o_totalprice AS STRING) END AS price_raw,
  CASE WHEN o_orderkey % 29 = 0 THEN '2022-13-01'
       WHEN o_orderkey % 31 = 0 THEN NULL
       WHEN o_orderkey % 43 = 0 THEN '2022'
       ELSE CAST(CAST(o_orderdate AS DATE) AS STRING) END AS date_raw,
  CASE WHEN o_orderkey % 37 = 0 THEN 'yes'
       WHEN o_orderkey % 2 = 0 THEN 'TRUE'
       ELSE 'false' END AS flag_raw
FROM {src}"""

MESSY_ORDERS_COLUMNS = [
    ("orderkey", "bigint"), ("custkey", "int"), ("totalprice", "double"),
    ("orderdate", "date"), ("flag", "boolean"),
]

MESSY_LINEITEM = """
SELECT l_orderkey, l_linenumber,
  CASE WHEN l_partkey % 7 = 0 THEN '300'
       WHEN l_partkey % 11 = 0 THEN '-128'
       WHEN l_partkey % 13 = 0 THEN '+12'
       WHEN l_partkey % 17 = 0 THEN ' 12 '
       WHEN l_partkey % 19 = 0 THEN '40000'
       WHEN l_partkey % 23 = 0 THEN '3000000000'
       WHEN l_partkey % 29 = 0 THEN '9223372036854775808'
       WHEN l_partkey % 31 = 0 THEN '1e2'
       WHEN l_partkey % 37 = 0 THEN '1.5'
       WHEN l_partkey % 41 = 0 THEN NULL
       WHEN l_partkey % 43 = 0 THEN ''
       ELSE CAST(CAST(l_quantity AS INT) AS STRING) END AS num_raw
FROM {src}"""

MESSY_EVENTS = """
SELECT event_id,
  CASE WHEN event_id % 7 = 0 THEN CAST(CAST(ts AS DATE) AS STRING)
       WHEN event_id % 11 = 0 THEN replace(CAST(ts AS STRING), ' ', 'T')
       WHEN event_id % 13 = 0 THEN concat(CAST(ts AS STRING), ' ')
       WHEN event_id % 17 = 0 THEN replace(CAST(CAST(ts AS DATE) AS STRING), '-', '/')
       WHEN event_id % 19 = 0 THEN NULL
       WHEN event_id % 23 = 0 THEN '2022-02-30 10:00:00'
       ELSE CAST(ts AS STRING) END AS ts_raw
FROM {src}"""

# Nulls in columns that all convert, for the text format.
SPARSE_ORDERS = """
SELECT o_orderkey,
  CASE WHEN o_orderkey % 17 = 0 THEN NULL ELSE o_custkey END AS o_custkey,
  CASE WHEN o_orderkey % 5 = 0 THEN NULL ELSE o_orderstatus END AS o_orderstatus,
  o_totalprice,
  CASE WHEN o_orderkey % 31 = 0 THEN NULL ELSE o_orderdate END AS o_orderdate,
  o_orderpriority
FROM {src}"""

ORDERS_COLUMNS = [
    ("o_orderkey", "bigint"), ("o_custkey", "bigint"), ("o_orderstatus", "string"),
    ("o_totalprice", "double"), ("o_orderdate", "timestamp"), ("o_orderpriority", "string"),
]

LINEITEM_COLUMNS = [
    ("l_orderkey", "bigint"), ("l_partkey", "bigint"), ("l_suppkey", "bigint"),
    ("l_linenumber", "int"), ("l_quantity", "double"), ("l_extendedprice", "double"),
    ("l_discount", "double"), ("l_tax", "double"), ("l_returnflag", "string"),
    ("l_linestatus", "string"), ("l_shipdate", "timestamp"),
]

CUSTOMER_COLUMNS = [
    ("c_custkey", "bigint"), ("c_name", "string"), ("c_nationkey", "int"),
    ("c_acctbal", "double"), ("c_mktsegment", "string"),
]

SUPPLIER_COLUMNS = [
    ("s_suppkey", "bigint"), ("s_name", "string"), ("s_nationkey", "int"), ("s_acctbal", "double"),
]

PART_COLUMNS = [
    ("p_partkey", "bigint"), ("p_name", "string"), ("p_brand", "string"), ("p_type", "string"),
    ("p_size", "int"), ("p_retailprice", "double"),
]

# One column per declared type, made of lineitem.
TWELVE_TYPES = """
SELECT l_linenumber AS c1, l_linenumber * 100 AS c2, l_linenumber * 100000 AS c3,
  l_orderkey AS c4, l_discount AS c5, l_extendedprice AS c6, l_returnflag AS c7,
  l_linestatus AS c8, concat(l_returnflag, ' ') AS c9,
  CASE WHEN l_linestatus = 'O' THEN 'True' ELSE 'FALSE' END AS c10,
  l_shipdate AS c11, l_shipdate AS c12
FROM {src}"""

TWELVE_TYPES_COLUMNS = [
    ("col1", "TINYINT"), ("col2", "SMALLINT"), ("col3", "INT"), ("col4", "BIGINT"),
    ("col5", "FLOAT"), ("col6", "DOUBLE"), ("col7", "STRING"), ("col8", "VARCHAR"),
    ("col9", "CHAR"), ("col10", "BOOLEAN"), ("col11", "DATE"), ("col12", "TIMESTAMP"),
]

# DuckDB spellings of the guards.

MOMENT_FORMAT = "%Y-%m-%d %H:%M:%S.%g"


def duck_integer(raw: str, kind: str) -> str:
    return f"CASE WHEN regexp_full_match({raw}, '[+-]?[0-9]+') THEN try_cast({raw} AS {kind}) END"


def duck_floating(raw: str, kind: str) -> str:
    return (
        f"CASE WHEN lower(trim({raw})) NOT IN ('nan','+nan','-nan','inf','+inf','-inf',"
        f"'infinity','+infinity','-infinity') OR trim({raw}) IN ('NaN','+NaN','-NaN',"
        f"'Infinity','+Infinity','-Infinity') THEN try_cast({raw} AS {kind}) END"
    )


def duck_date(raw: str) -> str:
    return (
        f"CASE WHEN regexp_full_match({raw}, '[0-9]{{4}}-[0-9]{{2}}-[0-9]{{2}}')"
        f" THEN try_cast({raw} AS DATE) END"
    )


def duck_boolean(raw: str) -> str:
    return f"CASE lower({raw}) WHEN 'true' THEN TRUE WHEN 'false' THEN FALSE END"


def duck_moment(column: str) -> str:
    """A timestamp as text with milliseconds, NULL staying NULL."""
    return f"strftime({column}, '{MOMENT_FORMAT}')"


def moment_text(column: Column) -> Column:
    """:func:`duck_moment` in Spark."""
    return F.date_format(column, "yyyy-MM-dd HH:mm:ss.SSS")


def comparable(df: DataFrame, as_text: tuple[str, ...] = ()) -> DataFrame:
    """Dates and timestamps as text and floats as doubles, so engines print alike.

    Integers and booleans with nulls are named in ``as_text``: read into Python tables, the
    engines' results hold them in different types.
    """

    def column(f: T.StructField) -> Column:
        if isinstance(f.dataType, T.TimestampType):
            return moment_text(F.col(f.name)).alias(f.name)
        if isinstance(f.dataType, T.DateType) or f.name in as_text:
            return F.col(f.name).cast("string").alias(f.name)
        if isinstance(f.dataType, T.FloatType):
            return F.col(f.name).cast("double").alias(f.name)
        return F.col(f.name)

    return df.select([column(f) for f in df.schema])


def non_null_counts(df: DataFrame, facts: list[tuple], names: list[str]) -> DataFrame:
    """One row per column: its facts under ``names`` and ``non_null``, its values counted.

    The first fact is the column's name.
    """
    counted = df.agg(*[F.count(F.col(fact[0])).alias(fact[0]) for fact in facts])
    rows = [
        F.struct(
            *[F.lit(v).alias(n) for n, v in zip(names, fact)],
            F.col(fact[0]).alias("non_null"),
        )
        for fact in facts
    ]
    return counted.select(F.inline(F.array(*rows)))


# Targets.

DATABASE = "dockhand_work"


@dataclass(frozen=True)
class Target:
    """A fresh table name and directory for one run of a query."""

    table: str
    location: str


def new_target(spark: SparkSession, name: str) -> Target:
    folder = new_workspace(spark, name)
    if not spark.catalog.databaseExists(DATABASE):
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {DATABASE} LOCATION {sql_literal(folder + '/db')}")
    return Target(f"{DATABASE}.{name}_{uuid.uuid4().hex[:8]}", f"{folder}/{name}")


def make_spec(target: Target, columns: list[tuple[str, str]], **options) -> LoadSpec:
    values = {"file_prefix": "load", "file_format": "orc", "write_mode": "append", **options}
    return LoadSpec(table=target.table, location=target.location, columns=columns, **values)
