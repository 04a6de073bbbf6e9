"""Queries over projection, casts, clean and dirty rows, and declared schemas."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import dockhand
from dockhand.operators.convert import tag
from dockhand.plans.types import parquet_schema_from_columns, schema_from_columns
from dockhand_queries.common import (
    LINEITEM_COLUMNS, MESSY_EVENTS, MESSY_LINEITEM, MESSY_ORDERS, MESSY_ORDERS_COLUMNS, REGISTRY,
    comparable, duck_boolean, duck_date, duck_floating, duck_integer, duck_moment, for_oracle,
    from_sql, moment_text, non_null_counts, table,
)

RENAMED = [f"field_{i}" for i in range(1, 12)]


@REGISTRY.add(
    "positional_projection",
    "SELECT l_orderkey AS field_1, l_partkey AS field_2, l_suppkey AS field_3,"
    " l_linenumber AS field_4, l_quantity AS field_5, l_extendedprice AS field_6,"
    " l_discount AS field_7, l_tax AS field_8, l_returnflag AS field_9,"
    f" l_linestatus AS field_10, {duck_moment('l_shipdate')} AS field_11 FROM lineitem",
)
def positional_projection(spark: SparkSession, sf_dir: str) -> DataFrame:
    renamed = dockhand.project(table(spark, sf_dir, "lineitem"), RENAMED)
    return renamed.withColumn("field_11", moment_text(F.col("field_11")))


def _cast_number(type_name: str, guard) -> None:
    """Register the cast of the planted numbers to one type."""
    value = guard("num_raw", type_name.upper())
    floating = type_name in ("float", "double")
    shown = f"CAST({value} AS {'DOUBLE' if floating else 'VARCHAR'})"
    sql = (
        f"SELECT l_orderkey, l_linenumber, num_raw, {shown} AS value,"
        f" num_raw IS NOT NULL AND ({value}) IS NULL AS dirty"
        f" FROM ({for_oracle(MESSY_LINEITEM, 'lineitem')}) m"
    )

    @REGISTRY.add(f"cast_{type_name}", sql)
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        messy = from_sql(spark, sf_dir, "lineitem", MESSY_LINEITEM)
        schema = schema_from_columns(
            [("l_orderkey", "bigint"), ("l_linenumber", "int"), ("value", type_name)]
        )
        return comparable(
            tag(messy, schema).select(
                F.col("_in0").alias("l_orderkey"),
                F.col("_in1").alias("l_linenumber"),
                F.col("_in2").alias("num_raw"),
                F.col("_out2").alias("value"),
                F.col("_bad").isNotNull().alias("dirty"),
            ),
            as_text=() if floating else ("value",),
        )


for _name in ("tinyint", "smallint", "int", "bigint"):
    _cast_number(_name, duck_integer)
for _name in ("float", "double"):
    _cast_number(_name, duck_floating)


def _cast_column(messy: DataFrame, key: str, raw: str, type_name: str) -> DataFrame:
    """Key, raw text, converted value and whether it failed, for one column."""
    schema = schema_from_columns([(key, "bigint"), ("value", type_name)])
    return comparable(
        tag(messy.select(key, raw), schema).select(
            F.col("_in0").alias(key),
            F.col("_in1").alias(raw),
            F.col("_out1").alias("value"),
            F.col("_bad").isNotNull().alias("dirty"),
        ),
        as_text=("value",) if type_name == "boolean" else (),
    )


@REGISTRY.add(
    "cast_boolean",
    f"SELECT o_orderkey, flag_raw, CAST({duck_boolean('flag_raw')} AS VARCHAR) AS value,"
    f" ({duck_boolean('flag_raw')}) IS NULL AS dirty"
    f" FROM ({for_oracle(MESSY_ORDERS, 'orders')}) m",
)
def cast_boolean(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cast_column(
        from_sql(spark, sf_dir, "orders", MESSY_ORDERS), "o_orderkey", "flag_raw", "boolean"
    )


@REGISTRY.add(
    "cast_date",
    f"SELECT o_orderkey, date_raw, CAST({duck_date('date_raw')} AS VARCHAR) AS value,"
    f" date_raw IS NOT NULL AND ({duck_date('date_raw')}) IS NULL AS dirty"
    f" FROM ({for_oracle(MESSY_ORDERS, 'orders')}) m",
)
def cast_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _cast_column(
        from_sql(spark, sf_dir, "orders", MESSY_ORDERS), "o_orderkey", "date_raw", "date"
    )


@REGISTRY.add(
    "cast_string",
    "SELECT o_orderkey, CAST(o_custkey AS VARCHAR) AS custkey, o_orderstatus AS orderstatus,"
    " CAST(o_totalprice AS VARCHAR) AS totalprice,"
    " CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS orderdate FROM orders",
)
def cast_string(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.to_date("o_orderdate")
    )
    schema = schema_from_columns([
        ("o_orderkey", "bigint"), ("custkey", "string"), ("orderstatus", "char"),
        ("totalprice", "varchar"), ("orderdate", "string"),
    ])
    return dockhand.clean_rows(orders, schema)


@REGISTRY.add(
    "cast_timestamp_ms",
    "SELECT event_id, strftime(date_trunc('milliseconds', ts), '%Y-%m-%d %H:%M:%S.%f') AS ts"
    " FROM events",
)
def cast_timestamp_ms(spark: SparkSession, sf_dir: str) -> DataFrame:
    events = table(spark, sf_dir, "events").select("event_id", "ts")
    cut = dockhand.clean_rows(events, schema_from_columns([("event_id", "bigint"), ("ts", "timestamp")]))
    return cut.select("event_id", F.date_format("ts", "yyyy-MM-dd HH:mm:ss.SSSSSS").alias("ts"))


_DUCK_MOMENT = (
    "CASE WHEN regexp_full_match(ts_raw,"
    " '[0-9]{4}-[0-9]{2}-[0-9]{2}( [0-9]{2}:[0-9]{2}:[0-9]{2}([.][0-9]+)?)?')"
    " THEN date_trunc('milliseconds', try_cast(ts_raw AS TIMESTAMP)) END"
)


@REGISTRY.add(
    "cast_timestamp_text",
    f"SELECT event_id, {duck_moment(_DUCK_MOMENT)} AS value,"
    f" ts_raw IS NOT NULL AND ({_DUCK_MOMENT}) IS NULL AS dirty"
    f" FROM ({for_oracle(MESSY_EVENTS, 'events')}) m",
)
def cast_timestamp_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    messy = from_sql(spark, sf_dir, "events", MESSY_EVENTS)
    return _cast_column(messy, "event_id", "ts_raw", "timestamp").drop("ts_raw")


_DUCK_CUSTKEY = duck_integer("custkey_raw", "INTEGER")
_DUCK_PRICE = duck_floating("price_raw", "DOUBLE")
_DUCK_DATE = duck_date("date_raw")
_DUCK_FLAG = duck_boolean("flag_raw")

_BAD_COLUMN = (
    f"CASE WHEN custkey_raw IS NOT NULL AND ({_DUCK_CUSTKEY}) IS NULL THEN 'custkey'"
    f" WHEN price_raw IS NOT NULL AND ({_DUCK_PRICE}) IS NULL THEN 'totalprice'"
    f" WHEN date_raw IS NOT NULL AND ({_DUCK_DATE}) IS NULL THEN 'orderdate'"
    f" WHEN flag_raw IS NOT NULL AND ({_DUCK_FLAG}) IS NULL THEN 'flag' END"
)
TAGGED_ORDERS_SQL = (
    f"SELECT *, {_BAD_COLUMN} AS bad_column FROM ({for_oracle(MESSY_ORDERS, 'orders')}) m"
)
CLEAN_ORDERS_SQL = (
    f"SELECT o_orderkey AS orderkey, {_DUCK_CUSTKEY} AS custkey, {_DUCK_PRICE} AS totalprice,"
    f" {_DUCK_DATE} AS orderdate, {_DUCK_FLAG} AS flag"
    f" FROM ({TAGGED_ORDERS_SQL}) t WHERE bad_column IS NULL"
)


@REGISTRY.add(
    "null_passthrough",
    " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, count(*) FILTER (WHERE {raw} IS NULL) AS nulls_in,"
        f" count(*) FILTER (WHERE {raw} IS NULL AND ({value}) IS NULL) AS nulls_kept,"
        f" count(*) FILTER (WHERE {raw} IS NOT NULL AND ({value}) IS NULL) AS not_converted"
        f" FROM ({for_oracle(MESSY_ORDERS, 'orders')}) m"
        for name, raw, value in (
            ("custkey", "custkey_raw", _DUCK_CUSTKEY), ("totalprice", "price_raw", _DUCK_PRICE),
            ("orderdate", "date_raw", _DUCK_DATE), ("flag", "flag_raw", _DUCK_FLAG),
        )
    ),
)
def null_passthrough(spark: SparkSession, sf_dir: str) -> DataFrame:
    messy = from_sql(spark, sf_dir, "orders", MESSY_ORDERS)
    tagged = tag(messy, schema_from_columns(MESSY_ORDERS_COLUMNS))
    named = list(enumerate(MESSY_ORDERS_COLUMNS))[1:]
    counts = tagged.agg(*[
        F.struct(
            F.lit(name).alias("column_name"),
            F.count_if(F.col(f"_in{i}").isNull()).alias("nulls_in"),
            F.count_if(F.col(f"_in{i}").isNull() & F.col(f"_out{i}").isNull()).alias("nulls_kept"),
            F.count_if(F.col(f"_in{i}").isNotNull() & F.col(f"_out{i}").isNull()).alias("not_converted"),
        ).alias(name)
        for i, (name, _) in named
    ])
    return counts.select(F.inline(F.array(*[F.col(name) for _, (name, _) in named])))


@REGISTRY.add(
    "clean_rows",
    "SELECT orderkey, CAST(custkey AS VARCHAR) AS custkey, totalprice,"
    " CAST(orderdate AS VARCHAR) AS orderdate, flag"
    f" FROM ({CLEAN_ORDERS_SQL}) c",
)
def clean_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    messy = from_sql(spark, sf_dir, "orders", MESSY_ORDERS)
    clean = dockhand.clean_rows(messy, schema_from_columns(MESSY_ORDERS_COLUMNS))
    return comparable(clean, as_text=("custkey",))


@REGISTRY.add(
    "dirty_rows",
    "SELECT o_orderkey, custkey_raw, price_raw, date_raw, flag_raw, bad_column,"
    " CASE bad_column WHEN 'custkey' THEN 2 WHEN 'totalprice' THEN 3 WHEN 'orderdate' THEN 4"
    " ELSE 5 END AS bad_position,"
    " CASE bad_column WHEN 'custkey' THEN 'int' WHEN 'totalprice' THEN 'double'"
    " WHEN 'orderdate' THEN 'date' ELSE 'boolean' END AS bad_type,"
    " CASE bad_column WHEN 'custkey' THEN custkey_raw WHEN 'totalprice' THEN price_raw"
    " WHEN 'orderdate' THEN date_raw ELSE flag_raw END AS bad_value,"
    " 'column ' || bad_column || ': value [' || bad_value || '] is not a ' || bad_type AS message"
    f" FROM ({TAGGED_ORDERS_SQL}) t WHERE bad_column IS NOT NULL",
)
def dirty_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    messy = from_sql(spark, sf_dir, "orders", MESSY_ORDERS)
    return dockhand.dirty_rows(messy, schema_from_columns(MESSY_ORDERS_COLUMNS))


@REGISTRY.add(
    "dirty_summary",
    "SELECT CASE bad_column WHEN 'custkey' THEN 2 WHEN 'totalprice' THEN 3 WHEN 'orderdate'"
    " THEN 4 ELSE 5 END AS bad_position, bad_column,"
    " CASE bad_column WHEN 'custkey' THEN 'int' WHEN 'totalprice' THEN 'double'"
    " WHEN 'orderdate' THEN 'date' ELSE 'boolean' END AS bad_type, count(*) AS dirty_rows"
    f" FROM ({TAGGED_ORDERS_SQL}) t WHERE bad_column IS NOT NULL GROUP BY ALL",
)
def dirty_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    messy = from_sql(spark, sf_dir, "orders", MESSY_ORDERS)
    return dockhand.dirty_summary(messy, schema_from_columns(MESSY_ORDERS_COLUMNS))


# The Spark types that the declared lineitem columns stand for.
LINEITEM_TYPES = [
    "bigint", "bigint", "bigint", "int", "double", "double", "double", "double", "string",
    "string", "timestamp",
]


# Orders under the names that rejected rows have, as when a table of them is loaded again.
RELOADED_REJECTS = """
SELECT o_orderkey AS bad_position, o_orderstatus AS bad_column,
  CASE WHEN o_orderkey % 7 = 0 THEN 'odd' ELSE CAST(o_custkey AS STRING) END AS message
FROM {src}"""


@REGISTRY.add(
    "dirty_rows_again",
    "SELECT o_orderkey AS input_bad_position, o_orderstatus AS input_bad_column, 'odd' AS input_message,"
    " 3 AS bad_position, 'custkey' AS bad_column, 'int' AS bad_type, 'odd' AS bad_value,"
    " 'column custkey: value [odd] is not a int' AS message FROM orders WHERE o_orderkey % 7 = 0",
)
def dirty_rows_again(spark: SparkSession, sf_dir: str) -> DataFrame:
    columns = [("orderkey", "bigint"), ("status", "string"), ("custkey", "int")]
    return dockhand.dirty_rows(
        from_sql(spark, sf_dir, "orders", RELOADED_REJECTS), schema_from_columns(columns)
    )


@REGISTRY.add(
    "schema_from_columns",
    " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, '{kind}' AS declared_type,"
        f" '{spark_type}' AS spark_type, count({name}) AS non_null FROM lineitem"
        for (name, kind), spark_type in zip(LINEITEM_COLUMNS, LINEITEM_TYPES)
    ),
)
def schema_of_columns(spark: SparkSession, sf_dir: str) -> DataFrame:
    schema = schema_from_columns(LINEITEM_COLUMNS)
    rows = dockhand.clean_rows(table(spark, sf_dir, "lineitem"), schema)
    facts = [
        (f.name, declared, f.dataType.simpleString())
        for f, (_, declared) in zip(rows.schema, LINEITEM_COLUMNS)
    ]
    return non_null_counts(rows, facts, ["column_name", "declared_type", "spark_type"])


MAPPED_ORDERS_COLUMNS = [
    ("o_orderkey", "long"), ("o_custkey", "decimal(20,0)"), ("o_orderstatus", "binary"),
    ("o_totalprice", "decimal(12,2)"), ("o_orderdate", "timestamp"), ("o_orderpriority", "blob"),
]
# The Spark types those declared names stand for.
MAPPED_ORDERS_TYPES = ["bigint", "decimal(20,0)", "binary", "decimal(12,2)", "timestamp", "binary"]


@REGISTRY.add(
    "parquet_schema_map",
    " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, '{kind}' AS declared_type, '{spark_type}' AS spark_type,"
        f" count({name}) AS non_null FROM orders"
        for (name, kind), spark_type in zip(MAPPED_ORDERS_COLUMNS, MAPPED_ORDERS_TYPES)
    ),
)
def parquet_schema_map(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    rows = dockhand.clean_rows(orders, parquet_schema_from_columns(MAPPED_ORDERS_COLUMNS))
    facts = [
        (f.name, declared, f.dataType.simpleString())
        for f, (_, declared) in zip(rows.schema, MAPPED_ORDERS_COLUMNS)
    ]
    return non_null_counts(rows, facts, ["column_name", "declared_type", "spark_type"])
