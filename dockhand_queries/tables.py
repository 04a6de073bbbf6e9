"""Queries over the target table: create, load, partitions, whole loads."""

from __future__ import annotations

import json

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import dockhand
from dockhand import LoadSpec
from dockhand.operators import tables
from dockhand.operators.convert import with_rejects
from dockhand.operators.files import Storage
from dockhand_queries.common import (
    CUSTOMER_COLUMNS, DATABASE, LINEITEM_COLUMNS, MESSY_ORDERS, MESSY_ORDERS_COLUMNS,
    ORDERS_COLUMNS, PART_COLUMNS, REGISTRY, SUPPLIER_COLUMNS, TWELVE_TYPES, TWELVE_TYPES_COLUMNS,
    comparable, duck_moment, for_oracle, from_sql, make_spec, new_target, non_null_counts, table,
)
from dockhand_queries.conversion import CLEAN_ORDERS_SQL, TAGGED_ORDERS_SQL

_ORDERS_SQL = (
    "SELECT o_orderkey, o_custkey, o_orderstatus, o_totalprice,"
    f" {duck_moment('o_orderdate')} AS o_orderdate, o_orderpriority{{more}} FROM orders"
)


@REGISTRY.add(
    "table_exists",
    "SELECT 'as created' AS spelling, true AS found, count(*) AS table_rows FROM customer"
    " UNION ALL SELECT 'upper case', true, count(*) FROM customer"
    " UNION ALL SELECT 'other table', false, 0"
    " UNION ALL SELECT 'other database', false, 0",
)
def table_exists(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_target(spark, "exists")
    dockhand.load(table(spark, sf_dir, "customer"), make_spec(target, CUSTOMER_COLUMNS))
    names = {
        "as created": target.table,
        "upper case": target.table.upper(),
        "other table": target.table + "_other",
        "other database": "other_" + target.table,
    }
    report = None
    for spelling, name in names.items():
        found = tables.table_exists(spark, name)
        rows = spark.table(name) if found else spark.table(target.table).limit(0)
        row = rows.agg(F.count(F.lit(1)).alias("table_rows")).select(
            F.lit(spelling).alias("spelling"), F.lit(found).alias("found"), "table_rows"
        )
        report = row if report is None else report.unionAll(row)
    return report


@REGISTRY.add(
    "table_location",
    "SELECT true AS location_as_asked, true AS files_below_location, count(*) AS table_rows FROM part",
)
def table_location(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_target(spark, "located")
    dockhand.load(table(spark, sf_dir, "part"), make_spec(target, PART_COLUMNS))
    location = tables.table_location(spark, target.table)
    storage = Storage(spark, location)
    asked = storage.qualified(location) == storage.qualified(target.location)
    folder = location.rsplit("/", 1)[1]
    below = F.bool_and(F.contains("_metadata.file_path", F.lit(f"/{folder}/")))
    return spark.table(target.table).agg(
        F.lit(asked).alias("location_as_asked"),
        below.alias("files_below_location"),
        F.count(F.lit(1)).alias("table_rows"),
    )


def _described_sql(source: str, facts: list[tuple[str, str, str, bool, str]]) -> str:
    return " UNION ALL ".join(
        f"SELECT '{name}' AS column_name, '{kind}' AS column_type, '{comment}' AS column_comment,"
        f" {str(is_key).lower()} AS is_partition, count({counted}) AS non_null FROM {source}"
        for name, kind, comment, is_key, counted in facts
    )


def _described(spark: SparkSession, name: str) -> DataFrame:
    """The columns of a table as the catalog has them, with their values counted."""
    facts = [
        (c.name, c.dataType, c.description or "", c.isPartition) for c in spark.catalog.listColumns(name)
    ]
    return non_null_counts(
        spark.table(name), facts, ["column_name", "column_type", "column_comment", "is_partition"]
    )


# Spark types of the twelve declared ones, in order.
_TWELVE_SPARK_TYPES = [
    "tinyint", "smallint", "int", "bigint", "float", "double", "string", "string", "string",
    "boolean", "date", "timestamp",
]
_TWELVE_FACTS = [
    (name, kind, name, False, f"c{i}")
    for i, ((name, _), kind) in enumerate(zip(TWELVE_TYPES_COLUMNS, _TWELVE_SPARK_TYPES), start=1)
]


@REGISTRY.add(
    "create_normal_table",
    _described_sql(f"({for_oracle(TWELVE_TYPES, 'lineitem')}) t", _TWELVE_FACTS),
)
def create_normal_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_target(spark, "normal")
    dockhand.load(
        from_sql(spark, sf_dir, "lineitem", TWELVE_TYPES),
        make_spec(target, TWELVE_TYPES_COLUMNS, file_format="parquet", compression="snappy"),
    )
    return _described(spark, target.table)


@REGISTRY.add(
    "create_partitioned_table",
    _described_sql(
        "lineitem",
        [(n, k, n, False, n) for n, k in LINEITEM_COLUMNS]
        + [("year", "string", "", True, "l_orderkey"), ("month", "int", "", True, "l_orderkey")],
    ),
)
def create_partitioned_table(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_target(spark, "partitioned")
    partition = [("year", "string", "2022"), ("month", "int", "10")]
    dockhand.load(
        table(spark, sf_dir, "lineitem"), make_spec(target, LINEITEM_COLUMNS, partition=partition)
    )
    return _described(spark, target.table)


_TWELVE_SQL = (
    "SELECT CAST(c1 AS TINYINT) AS col1, CAST(c2 AS SMALLINT) AS col2, CAST(c3 AS INTEGER) AS col3,"
    " c4 AS col4, CAST(CAST(c5 AS FLOAT) AS DOUBLE) AS col5, c6 AS col6, c7 AS col7, c8 AS col8,"
    " c9 AS col9, lower(c10) = 'true' AS col10, CAST(CAST(c11 AS DATE) AS VARCHAR) AS col11,"
    f" {duck_moment('c12')} AS col12 FROM ({for_oracle(TWELVE_TYPES, 'lineitem')}) t"
)


def _twelve_types(file_format: str, **options) -> None:
    @REGISTRY.add(f"twelve_types_{file_format}", _TWELVE_SQL)
    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        target = new_target(spark, f"twelve_{file_format}")
        dockhand.load(
            from_sql(spark, sf_dir, "lineitem", TWELVE_TYPES),
            make_spec(target, TWELVE_TYPES_COLUMNS, file_format=file_format, **options),
        )
        return comparable(spark.table(target.table))


_twelve_types("text", delimiter="\t")
_twelve_types("orc")
_twelve_types("parquet")


@REGISTRY.add(
    "load_normal", f"SELECT {', '.join(n for n, _ in CUSTOMER_COLUMNS)} FROM customer"
)
def load_normal(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_target(spark, "customer")
    dockhand.load(table(spark, sf_dir, "customer"), make_spec(target, CUSTOMER_COLUMNS))
    return spark.table(target.table)


@REGISTRY.add("load_partition", _ORDERS_SQL.format(more=", '2022-10-13' AS dt"))
def load_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_target(spark, "orders_dt")
    spec = make_spec(target, ORDERS_COLUMNS, partition=[("dt", "string", "2022-10-13")])
    dockhand.load(table(spark, sf_dir, "orders"), spec)
    return comparable(spark.table(target.table))


@REGISTRY.add(
    "load_partition_multilevel", _ORDERS_SQL.format(more=", '2022' AS year, 8 AS month")
)
def load_partition_multilevel(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_target(spark, "orders_ym")
    partition = [("year", "string", "2022"), ("month", "int", "08")]
    dockhand.load(
        table(spark, sf_dir, "orders"), make_spec(target, ORDERS_COLUMNS, partition=partition)
    )
    return comparable(spark.table(target.table))


_PART_NAMES = ", ".join(n for n, _ in PART_COLUMNS)
_PART_AGAIN = (
    "SELECT p_partkey, p_name, 'changed' AS p_brand, p_type, p_size, p_retailprice + 1 AS p_retailprice"
)


def _monthly_part_loads(spark: SparkSession, sf_dir: str, name: str, mode: str, **options) -> str:
    """Load two months of parts, then the second again with other prices."""
    target = new_target(spark, name)
    part = table(spark, sf_dir, "part")
    again = part.withColumns(
        {"p_brand": F.lit("changed"), "p_retailprice": F.col("p_retailprice") + 1}
    )
    for month, rows in (("10", part), ("11", part), ("11", again)):
        spec = make_spec(
            target, PART_COLUMNS, write_mode=mode, partition=[("month", "string", month)], **options
        )
        dockhand.load(rows, spec)
    return target.table


@REGISTRY.add(
    "truncate_one_partition",
    f"SELECT {_PART_NAMES}, '10' AS month FROM part"
    f" UNION ALL {_PART_AGAIN}, '11' AS month FROM part",
)
def truncate_one_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(_monthly_part_loads(spark, sf_dir, "part_truncate", "truncate"))


@REGISTRY.add(
    "swap_one_partition",
    f"SELECT {_PART_NAMES}, '10' AS month FROM part"
    f" UNION ALL {_PART_AGAIN}, '11' AS month FROM part",
)
def swap_one_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same, each partition published by a change of the catalog instead of renames."""
    return spark.table(_monthly_part_loads(spark, sf_dir, "part_swap", "truncate", swap_partition=True))


@REGISTRY.add(
    "append_one_partition",
    f"SELECT {_PART_NAMES}, '10' AS month FROM part"
    f" UNION ALL SELECT {_PART_NAMES}, '11' AS month FROM part"
    f" UNION ALL {_PART_AGAIN}, '11' AS month FROM part",
)
def append_one_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spark.table(_monthly_part_loads(spark, sf_dir, "part_append", "append"))


@REGISTRY.add(
    "nonconflict_per_partition",
    "SELECT '10' AS month, 'loaded' AS outcome, count(*) AS table_rows FROM part"
    " UNION ALL SELECT '10', 'rejected', count(*) FROM part"
    " UNION ALL SELECT '11', 'loaded', 2 * count(*) FROM part",
)
def nonconflict_per_partition(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_target(spark, "part_nonconflict")
    part = table(spark, sf_dir, "part")
    report = None
    loaded = []
    for month in ("10", "10", "11"):
        spec = make_spec(
            target, PART_COLUMNS, write_mode="nonconflict", partition=[("month", "string", month)]
        )
        try:
            dockhand.load(part, spec)
            outcome = "loaded"
            loaded.append(month)
        except dockhand.ConflictError:
            outcome = "rejected"
        row = spark.table(target.table).filter(F.col("month").isin(loaded)).agg(
            F.count(F.lit(1)).alias("table_rows")
        ).select(F.lit(month).alias("month"), F.lit(outcome).alias("outcome"), "table_rows")
        report = row if report is None else report.unionAll(row)
    return report


# Partition values and the directories they must be kept in.
_PARTITION_PATHS = {
    ("50%/50%", "a=b"): "ratio=50%25%2F50%25/rule=a%3Db",
    ("what? [x]", "q:\"r\""): "ratio=what%3F %5Bx%5D/rule=q%3A%22r%22",
    ("it's", "tab\there"): "ratio=it%27s/rule=tab%09here",
    ("back\\slash", "{c}"): "ratio=back%5Cslash/rule=%7Bc}",
    ("naïve", "日本"): "ratio=naïve/rule=日本",
}


def _quoted_for_oracle(text: str) -> str:
    return "'" + text.replace("'", "''") + "'"


@REGISTRY.add(
    "partition_path",
    " UNION ALL ".join(
        f"SELECT {_quoted_for_oracle(ratio)} AS ratio, {_quoted_for_oracle(rule)} AS rule,"
        f" {_quoted_for_oracle(path)} AS directory, count(*) AS partition_rows FROM supplier"
        for (ratio, rule), path in _PARTITION_PATHS.items()
    ),
)
def partition_path(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_target(spark, "odd_keys")
    supplier = table(spark, sf_dir, "supplier")
    for ratio, rule in _PARTITION_PATHS:
        partition = [("ratio", "string", ratio), ("rule", "string", rule)]
        dockhand.load(supplier, make_spec(target, SUPPLIER_COLUMNS, partition=partition))
    below = F.regexp_extract(F.url_decode("_metadata.file_path"), "(ratio=[^/]*/rule=[^/]*)/", 1)
    return spark.table(target.table).groupBy("ratio", "rule", below.alias("directory")).agg(
        F.count(F.lit(1)).alias("partition_rows")
    )


# A job description: seven columns of orders, gzip text, a three-level partition.
_JOB = """
{"column": [
   {"name": "order_no", "type": "bigint"}, {"name": "buyer", "type": "int"},
   {"name": "total", "type": "double"}, {"name": "placed_on", "type": "date"},
   {"name": "urgent", "type": "boolean"}, {"name": "state", "type": "char"},
   {"name": "remark", "type": "varchar"}],
 "writeMode": "truncate", "fieldDelimiter": "|", "compress": "gzip", "fileType": "text",
 "fileName": "nightly", "tableType": "partition",
 "parColumn": [{"name": "region", "type": "string", "value": "north/east"},
               {"name": "day", "type": "date", "value": "2024-02-29"},
               {"name": "run", "type": "smallint", "value": "007"}]}
"""

_JOB_SOURCE = """
SELECT o_orderkey AS a, o_custkey AS b, o_totalprice AS c,
  CAST(CAST(o_orderdate AS DATE) AS STRING) AS d,
  CASE WHEN o_orderkey % 2 = 0 THEN 'true' ELSE 'false' END AS e, o_orderstatus AS f,
  CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE o_orderpriority END AS g
FROM {src}"""


@REGISTRY.add(
    "job_description_load",
    "SELECT a AS order_no, CAST(b AS VARCHAR) AS buyer, c AS total, d AS placed_on, e AS urgent,"
    " f AS state, coalesce(g, '') AS remark, 'north/east' AS region, '2024-02-29' AS day, 7 AS run"
    f" FROM ({for_oracle(_JOB_SOURCE, 'orders')}) s",
)
def job_description_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    target = new_target(spark, "nightly")
    database, name = target.table.split(".")
    job = {**json.loads(_JOB), "dbName": database, "tableName": name}
    spec = LoadSpec.from_job(
        {**job, "locationPath": "/unused", "path": "/unused"},
        location=target.location, staging_path=target.location + "_stage",
    )
    dockhand.load(from_sql(spark, sf_dir, "orders", _JOB_SOURCE), spec)
    return comparable(
        spark.table(target.table).withColumn("run", F.col("run").cast("int")), ("buyer", "urgent")
    )


@REGISTRY.add(
    "rejects_survive_truncate",
    f"SELECT bad_column, count(*) AS dirty_rows, (SELECT count(*) FROM ({TAGGED_ORDERS_SQL}) t"
    " WHERE bad_column IS NOT NULL) AS counted"
    f" FROM ({TAGGED_ORDERS_SQL}) t WHERE bad_column IS NOT NULL GROUP BY bad_column",
)
def rejects_survive_truncate(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Files replaced by their own converted rows; the rejected ones are still there."""
    target = new_target(spark, "replaced")
    raw = [(c, "bigint" if i == 0 else "string") for i, (c, _) in enumerate(MESSY_ORDERS_COLUMNS)]
    dockhand.write_files(from_sql(spark, sf_dir, "orders", MESSY_ORDERS), make_spec(target, raw))
    result = dockhand.write_files(
        spark.read.orc(target.location),
        make_spec(
            target, MESSY_ORDERS_COLUMNS, write_mode="truncate",
            rejects_location=target.location + "_rejects",
        ),
    )
    return result.dirty.groupBy("bad_column").agg(F.count(F.lit(1)).alias("dirty_rows")).withColumn(
        "counted", F.lit(result.rows_dirty).cast("bigint")
    )


@REGISTRY.add(
    "rejects_of_few_files",
    "SELECT l_orderkey, l_linenumber, CAST(l_quantity AS BIGINT) AS quantity, 2 AS files_read, 64 AS files"
    " FROM lineitem WHERE l_orderkey IN (SELECT unnest([min(l_orderkey), max(l_orderkey)]) FROM lineitem)",
)
def rejects_of_few_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines in 64 files by order, the first and the last order of which do not convert."""
    folder = new_target(spark, "input").location
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", "l_quantity")
    ends = lines.agg(F.min("l_orderkey"), F.max("l_orderkey")).first()
    lines.repartitionByRange(64, "l_orderkey").withColumn(
        "l_orderkey", F.when(F.col("l_orderkey").isin(*ends), F.concat(F.lit("no "), "l_orderkey"))
        .otherwise(F.col("l_orderkey").cast("string"))
    ).write.parquet(folder)
    files = spark.read.parquet(folder)
    spec = make_spec(new_target(spark, "few"), [("k", "bigint"), ("n", "int"), ("q", "double")])
    result = dockhand.write_files(files, spec)
    again = with_rejects(files, result.reject_files)
    read = again.select("_metadata.file_path").distinct().count()
    return result.dirty.select(
        F.replace("l_orderkey", F.lit("no "), F.lit("")).cast("bigint").alias("l_orderkey"), "l_linenumber",
        F.col("l_quantity").cast("bigint").alias("quantity"), F.lit(read).alias("files_read"),
        F.lit(files.select("_metadata.file_path").distinct().count()).alias("files"),
    )


@REGISTRY.add(
    "reject_limits",
    "SELECT max_share, dirty <= max_share * customers AS loaded, CASE WHEN dirty <= max_share * customers"
    " THEN customers - dirty ELSE 0 END AS table_rows FROM (SELECT count(*) AS customers,"
    " count(*) FILTER (WHERE c_custkey % 10 = 3) AS dirty FROM customer),"
    " (SELECT unnest([0.0::DOUBLE, 0.02, 0.25, 1.0]) AS max_share)",
)
def reject_limits(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customers a tenth of which does not convert, under limits of several shares."""
    customer = table(spark, sf_dir, "customer").select(
        F.expr("if(c_custkey % 10 = 3, 'x', CAST(c_custkey AS STRING))").alias("c_custkey"), "c_name"
    )
    report = []
    for share in (0.0, 0.02, 0.25, 1.0):
        target = new_target(spark, "limited")
        spec = make_spec(target, [("c_custkey", "bigint"), ("c_name", "string")], max_reject_share=share)
        loaded = _attempt(lambda: dockhand.load(customer, spec)) == "loaded"
        report.append((share, loaded, spark.table(target.table).count() if loaded else 0))
    return spark.createDataFrame(report, "max_share double, loaded boolean, table_rows bigint")


def _attempt(load) -> str:
    try:
        load()
        return "loaded"
    except dockhand.CommitError as e:
        return "not loaded: " + ("no directory" if "does not exist" in str(e) else "refused")
    except Exception:
        return "failed"


@REGISTRY.add(
    "load_attempts",
    "SELECT attempt, outcome, table_known, directory_there,"
    " times * (SELECT count(*) FROM customer) AS table_rows FROM (VALUES"
    " (1, 'failed', false, false, 0), (2, 'loaded', true, true, 1), (3, 'failed', true, true, 1),"
    " (4, 'loaded', true, true, 2), (5, 'not loaded: refused', true, true, 2),"
    " (6, 'not loaded: no directory', true, false, 0))"
    " AS a(attempt, outcome, table_known, directory_there, times)",
)
def load_attempts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """First and later loads that fail and are repeated, and targets that are not usable."""
    target = new_target(spark, "attempts")
    customer = table(spark, sf_dir, "customer")
    failing = customer.withColumn(
        "c_name", F.expr("if(c_custkey > 0, raise_error('unreadable row'), c_name)")
    )
    storage = Storage(spark, target.location)
    spec = make_spec(target, CUSTOMER_COLUMNS)

    def on_a_file() -> None:
        storage.make_empty_file(target.location + "_file")
        dockhand.load(customer, make_spec(
            type(target)(target.table + "_file", target.location + "_file"), CUSTOMER_COLUMNS
        ))

    def without_location() -> None:
        storage.move(target.location, target.location + "_away")
        dockhand.load(customer, spec)

    attempts = [
        lambda: dockhand.load(failing, spec), lambda: dockhand.load(customer, spec),
        lambda: dockhand.load(failing, spec), lambda: dockhand.load(customer, spec),
        on_a_file, without_location,
    ]
    report = []
    for number, load in enumerate(attempts, 1):
        outcome = _attempt(load)
        known, there = tables.table_exists(spark, spec.table), storage.exists(target.location)
        rows = spark.read.orc(target.location).count() if there else 0
        report.append((number, outcome, known, there, rows))
    return spark.createDataFrame(
        report,
        "attempt int, outcome string, table_known boolean, directory_there boolean, table_rows bigint",
    )


@REGISTRY.add(
    "table_mismatches",
    "SELECT attempt, accepted, customers * CASE WHEN accepted THEN 2 ELSE 1 END AS table_rows"
    " FROM (SELECT count(*) AS customers FROM customer), (VALUES ('same', true), ('other type', false), ('other name', false),"
    " ('other delimiter', false), ('other null text', false), ('other format', false))"
    " AS a(attempt, accepted)",
)
def table_mismatches(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loads into a text table under the same and under other descriptions."""
    customer = table(spark, sf_dir, "customer")
    text = {"file_format": "text", "delimiter": "\t"}
    changes = {
        "same": {},
        "other type": {"columns": [*CUSTOMER_COLUMNS[:3], ("c_acctbal", "string"), CUSTOMER_COLUMNS[4]]},
        "other name": {"columns": [*CUSTOMER_COLUMNS[:4], ("segment", "string")]},
        "other delimiter": {"delimiter": "|"},
        "other null text": {"null_value": "\\N"},
        "other format": {"file_format": "orc"},
    }
    report = None
    for attempt, change in changes.items():
        target = new_target(spark, "mismatch")
        dockhand.load(customer, make_spec(target, CUSTOMER_COLUMNS, **text))
        options = {"columns": CUSTOMER_COLUMNS, **text, **change}
        outcome = _attempt(lambda: dockhand.load(customer, make_spec(target, **options)))
        row = spark.table(target.table).agg(F.count(F.lit(1)).alias("table_rows")).select(
            F.lit(attempt).alias("attempt"), F.lit(outcome == "loaded").alias("accepted"), "table_rows"
        )
        report = row if report is None else report.unionAll(row)
    return report


@REGISTRY.add(
    "load_counts",
    f"SELECT 'read' AS what, count(*) AS order_rows FROM ({TAGGED_ORDERS_SQL}) t"
    f" UNION ALL SELECT 'written', count(*) FROM ({TAGGED_ORDERS_SQL}) t WHERE bad_column IS NULL"
    f" UNION ALL SELECT 'dirty', count(*) FROM ({TAGGED_ORDERS_SQL}) t WHERE bad_column IS NOT NULL"
    + "".join(
        f" UNION ALL SELECT 'dirty in {c}', count(*) FROM ({TAGGED_ORDERS_SQL}) t WHERE bad_column = '{c}'"
        for c, _ in MESSY_ORDERS_COLUMNS[1:]
    )
    + f" UNION ALL SELECT 'in table', count(*) FROM ({CLEAN_ORDERS_SQL}) t",
)
def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The counts a load takes while it writes, next to those of the finished table."""
    target = new_target(spark, "counted")
    result = dockhand.load(
        from_sql(spark, sf_dir, "orders", MESSY_ORDERS),
        make_spec(target, MESSY_ORDERS_COLUMNS, compression="snappy"),
    )
    counts = [
        ("read", result.rows_read), ("written", result.rows_written), ("dirty", result.rows_dirty),
    ]
    taken = spark.createDataFrame(counts, "what string, order_rows bigint")
    by_column = result.dirty_by_column.select(
        F.concat(F.lit("dirty in "), "bad_column").alias("what"), F.col("dirty_rows").alias("order_rows")
    )
    in_table = spark.table(target.table).agg(F.count(F.lit(1)).alias("order_rows"))
    return taken.unionAll(by_column).unionAll(
        in_table.select(F.lit("in table").alias("what"), "order_rows")
    )


@REGISTRY.add(
    "ingest_end_to_end",
    "SELECT '2022' AS year, 10 AS month, flag,"
    " CAST(extract(year FROM orderdate) AS VARCHAR) AS order_year,"
    " count(*) AS order_rows, count(custkey) AS with_customer,"
    " count(*) FILTER (WHERE isinf(totalprice)) AS unbounded_prices,"
    " min(totalprice) AS lowest_price,"
    " max(CASE WHEN isinf(totalprice) THEN NULL ELSE totalprice END) AS highest_price"
    f" FROM ({CLEAN_ORDERS_SQL}) c GROUP BY flag, order_year",
)
def ingest_end_to_end(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Messy text in, a partitioned ORC table out, and a report over the table."""
    target = new_target(spark, "ingest")
    spec = make_spec(
        target, MESSY_ORDERS_COLUMNS, compression="snappy", write_mode="truncate",
        partition=[("year", "string", "2022"), ("month", "int", "10")],
    )
    dockhand.load(from_sql(spark, sf_dir, "orders", MESSY_ORDERS), spec)
    unbounded = F.abs("totalprice") == F.lit(float("inf"))
    return (
        spark.table(target.table)
        .groupBy("year", "month", "flag", F.year("orderdate").cast("string").alias("order_year"))
        .agg(
            F.count(F.lit(1)).alias("order_rows"),
            F.count("custkey").alias("with_customer"),
            F.count_if(unbounded).alias("unbounded_prices"),
            F.min("totalprice").alias("lowest_price"),
            F.max(F.when(~unbounded, F.col("totalprice"))).alias("highest_price"),
        )
    )
