"""Time the loads at $BENCH_SF_DIR on local[$BENCH_CPUS]; prints one JSON line.

A given table is one Parquet row group, which one task reads, so a load asks for one file
per core.  The table of text columns is written beforehand, one file per core.
Every load is run once to warm up and three times for the median, and each run's rows are
counted against the input.
"""

from __future__ import annotations

import json
import os
import re
import statistics
import sys
import time
from collections.abc import Callable
from pathlib import Path

sys.path.insert(0, str(Path(__file__).resolve().parent))

import dockhand  # noqa: E402
from dockhand_queries.common import (  # noqa: E402
    LINEITEM_COLUMNS, MESSY_ORDERS, MESSY_ORDERS_COLUMNS, ORDERS_COLUMNS, from_sql, make_spec,
    new_target, table,
)
from session import local_session  # noqa: E402

DATA = os.environ.get("BENCH_SF_DIR", "/root/testdata/sf0.1")
CPUS = os.environ.get("BENCH_CPUS") or str(os.cpu_count())
RUNS = 3

# Every lineitem column as text, so that a load has all of them to convert.
LINEITEM_TEXT = (
    "SELECT " + ", ".join(f"CAST({n} AS STRING) AS {n}" for n, _ in LINEITEM_COLUMNS[:-1])
    + ", date_format(l_shipdate, 'yyyy-MM-dd HH:mm:ss') AS l_shipdate FROM {src}"
)

# 66 columns: the text columns of a line, six times.
WIDE_COLUMNS = [(f"{n}_{i}", kind) for i in range(6) for n, kind in LINEITEM_COLUMNS]
WIDE_TEXT = "SELECT " + ", ".join(
    f"{n} AS {n}_{i}" for i in range(6) for n, _ in LINEITEM_COLUMNS
) + " FROM {src}"
LATER = ("convert_66_columns", "truncate_among_20000_files")
# Files of other groups that lie in the target already, and files a load adds to them.
FILES_THERE, FILES_ADDED = 20_000, 500


def written(spark, rows):
    """The rows in one Parquet file per core, so that making them is not timed."""
    folder = new_target(spark, "bench_input").location
    rows.repartition(int(CPUS)).write.parquet(folder)
    return spark.read.parquet(folder)


def cases(spark) -> dict[str, Callable[[], None]]:
    lineitem = table(spark, DATA, "lineitem")
    lineitem_text = written(spark, from_sql(spark, DATA, "lineitem", LINEITEM_TEXT))
    orders = table(spark, DATA, "orders")
    messy = from_sql(spark, DATA, "orders", MESSY_ORDERS)
    wide_rows = spark.sql(WIDE_TEXT.replace("{src}", "{t}"), t=lineitem_text)
    lineitems, order_rows = lineitem.count(), orders.count()

    def expect(have: int, want: int) -> None:
        if have != want:
            raise AssertionError(f"{have} rows instead of {want}")

    def convert() -> None:
        schema = dockhand.schema_from_columns(LINEITEM_COLUMNS)
        dockhand.clean_rows(lineitem_text, schema).write.format("noop").mode("overwrite").save()

    def files(
        rows, file_format: str, compression: str, n: int | None = int(CPUS)
    ) -> Callable[[], None]:
        def run() -> None:
            spec = make_spec(
                new_target(spark, "bench"), LINEITEM_COLUMNS, file_format=file_format,
                compression=compression, delimiter="\t", files=n,
            )
            expect(dockhand.write_files(rows, spec).rows_written, lineitems)

        return run

    def partition() -> None:
        spec = make_spec(
            new_target(spark, "bench_partition"), ORDERS_COLUMNS, write_mode="truncate", files=int(CPUS),
            partition=[("year", "string", "2022"), ("month", "int", "10")],
        )
        dockhand.load(orders, spec)
        expect(spark.table(spec.table).count(), order_rows)

    def ingest() -> None:
        spec = make_spec(
            new_target(spark, "bench_ingest"), MESSY_ORDERS_COLUMNS, compression="snappy",
            write_mode="truncate", partition=[("year", "string", "2022"), ("month", "int", "10")],
        )
        result = dockhand.load(messy, spec)
        expect(spark.table(spec.table).count(), result.rows_written)
        expect(result.dirty.count(), result.rows_dirty)

    def wide() -> None:
        schema = dockhand.schema_from_columns(WIDE_COLUMNS)
        dockhand.clean_rows(wide_rows, schema).write.format("noop").mode("overwrite").save()

    full = []

    def into_many_files() -> None:
        if not full:
            full.append(new_target(spark, "bench_many"))
            folder = Path(full[0].location.removeprefix("file:"))
            folder.mkdir()
            for i in range(FILES_THERE):
                (folder / f"other__{i}").touch()
        spec = make_spec(full[0], ORDERS_COLUMNS, write_mode="truncate", files=FILES_ADDED)
        expect(len(dockhand.write_files(orders, spec).files), FILES_ADDED)

    return {
        "convert_text_columns": convert,
        "load_text": files(lineitem, "text", "none"),
        "load_text_gzip": files(lineitem, "text", "gzip"),
        "load_text_bzip2": files(lineitem, "text", "bzip2"),
        "load_orc": files(lineitem, "orc", "none"),
        "load_orc_snappy": files(lineitem, "orc", "snappy"),
        "load_orc_snappy_from_text": files(lineitem_text, "orc", "snappy", None),
        "load_parquet": files(lineitem, "parquet", "none"),
        "load_parquet_gzip": files(lineitem, "parquet", "gzip"),
        "load_parquet_snappy": files(lineitem, "parquet", "snappy"),
        "load_partition_multilevel": partition,
        "ingest_end_to_end": ingest,
        "convert_66_columns": wide,
        "truncate_among_20000_files": into_many_files,
    }


def measure(run: Callable[[], None]) -> list[float]:
    """Seconds of every run after the first, in order of size."""
    run()
    seconds = []
    for _ in range(RUNS):
        start = time.perf_counter()
        run()
        seconds.append(round(time.perf_counter() - start, 3))
    return sorted(seconds)


def main() -> None:
    spark = local_session("bench", CPUS, int(CPUS))
    wanted = sys.argv[1:]
    runs = {name: measure(run) for name, run in cases(spark).items() if not wanted or name in wanted}
    seconds = {name: statistics.median(s) for name, s in runs.items()}
    found = re.search(r"sf([0-9.]+)/?$", DATA)
    print(json.dumps({
        "metric": "sum of median load times",
        # The cases added later stay out of the sum, so that it can be compared.
        "value": round(sum(s for name, s in seconds.items() if name not in LATER), 3),
        "unit": "sec",
        "queries": seconds,
        "spread": {name: [s[0], s[-1]] for name, s in runs.items()},
        "sf": float(found.group(1)) if found else DATA,
    }))


if __name__ == "__main__":
    main()
