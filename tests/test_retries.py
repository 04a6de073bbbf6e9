"""Loads whose tasks fail and are repeated, in a session that repeats them."""

from __future__ import annotations

import json
import subprocess
import sys
from pathlib import Path

ROOT = Path(__file__).resolve().parent.parent

SCRIPT = '''
import json, sys
sys.path.insert(0, sys.argv[1])
from pyspark import TaskContext
from pyspark.sql import functions as F
import dockhand
from session import local_session

spark = local_session("retries", cpus="4,4")
spark.sparkContext.setLogLevel("OFF")
spark.sql("CREATE DATABASE IF NOT EXISTS loads")
rows = spark.range(0, 20000, 1, 6).select(
    F.expr("if(id % 7 = 0, 'x', CAST(id AS STRING))").alias("k"), F.expr("CAST(id AS STRING)").alias("w")
)

def fails_twice(batches):
    yield from batches
    if TaskContext.get().attemptNumber() < 2:
        raise RuntimeError("lost")

outcome = []
for file_format in ("orc", "text"):
    for files in (None, 3):
        name = f"{file_format}_{files}"
        spec = dockhand.LoadSpec(
            table=f"loads.{name}", location=f"{sys.argv[2]}/{name}", file_prefix="load",
            file_format=file_format, delimiter="|", write_mode="append", files=files,
            columns=[("k", "bigint"), ("w", "string")],
        )
        result = dockhand.load(rows.mapInPandas(fails_twice, "k string, w string"), spec)
        table = spark.table(spec.table)
        outcome.append([
            result.rows_read, result.rows_dirty, len(result.files), table.count(),
            table.select("w").distinct().count(),
        ])
print(json.dumps(outcome))
'''


def test_repeated_tasks_neither_lose_nor_double_rows(tmp_path):
    run = subprocess.run(
        [sys.executable, "-c", SCRIPT, str(ROOT), str(tmp_path)],
        capture_output=True, text=True, timeout=300,
    )
    assert run.returncode == 0, run.stderr[-2000:]
    dirty = len(range(0, 20000, 7))
    want = [[20000, dirty, files, 20000 - dirty, 20000 - dirty] for files in (6, 3, 6, 3)]
    assert json.loads(run.stdout.strip().splitlines()[-1]) == want
