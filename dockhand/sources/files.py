"""The files of a directory, on the driver and as a DataFrame."""

from __future__ import annotations

import re
from concurrent.futures import ThreadPoolExecutor
from typing import Any, NamedTuple

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Listings are waits on the file system, so many run at once.
LISTING_THREADS = 32

# The JVM's printed form of a file's status, after its path.
STATUS = re.compile(r"; isDirectory=(true|false); length=(\d+);.*? modification_time=(\d+);", re.DOTALL)


class Entry(NamedTuple):
    """A file or a subdirectory; ``modified`` is in milliseconds."""

    path: str
    name: str
    is_directory: bool
    length: int
    modified: int


def entries(spark: SparkSession, directory: str, prefix: str = "") -> list[Entry]:
    """Everything directly in a directory, or what is named ``<prefix>__*`` there.

    Empty and hidden files and subdirectories are included, and no file is opened.  A
    directory that does not exist has nothing.
    """
    hadoop = spark._jvm.org.apache.hadoop
    path = hadoop.fs.Path(directory)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    only = [hadoop.fs.GlobFilter(f"{prefix}__*")] if prefix else []
    statuses = system.listStatus(path, *only)
    return _printed(spark, statuses) or [_entry(s) for s in statuses]


def _entry(status: Any) -> Entry:
    path = status.getPath()
    return Entry(
        path.toString(), path.getName(), status.isDirectory(), status.getLen(),
        status.getModificationTime(),
    )


def _printed(spark: SparkSession, statuses: Any) -> list[Entry]:
    """The entries out of the printed statuses, which is one call for all of them.

    The paths come from a list in which commas are escaped, so that any name is read right.
    Empty where the statuses print in another form.
    """
    jvm, size = spark._jvm, len(statuses)
    if not size:
        return []
    # The gateway passes an array to a method of objects only as an array of objects.
    objects = spark.sparkContext._gateway.new_array(jvm.java.lang.Object, size)
    jvm.java.lang.System.arraycopy(statuses, 0, objects, 0, size)
    conf = jvm.org.apache.hadoop.mapred.JobConf(False)
    jvm.org.apache.hadoop.mapred.FileInputFormat.setInputPaths(
        conf, jvm.org.apache.hadoop.fs.FileUtil.stat2Paths(statuses)
    )
    listed = conf.getRaw("mapreduce.input.fileinputformat.inputdir")
    paths = [re.sub(r"\\(.)", r"\1", p) for p in re.findall(r"(?:[^,\\]|\\.)+", listed, re.DOTALL)]
    printed, at, found = jvm.java.util.Arrays.toString(objects), 0, []
    for path in paths:
        start = printed.find("path=" + path, at)
        match = STATUS.match(printed, start + len("path=" + path)) if start >= 0 else None
        if not match:
            return []
        at = match.end()
        found.append(
            Entry(path, path.rsplit("/", 1)[1], match[1] == "true", int(match[2]), int(match[3]))
        )
    return found if len(found) == size else []


def list_files(spark: SparkSession, directory: str, recursive: bool = False) -> DataFrame:
    """``path``, ``file_name``, ``length`` and ``modified`` of each file of a directory.

    Empty and hidden files are listed like others.  Subdirectories are gone into only when
    ``recursive``, level by level, many of a level at once.
    """
    found, level = [], [directory]
    with ThreadPoolExecutor(max_workers=LISTING_THREADS) as pool:
        while level:
            below = []
            for listed in pool.map(lambda path: entries(spark, path), level):
                found += [e for e in listed if not e.is_directory]
                below += [e.path for e in listed if e.is_directory and recursive]
            level = below
    return _frame(spark, found)


def list_group(spark: SparkSession, directory: str, prefix: str) -> DataFrame:
    """:func:`list_files` of the one load group ``<prefix>__*``, direct children only."""
    return _frame(spark, [e for e in entries(spark, directory, prefix) if not e.is_directory])


def _frame(spark: SparkSession, found: list[Entry]) -> DataFrame:
    rows = [(e.path, e.name, e.length, e.modified) for e in found]
    listed = spark.createDataFrame(rows, "path string, file_name string, length bigint, modified bigint")
    return listed.withColumn("modified", F.timestamp_millis("modified"))

