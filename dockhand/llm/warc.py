"""WARC records in ZIP-packaged archives: written by tasks, read back by ranges.

An archive holds, both stored and not compressed again, ``archive/data.warc.gz`` with one
gzip member per record and ``indexes/index.cdx`` with the place of each.  The reader looks
up both in the ZIP directory and reads records by their ranges; nothing is extracted.
"""

from __future__ import annotations

import hashlib
import re
import zipfile
import zlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockhand.llm import zipdir
from dockhand.llm.common import ship_code, shuffle_partitions, text_of, written
from dockhand.llm.remote import file_system
from dockhand.plans.workspace import new_workspace

# Payloads below this many bytes are never revisits.
MIN_REVISIT = 100
# An archive is closed once its records have so many bytes, before compression.
ARCHIVE_BYTES = 64 << 20
# One read takes so many bytes of neighbouring records, or one record.
RANGE_BYTES = 2 << 20

# Names and texts of the format.
DATA_MEMBER = "archive/data.warc.gz"
INDEX_MEMBER = "indexes/index.cdx"
VERSION = "WARC/1.1"
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"
DATE = "1970-01-01T00:00:00Z"

RECORDS = (
    "archive string, page string, target_uri string, record_type string, payload_bytes long,"
    " payload_digest string, refers_to string, payload binary"
)


def with_first(
    pages: DataFrame, id_col: str, payload_col: str, min_revisit: int = MIN_REVISIT
) -> DataFrame:
    """The pages with ``_first``, the smallest id of an equal payload that has another row.

    Only payloads that repeat make rows of the joined table.  Where that is small, pages
    are not shuffled.
    """
    payload = F.encode(text_of(payload_col), "UTF-8")
    digested = pages.withColumn("_digest", F.sha2(payload, 256))
    firsts = written(
        digested.filter(F.octet_length(payload) >= min_revisit).groupBy("_digest")
        .agg(F.min(id_col).alias("_first"), F.count("*").alias("_rows"))
        .filter("_rows > 1").select(F.col("_digest").alias("_same"), "_first"),
        "warc_firsts",
    )
    return digested.join(firsts, F.col("_digest") == F.col("_same"), "left").drop("_same")


def _record(page: str | None, uri: str | None, payload: bytes, digest: str, first: str | None) -> bytes:
    http = (
        "HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\n"
        f"Content-Length: {len(payload)}\r\n\r\n"
    ).encode()
    block = http if first else http + payload
    headers = [
        VERSION, f"WARC-Type: {'revisit' if first else 'response'}", f"WARC-Date: {DATE}",
        f"WARC-Record-ID: <urn:page:{'' if page is None else page}>",
        *([f"WARC-Target-URI: {_one_line(uri)}"] if uri is not None else []),
        f"WARC-Payload-Digest: sha256:{digest}",
        *([f"WARC-Refers-To: <urn:page:{first}>", f"WARC-Profile: {REVISIT_PROFILE}"] if first else []),
        "Content-Type: application/http; msgtype=response", f"Content-Length: {len(block)}",
    ]
    return "\r\n".join(headers).encode() + b"\r\n\r\n" + block + b"\r\n\r\n"


def _one_line(text: str) -> str:
    return re.sub(r"[\x00-\x20%\x7f]", lambda m: f"%{ord(m[0]):02X}", text)


def _as_before(text: str) -> str:
    return re.sub(r"%([0-9A-F]{2})", lambda m: chr(int(m[1], 16)), text)


def write_archives(
    pages: DataFrame,
    folder: str,
    id_col: str = "page_id",
    payload_col: str = "html",
    uri_col: str = "url",
    archive_bytes: int = ARCHIVE_BYTES,
    min_revisit: int = MIN_REVISIT,
) -> DataFrame:
    """Write a record per page into archives of ``folder``; returns their paths.

    A null payload is empty.  Of equal payloads of at least ``min_revisit`` bytes the row
    with the smallest id is a response, and others are revisits of it; a row that repeats
    that id is a response too, and so are all rows when none has an id.  Columns: ``path``,
    ``records``.  Each attempt of a task writes files of its own name, and only those of
    attempts that succeeded are listed.
    """
    ship_code(pages.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        name = f"{folder}/pages-{context.partitionId():06d}-{context.taskAttemptId()}"
        rows = (r for batch in batches for r in zip(*[c.to_pylist() for c in batch.columns]))
        row, number = next(rows, None), 0
        while row is not None:
            path = f"{name}-{number:04d}.zip"
            system, place = file_system(path)
            index: list[str] = []
            with system.open_output_stream(place) as out, zipfile.ZipFile(out, "w") as archive:
                size = offset = 0
                with archive.open(DATA_MEMBER, "w", force_zip64=True) as data:
                    while row is not None and size < archive_bytes:
                        page, uri, html, digest, first = row
                        record = _record(page, uri, html.encode(), digest, first)
                        gz = zlib.compressobj(4, zlib.DEFLATED, 31)
                        member = gz.compress(record) + gz.flush()
                        data.write(member)
                        index.append(f"{offset} {len(member)}\n")
                        offset += len(member)
                        size += len(record)
                        row = next(rows, None)
                archive.writestr(INDEX_MEMBER, "".join(index))
            number += 1
            yield pa.RecordBatch.from_arrays(
                [pa.array([path]), pa.array([len(index)], pa.int64())], ["path", "records"]
            )

    found = with_first(pages, id_col, payload_col, min_revisit)
    # A row without an id is no referent, but revisits one that has.
    revisits = F.col("_first").isNotNull() & ~F.col(id_col).eqNullSafe(F.col("_first"))
    return written(
        found.select(
            F.col(id_col).cast("string"), F.col(uri_col).cast("string"), text_of(payload_col), "_digest",
            F.when(revisits, F.col("_first").cast("string")),
        ).mapInArrow(write, "path string, records long"),
        "warc_paths",
    )


def _ranges(path: str) -> Iterator[tuple[int, list[int]]]:
    """Places and lengths of neighbouring records that are read at once."""
    system, place = file_system(path)
    with system.open_input_file(place) as file:
        def read(at: int, n: int) -> bytes:
            return file.read_at(n, at)

        found = {m.name: m for m in zipdir.members(read, file.size())}
        if DATA_MEMBER not in found or INDEX_MEMBER not in found:
            raise zipdir.ZipError(f"{path} has no {DATA_MEMBER} or no {INDEX_MEMBER}")
        data, index = found[DATA_MEMBER], found[INDEX_MEMBER]
        base = zipdir.data_start(read, data)
        listed = read(zipdir.data_start(read, index), index.size)
    if zlib.crc32(listed) != index.crc32:
        raise zipdir.ZipError(f"{path}: the index is damaged")
    start, lengths = 0, []
    for line in listed.decode().splitlines():
        offset, length = map(int, line.split())
        if offset + length > data.size:
            raise zipdir.ZipError(f"{path}: a record lies outside its member")
        if lengths and (offset != start + sum(lengths) or sum(lengths) + length > RANGE_BYTES):
            yield base + start, lengths
            lengths = []
        if not lengths:
            start = offset
        lengths.append(length)
    if lengths:
        yield base + start, lengths


def _parse(record: bytes) -> tuple:
    """The columns of a record, after the archive's; its payload is checked."""
    head, _, rest = record.partition(b"\r\n\r\n")
    version, *lines = head.decode().split("\r\n")
    headers = dict(line.split(": ", 1) for line in lines)
    block = rest[: int(headers["Content-Length"])]
    http, _, payload = block.partition(b"\r\n\r\n")
    size = int(re.search(rb"Content-Length: (\d+)", http)[1])
    digest = headers["WARC-Payload-Digest"].removeprefix("sha256:")
    if version != VERSION or rest[len(block):] != b"\r\n\r\n":
        raise ValueError("a record is damaged")
    if headers["WARC-Type"] == "response" and (
        len(payload) != size or hashlib.sha256(payload).hexdigest() != digest
    ):
        raise ValueError(f"the payload of {headers['WARC-Record-ID']} is damaged")

    def page(name: str) -> str | None:
        return headers.get(name, "<urn:page:>")[len("<urn:page:"):-1] or None

    uri = headers.get("WARC-Target-URI")
    return (
        page("WARC-Record-ID"), None if uri is None else _as_before(uri), headers["WARC-Type"], size,
        digest, page("WARC-Refers-To"), payload if headers["WARC-Type"] == "response" else None,
    )


def read_archives(spark: SparkSession, paths: DataFrame) -> DataFrame:
    """The records of the archives at column ``path``; a revisit has no payload.

    Columns: ``archive``, ``page``, ``target_uri``, ``record_type``, ``payload_bytes`` and
    ``payload_digest`` (bare hexadecimal SHA-256) of the full payload, ``refers_to``,
    ``payload``.  An archive that is damaged or lacks a member fails the job.
    """
    ship_code(spark)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path in batch.column(0).to_pylist():
                found = list(_ranges(path))
                yield pa.RecordBatch.from_arrays([
                    pa.array([path] * len(found), pa.string()),
                    pa.array([f[0] for f in found], pa.int64()),
                    pa.array([f[1] for f in found], pa.list_(pa.int64())),
                ], ["path", "start", "lengths"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start, lengths in zip(*[c.to_pylist() for c in batch.columns]):
                system, place = file_system(path)
                with system.open_input_file(place) as file:
                    data = memoryview(file.read_at(sum(lengths), start))
                rows, at = [], 0
                for length in lengths:
                    rows.append((path, *_parse(zlib.decompress(data[at:at + length], 31))))
                    at += length
                columns = list(zip(*rows))
                yield pa.RecordBatch.from_arrays(
                    [pa.array(c, t) for c, t in zip(columns, _RECORD_TYPES)], _RECORD_NAMES
                )

    # The lists of archives and ranges are small and what they name is not, so their
    # partitions are counted out, or they would be merged into one task.
    tasks = max(shuffle_partitions(spark), paths.count())
    ranges = (
        paths.select("path").repartition(shuffle_partitions(spark), "path")
        .mapInArrow(locate, "path string, start long, lengths array<long>")
    )
    return ranges.repartition(tasks, "path", "start").mapInArrow(read, RECORDS)


_RECORD_NAMES = [c.strip().split(" ")[0] for c in RECORDS.split(",")]
_RECORD_TYPES = [
    {"string": pa.string(), "long": pa.int64(), "binary": pa.binary()}[c.strip().split(" ")[1]]
    for c in RECORDS.split(",")
]


def through_archives(pages: DataFrame, **options) -> DataFrame:
    """The pages' records, written to archives of a folder of their own and read back."""
    spark = pages.sparkSession
    folder = new_workspace(spark, "warc")
    return read_archives(spark, write_archives(pages, folder, **options))
