"""Files of token ids in document order, made of independent coded blocks.

A file is a run of blocks, then an index, then a trailer.  A block holds whole documents: a
table of their ids and lengths as an Arrow stream, then their token ids (``idcodec``).  The
index gives place, size, documents and token ids of each block, so that any block can be
read alone.  Every part has a checksum.
"""

from __future__ import annotations

import struct
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockhand.llm.common import ship_code, shuffle_partitions, text_of, written
from dockhand.llm.idcodec import BlockError, decode_block, encode_block
from dockhand.llm.remote import file_system
from dockhand.llm.tokens import tokenizer
from dockhand.plans.workspace import new_workspace

# A block is closed once it has so many ids; a longer document has a block of its own.
BLOCK_IDS = 1 << 20
# Ids that a reading task has, so that more ids make more tasks.
TASK_IDS = 16 * BLOCK_IDS
# Texts are encoded in portions of about so many bytes.
PORTION_BYTES = 1 << 22

_MAGIC = b"IDF1"
# Size and checksum of a block's document table.
_TABLE = struct.Struct("<II")
# Place, size, documents, token ids of a block.
_ENTRY = struct.Struct("<QQQQ")
# Place of the index, number of blocks, checksum of the index, magic.
_TRAILER = struct.Struct("<QII4s")


def _portions(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The rows in runs by the size of their texts, the second column."""
    ends = np.cumsum(pc.binary_length(batch.column(1)).to_numpy(zero_copy_only=False), dtype=np.int64)
    breaks = np.flatnonzero(np.diff(ends // PORTION_BYTES)) + 1
    for a, b in zip([0, *breaks.tolist()], [*breaks.tolist(), batch.num_rows]):
        yield batch.slice(a, b - a)


def _pack_block(names: pa.Array, documents: list[np.ndarray]) -> bytes:
    lengths = pa.array([len(d) for d in documents], pa.int64())
    sink = pa.BufferOutputStream()
    options = pa.ipc.IpcWriteOptions(compression="zstd")
    batch = pa.RecordBatch.from_arrays([names, lengths], ["id", "length"])
    with pa.ipc.new_stream(sink, batch.schema, options=options) as writer:
        writer.write_batch(batch)
    listed = sink.getvalue().to_pybytes()
    return _TABLE.pack(len(listed), zlib.crc32(listed)) + listed + encode_block(np.concatenate(documents))


def _pack_index(entries: list[tuple[int, int, int, int]], place: int) -> bytes:
    index = b"".join(_ENTRY.pack(*e) for e in entries)
    return index + _TRAILER.pack(place, len(entries), zlib.crc32(index), _MAGIC)


def _unpack_block(data: bytes) -> tuple[pa.Array, np.ndarray, np.ndarray]:
    """The documents' ids, their lengths, and all token ids."""
    size, checksum = _TABLE.unpack_from(data)
    listed = data[_TABLE.size:_TABLE.size + size]
    if zlib.crc32(listed) != checksum:
        raise BlockError("a table of documents is damaged")
    table = pa.ipc.open_stream(listed).read_all().combine_chunks()
    ids = decode_block(data[_TABLE.size + size:])
    lengths = table["length"].to_numpy()
    if lengths.sum() != len(ids):
        raise BlockError("the documents of a block do not add up to its ids")
    return table["id"].combine_chunks(), lengths, ids


def write_id_files(
    df: DataFrame,
    folder: str,
    tokenizer_path: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    block_ids: int = BLOCK_IDS,
    special_tokens: bool = False,
) -> DataFrame:
    """Write every text's ids, then ``end_id``, in ascending order of the ids of the rows.

    The rows are range-partitioned and sorted, nulls first; rows of one id keep together in
    any order.  A null text is empty.  With ``special_tokens`` the strings of special tokens in
    a text get those tokens' ids, as the library gives by default; without, they are ordinary
    text.  Each task writes a file; an attempt has a name of its own and only files of attempts
    that succeeded are listed.  Columns: ``path``, ``part`` (the files' order), ``n_ids``.
    """
    ship_code(df.sparkSession)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        context = TaskContext.get()
        part = context.partitionId()
        path = f"{folder}/ids-{part:06d}-{context.taskAttemptId()}.idf"
        encoder, end = tokenizer(tokenizer_path, special_tokens), None
        end = np.array([end_id], encoder.id_type).tobytes()
        entries: list[tuple[int, int, int, int]] = []
        out, place = None, 0
        names: list[pa.Array] = []
        documents: list[np.ndarray] = []
        held = 0

        def flush() -> None:
            nonlocal place, held, names, documents
            block = _pack_block(pa.concat_arrays(names), documents)
            out.write(block)
            entries.append((place, len(block), len(documents), held))
            place += len(block)
            names, documents, held = [], [], 0

        for batch in batches:
            if out is None and batch.num_rows:
                system, where = file_system(path)
                out = system.open_output_stream(where)
            for portion in _portions(batch):
                encoded = encoder.encode(portion.column(1).to_pylist())
                for k, raw in enumerate(encoded):
                    documents.append(np.frombuffer(raw + end, encoder.id_type))
                    names.append(portion.column(0).slice(k, 1))
                    held += len(documents[-1])
                    if held >= block_ids:
                        flush()
        if out is None:
            return
        if documents:
            flush()
        out.write(_pack_index(entries, place))
        out.close()
        yield pa.RecordBatch.from_arrays([
            pa.array([path]), pa.array([part], pa.int32()),
            pa.array([sum(e[3] for e in entries)], pa.int64()),
        ], ["path", "part", "n_ids"])

    rows = df.select(F.col(id_col).alias("id"), text_of(text_col).alias("text"))
    ordered = rows.repartitionByRange("id").sortWithinPartitions("id")
    return written(ordered.mapInArrow(write, "path string, part int, n_ids long"), "id_files")


def _index(path: str) -> list[tuple[int, int, int, int]]:
    system, where = file_system(path)
    with system.open_input_file(where) as file:
        size = file.size()
        if size < _TRAILER.size:
            raise BlockError(f"{path} ends too early")
        place, count, checksum, magic = _TRAILER.unpack(file.read_at(_TRAILER.size, size - _TRAILER.size))
        index = file.read_at(count * _ENTRY.size, place)
    if magic != _MAGIC or zlib.crc32(index) != checksum:
        raise BlockError(f"the index of {path} is damaged")
    return list(_ENTRY.iter_unpack(index))


def read_id_files(spark: SparkSession, files: DataFrame, id_type: T.DataType) -> DataFrame:
    """The documents of files as :func:`write_id_files` lists them.

    Columns: ``id``, ``start`` (token ids of all documents before it), ``n_tokens`` and
    ``ids`` (little-endian unsigned 32-bit).  Blocks are dealt to tasks one by one.
    """
    ship_code(spark)
    schema = T.StructType([
        T.StructField("id", id_type), T.StructField("start", T.LongType()),
        T.StructField("n_tokens", T.LongType()), T.StructField("ids", T.BinaryType()),
    ])

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, start in zip(*[c.to_pylist() for c in batch.columns]):
                entries = _index(path)
                before = start + np.cumsum([0] + [e[3] for e in entries[:-1]])
                yield pa.RecordBatch.from_arrays([
                    pa.array([path] * len(entries)), pa.array([e[0] for e in entries], pa.int64()),
                    pa.array([e[1] for e in entries], pa.int64()), pa.array(before, pa.int64()),
                ], ["path", "place", "size", "start"])

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for path, place, size, start in zip(*[c.to_pylist() for c in batch.columns]):
                system, where = file_system(path)
                with system.open_input_file(where) as file:
                    names, lengths, ids = _unpack_block(file.read_at(size, place))
                ends = np.cumsum(lengths)
                raw = ids.tobytes()
                yield pa.RecordBatch.from_arrays([
                    names, pa.array(start + ends - lengths, pa.int64()), pa.array(lengths, pa.int64()),
                    pa.array([raw[4 * (e - n):4 * e] for n, e in zip(lengths, ends)], pa.binary()),
                ], [f.name for f in schema])

    # The lists of files and blocks are small and what they name is not, so their partitions
    # are counted out, or they would be merged into one task.
    total = files.agg(F.sum("n_ids")).first()[0] or 0
    tasks = max(shuffle_partitions(spark), total // TASK_IDS)
    # One row per file, so this window is small.
    before = Window.orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    located = (
        files.withColumn("start", F.coalesce(F.sum("n_ids").over(before), F.lit(0)))
        .select("path", "start").repartition(shuffle_partitions(spark), "path")
        .mapInArrow(locate, "path string, place long, size long, start long")
    )
    return located.repartition(tasks, "path", "place").mapInArrow(read, schema)


def through_id_files(
    df: DataFrame, tokenizer_path: str, end_id: int, id_col: str = "doc_id", text_col: str = "text",
    block_ids: int = BLOCK_IDS, special_tokens: bool = False,
) -> DataFrame:
    """The documents' token ids, written to files of a folder of their own and read back."""
    spark = df.sparkSession
    folder = new_workspace(spark, "ids")
    files = write_id_files(df, folder, tokenizer_path, end_id, id_col, text_col, block_ids, special_tokens)
    return read_id_files(spark, files, df.schema[id_col].dataType).withColumnRenamed("id", id_col)
