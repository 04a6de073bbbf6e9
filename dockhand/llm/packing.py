"""Packing token ids into windows of a fixed length.

Each task packs the documents of its partition, in portions of a bounded number of tokens,
so nothing is shuffled and nothing grows with the input.  A document's full windows go as
they are.  For what remains, combinations of one to three lengths that fill a window
exactly are enumerated once; non-negative least squares finds how often each must be
repeated to use up the portion's histogram of lengths; the counts are rounded, and the
pieces left over are packed greedily, cut where nothing fits.
"""

from __future__ import annotations

import bisect
from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockhand.llm.common import ship_code, text_of
from dockhand.llm.tokens import tokenizer

WINDOW = 2048
# A portion is packed once it has so many tokens; held as 16-bit ids, that is 16 MB.
PORTION_TOKENS = 8_000_000
# Of combinations of three, only those whose shortest length is a multiple of this.
TRIPLE_STEP = 64
ROUNDS = 60


@lru_cache
def combinations(window: int, step: int = TRIPLE_STEP) -> np.ndarray:
    """Rows of three lengths, 0 for none, that add up to ``window``."""
    pairs = [(0, a, window - a) for a in range(1, window // 2 + 1)]
    triples = [
        (a, b, window - a - b)
        for a in range(step, window // 3 + 1, step)
        for b in range(a, (window - a) // 2 + 1)
    ]
    return np.array(pairs + triples or [(0, 0, window)], np.int64).reshape(-1, 3)


def repeat_counts(histogram: np.ndarray, combos: np.ndarray, rounds: int = ROUNDS) -> np.ndarray:
    """Non-negative least squares: how often to use each combination.

    Minimises the squared difference between the pieces used and ``histogram`` by
    multiplicative updates, which keep every count at 0 or above.
    """
    size = len(histogram)
    wanted = histogram.astype(float)
    wanted[0] = 0.0
    flat = combos.ravel()
    target = wanted[combos].sum(axis=1)
    counts = np.where(target > 0, 1.0, 0.0)
    for _ in range(rounds):
        used = np.bincount(flat, np.repeat(counts, 3), size)
        used[0] = 0.0
        counts *= target / np.maximum(used[combos].sum(axis=1), 1e-12)
    return counts


def plan(lengths: list[int], window: int) -> list[list[tuple[int, int, int]]]:
    """Sequences of ``(piece, start, length)`` that hold all pieces, each shorter than a window.

    All are full, but for sequences of a power of two at the end.
    """
    stacks: dict[int, list[tuple[int, int]]] = {}
    for piece, length in enumerate(lengths):
        if length:
            stacks.setdefault(length, []).append((piece, 0))
    sequences = []

    def take(length: int) -> tuple[int, int, int]:
        piece, start = stacks[length].pop()
        return piece, start, length

    histogram = np.bincount([n for n in lengths if n] or [0], minlength=window + 1)
    combos = combinations(window)
    counts = np.floor(repeat_counts(histogram, combos) + 0.5).astype(np.int64)
    for k in np.argsort(-counts, kind="stable")[: np.count_nonzero(counts)].tolist():
        wanted = [n for n in combos[k].tolist() if n]
        for _ in range(int(counts[k])):
            if any(len(stacks.get(n, ())) < wanted.count(n) for n in wanted):
                break
            sequences.append([take(n) for n in wanted])

    left = sorted(n for n, stack in stacks.items() if stack)

    def use(length: int) -> tuple[int, int, int]:
        out = take(length)
        if not stacks[length]:
            left.remove(length)
        return out

    def put(piece: int, start: int, length: int) -> None:
        if not stacks.setdefault(length, []):
            bisect.insort(left, length)
        stacks[length].append((piece, start))

    while left:
        sequence = [use(left[-1])]
        space = window - sequence[0][2]
        while space and left:
            fits = bisect.bisect_right(left, space)
            if fits:
                sequence.append(use(left[fits - 1]))
            else:
                piece, start, length = use(left[-1])
                sequence.append((piece, start, space))
                put(piece, start + space, length - space)
            space -= sequence[-1][2]
        sequences += [sequence] if not space else _powers_of_two(sequence)
    return sequences


def _powers_of_two(sequence: list[tuple[int, int, int]]) -> list[list[tuple[int, int, int]]]:
    """One sequence cut into several whose lengths are powers of two, longest first."""
    out = []
    rest = list(sequence)
    while rest:
        total = sum(length for _, _, length in rest)
        space = 1 << (total.bit_length() - 1)
        out.append([])
        while space:
            piece, start, length = rest.pop(0)
            if length > space:
                rest.insert(0, (piece, start + space, length - space))
                length = space
            out[-1].append((piece, start, length))
            space -= length
    return out


def pack(
    df: DataFrame,
    tokenizer_path: str,
    end_id: int,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int = WINDOW,
    portion_tokens: int = PORTION_TOKENS,
    special_tokens: bool = False,
) -> DataFrame:
    """One row per piece of a document.

    A document is the ids of its whole text followed by ``end_id``; a null text is empty.
    With ``special_tokens`` the strings of special tokens in a text get those tokens' ids, as
    the library gives by default; without, they are ordinary text.
    Columns: the id, ``start`` and ``length`` (ids of the document before the piece, and in
    it), ``ids`` (little-endian unsigned 32-bit), ``doc_tokens``, ``sequence_id`` and
    ``offset`` in that sequence.  Sequence ids are unique but not dense, and they differ
    when the input is partitioned otherwise.  Rows of one id are documents of their own.
    """
    schema = T.StructType([
        T.StructField(id_col, df.schema[id_col].dataType),
        T.StructField("start", T.LongType()), T.StructField("length", T.LongType()),
        T.StructField("ids", T.BinaryType()), T.StructField("doc_tokens", T.LongType()),
        T.StructField("sequence_id", T.LongType()), T.StructField("offset", T.LongType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder = tokenizer(tokenizer_path, special_tokens)
        next_sequence = TaskContext.get().partitionId() << 33
        names: list = []
        documents: list[np.ndarray] = []
        held = 0

        def packed() -> Iterator[pa.RecordBatch]:
            nonlocal next_sequence
            rows = []
            for d, ids in enumerate(documents):
                for start in range(0, len(ids) - window + 1, window):
                    rows.append((d, start, window, next_sequence, 0))
                    next_sequence += 1
            tails = [len(ids) // window * window for ids in documents]
            for sequence in plan([len(ids) - t for ids, t in zip(documents, tails)], window):
                offset = 0
                for d, start, length in sequence:
                    rows.append((d, tails[d] + start, length, next_sequence, offset))
                    offset += length
                next_sequence += 1
            for i in range(0, len(rows), 4096):
                part = rows[i:i + 4096]
                yield pa.RecordBatch.from_arrays([
                    pa.array([names[r[0]] for r in part], arrow_type),
                    pa.array([r[1] for r in part], pa.int64()),
                    pa.array([r[2] for r in part], pa.int64()),
                    pa.array(
                        [documents[r[0]][r[1]:r[1] + r[2]].astype("<u4").tobytes() for r in part],
                        pa.binary(),
                    ),
                    pa.array([len(documents[r[0]]) for r in part], pa.int64()),
                    pa.array([r[3] for r in part], pa.int64()),
                    pa.array([r[4] for r in part], pa.int64()),
                ], [f.name for f in schema])

        arrow_type = None
        end = np.array([end_id], encoder.id_type).tobytes()
        for batch in batches:
            arrow_type = batch.schema.field(0).type
            for i in range(0, batch.num_rows, 512):
                texts = batch.column(1).slice(i, 512).to_pylist()
                names += batch.column(0).slice(i, 512).to_pylist()
                for raw in encoder.encode(texts):
                    documents.append(np.frombuffer(raw + end, encoder.id_type))
                    held += len(documents[-1])
                if held >= portion_tokens:
                    yield from packed()
                    names, documents, held = [], [], 0
        if documents:
            yield from packed()

    ship_code(df.sparkSession)
    return df.select(F.col(id_col), text_of(text_col).alias("text")).mapInArrow(run, schema)
