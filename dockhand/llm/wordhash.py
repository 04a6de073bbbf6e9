"""Hashes of the words of many texts at once, with numpy over Arrow's own buffers."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa

# Texts are hashed in portions of about so many bytes.
PORTION_BYTES = 1 << 21

_MASK = (1 << 64) - 1
_BASE = 0x9E3779B97F4A7C15  # odd, so it has an inverse modulo 2**64
_INVERSE = pow(_BASE, -1, 1 << 64)
_values = np.random.default_rng(20240229).integers(1, _MASK, 256, np.uint64, endpoint=True)
_values[ord("A"):ord("Z") + 1] = _values[ord("a"):ord("z") + 1]
_in_word = np.ones(256, bool)
_in_word[[0x20, *range(0x09, 0x0E)]] = False


def mix(x: np.ndarray) -> np.ndarray:
    """Spreads every bit over all 64."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def _powers(base: int, n: int) -> np.ndarray:
    out = np.full(n, base, np.uint64)
    out[:1] = 1
    return np.multiply.accumulate(out)


def word_hashes(data: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """64-bit hashes of all words, A-Z lower-cased, and each text's first place among them.

    Text ``i`` is the bytes ``offsets[i]`` to ``offsets[i + 1]`` of ``data``, in UTF-8; its
    words are ``hashes[first[i]:first[i + 1]]``.
    """
    inside = np.zeros(len(data) + 2, bool)
    inside[1:-1] = _in_word[data]
    begins = inside[1:-1] & ~inside[:-2]
    ends = inside[1:-1] & ~inside[2:]
    # A text's edge parts words too.
    edges = offsets[:-1][offsets[:-1] < offsets[1:]]
    begins[edges] = inside[1:-1][edges]
    lasts = offsets[1:][offsets[:-1] < offsets[1:]] - 1
    ends[lasts] = inside[1:-1][lasts]
    start, end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
    sums = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(_values[data] * _powers(_BASE, len(data)), out=sums[1:])
    hashes = (sums[end] - sums[start]) * _powers(_INVERSE, len(data) + 1)[start]
    hashes = mix(hashes + (end - start).astype(np.uint64) * np.uint64(_BASE))
    return hashes, np.searchsorted(start, offsets)


def portions(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Portions of a string column without nulls: first row, bytes, offsets."""
    kind = np.int64 if pa.types.is_large_string(texts.type) else np.int32
    buffers = texts.buffers()
    rows = len(texts)
    if not rows:
        return
    offsets = np.frombuffer(buffers[1], kind, rows + 1, texts.offset * kind().itemsize).astype(np.int64)
    data = np.frombuffer(buffers[2], np.uint8) if buffers[2] else np.zeros(0, np.uint8)
    first = 0
    while first < rows:
        last = max(first + 1, int(np.searchsorted(offsets, offsets[first] + PORTION_BYTES, "right")) - 1)
        yield first, data[offsets[first]:offsets[last]], offsets[first:last + 1] - offsets[first]
        first = last


def shingle_sets(
    data: np.ndarray, offsets: np.ndarray, width: int
) -> Iterator[np.ndarray]:
    """The distinct word shingles of each text, as sorted 64-bit hashes.

    A text of fewer than ``width`` words has its whole sequence as one; one without words
    has none.
    """
    hashes, first = word_hashes(data, offsets)
    salt = np.uint64(0xD6E8FEB86659FD93)
    # The empty sums of short texts at the end are never used.
    padded = np.concatenate((hashes, np.zeros(width, np.uint64)))
    rolled = np.zeros(len(hashes), np.uint64)
    for i in range(width):
        rolled = rolled * salt + padded[i:i + len(hashes)]
    rolled = mix(rolled)
    for a, b in zip(first[:-1].tolist(), first[1:].tolist()):
        if b - a >= width:
            yield np.unique(rolled[a:b - width + 1])
        elif b > a:
            value = np.array([b - a], np.uint64)
            for i in range(a, b):
                value = mix(value) + hashes[i:i + 1]
            yield mix(value)
        else:
            yield np.zeros(0, np.uint64)
