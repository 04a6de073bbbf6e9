"""Blocks of token ids, coded by mixing the predictions of three orders.

For each id, order 2 (the two ids before) and order 1 (the one before) each name the id they
expect, with a confidence; order 0 has a probability for every id.  How far each is
trusted, the mixing weights, is learnt for every combination of confidences.  The mixed
distribution drives a range coder.  All of it adapts while coding and starts anew with each
block.  A block's ids lie in lanes, stretches of the block that are coded side by side and
learn together.
"""

from __future__ import annotations

import struct
import zlib

import numpy as np

from dockhand.llm.rangecoder import Decoder, Encoder

MAX_LANES = 8192
_LANE_BITS = np.uint64(13)
_LANE_MASK = np.uint64(MAX_LANES - 1)
# Ids that a lane has, so that a block with more has more lanes.
LANE_IDS = 128
_HASH_BITS = 18
_SURE_BITS = 2
_MAX_CONFIDENCE = (1 << _SURE_BITS) - 1
_STEP = 24
_WEIGHT_STEP = 1
_WEIGHT_LIMIT = 1 << 16
# Steps between two looks at the counts of order 0.
_REFRESH = 4

_MAGIC = b"IDB2"
# Ids, size of the alphabet, lanes, words, checksum of the ids; then the checksum of all else.
_HEADER = struct.Struct("<4sIIIII")
_CHECKSUM = struct.Struct("<I")


class BlockError(ValueError):
    """A block that does not decode to what was coded."""


class _Model:
    """What has been learnt so far in a block."""

    def __init__(self, alphabet: int, lanes: int) -> None:
        self.counts = np.ones(alphabet, np.int64)
        self.below = np.zeros(alphabet + 1, np.uint64)
        self.refresh()
        # What each order expects: the id and, in the last bits, the confidence in it.
        self._kind = np.int32 if alphabet < 1 << 31 - _SURE_BITS else np.int64
        self.next1 = np.zeros(alphabet, self._kind)
        self.next2 = np.zeros(1 << _HASH_BITS, self._kind)
        kinds = (_MAX_CONFIDENCE + 1) ** 2 * 2
        # Expected by order 2, by order 1, by neither.
        self.weights = np.tile(np.array([1, 1, 2], np.int64), (kinds, 1))
        self.weights[1::2, 1] = 0
        self._edges = np.zeros((4, kinds), np.uint64)
        self.one = np.zeros(lanes, np.intp)
        self.two = np.zeros(lanes, np.intp)

    def refresh(self) -> None:
        np.cumsum(self.counts.view(np.uint64), out=self.below[1:])

    def expect(self, n: int) -> None:
        """What the first ``n`` lanes expect next."""
        one = self.one[:n]
        self.place = ((self.two[:n].astype(np.uint32) * np.uint32(0x9E3779B1)) ^ (
            one.astype(np.uint32) * np.uint32(0x85EBCA6B)
        )) >> np.uint32(32 - _HASH_BITS)
        self.place = self.place.astype(np.intp)
        self.held1, self.held2 = self.next1.take(one), self.next2.take(self.place)
        self.by1, self.by2 = self.held1 >> _SURE_BITS, self.held2 >> _SURE_BITS
        know = (self.held2 & _MAX_CONFIDENCE) * (_MAX_CONFIDENCE + 1) + (self.held1 & _MAX_CONFIDENCE)
        self.kind = (know * 2 + (self.by1 == self.by2)).astype(np.intp)
        self._edges[1:] = np.cumsum(self.weights, axis=1).T
        self.total = self._edges[3].take(self.kind)

    def outcome(self, value: np.ndarray) -> np.ndarray:
        """Which order's part of the whole a value lies in."""
        return (value >= self._edges[1].take(self.kind)).astype(np.intp) + (
            value >= self._edges[2].take(self.kind)
        )

    def interval(self, outcome: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The part of the whole that each outcome has."""
        place = outcome * len(self.weights) + self.kind
        edges = self._edges.ravel()
        start = edges.take(place)
        return start, edges.take(place + len(self.weights)) - start

    def symbol(self, ids: np.ndarray, other: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray]:
        """The parts that order 0 gives the ids of some of ``n`` lanes, and all of it to the others."""
        start, width = np.zeros(n, np.uint64), np.full(n, self.below[-1])
        first = self.below.take(ids)
        start[other] = first
        width[other] = self.below.take(ids + 1) - first
        return start, width

    def learn(self, ids: np.ndarray, outcome: np.ndarray, other: np.ndarray, step: int) -> None:
        n = len(ids)
        seen = np.bincount(self.kind * 3 + outcome, minlength=self.weights.size).reshape(-1, 3)
        self.weights += _WEIGHT_STEP * seen
        full = self.weights.sum(axis=1) > _WEIGHT_LIMIT
        if full.any():
            self.weights[full] = (self.weights[full] + 1) >> 1
            self.weights[1::2, 1] = 0
        np.add.at(self.counts, ids[other], _STEP)
        if step % _REFRESH == 0:
            self.refresh()
        now = ids.astype(self._kind)
        fresh = now << _SURE_BITS
        for place, by, held, following in (
            (self.one[:n], self.by1, self.held1, self.next1),
            (self.place, self.by2, self.held2, self.next2),
        ):
            hit = (by == now).astype(self._kind)
            # A wrong expectation goes once nothing is left of the confidence in it.
            gone = -(((held & _MAX_CONFIDENCE) | hit) == 0).astype(self._kind)
            kept = np.minimum(held + 2 * hit - 1, held | _MAX_CONFIDENCE)
            following[place] = kept ^ ((kept ^ fresh) & gone)
        self.two[:n], self.one[:n] = self.one[:n], ids


def _lanes(n: int) -> tuple[int, int, int]:
    """Lanes, ids of the longest, and how many lanes are of that length."""
    lanes = min(MAX_LANES, max(1, n // LANE_IDS))
    steps = -(-n // lanes)
    return lanes, steps, n - (steps - 1) * lanes


def _count_type(steps: int) -> np.dtype:
    """What holds the words of a lane: it moves on by at most two a step, and two end it."""
    return np.dtype("<u2" if 2 * steps + 2 < 1 << 16 else "<u4")


def _by_step(n: int) -> np.ndarray:
    """Where in the block the ids lie in the order in which they are coded."""
    lanes, steps, long = _lanes(n)
    lengths = np.full(lanes, steps - 1)
    lengths[:long] = steps
    starts = np.concatenate(([0], np.cumsum(lengths[:-1])))
    whole = (starts[None, :] + np.arange(steps - 1)[:, None]).ravel()
    return np.concatenate((whole, starts[:long] + steps - 1))


def encode_block(ids: np.ndarray) -> bytes:
    """A block of unsigned ids; it needs nothing else to be decoded."""
    ids = np.ascontiguousarray(ids, "<u4")
    n = len(ids)
    if not n:
        body, alphabet, lanes, words = b"", 0, 0, ()
    else:
        alphabet = int(ids.max()) + 1
        lanes, steps, long = _lanes(n)
        ordered = ids[_by_step(n)].astype(np.intp)
        model, coder = _Model(alphabet, lanes), Encoder(lanes)
        for step in range(steps):
            active = lanes if step < steps - 1 else long
            now = ordered[step * lanes:step * lanes + active]
            model.expect(active)
            outcome = (now != model.by2) * (1 + (now != model.by1).astype(np.intp))
            coder.put(*model.interval(outcome), model.total)
            other = np.flatnonzero(outcome == 2)
            coder.put(*model.symbol(now[other], other, active), model.below[-1])
            model.learn(now, outcome, other, step)
        words, counts = coder.finish()
        body = counts.astype(_count_type(steps)).tobytes() + words.astype("<u4").tobytes()
    head = _HEADER.pack(_MAGIC, n, alphabet, lanes, len(words), zlib.crc32(ids.tobytes()))
    return head + _CHECKSUM.pack(zlib.crc32(head + body)) + body


def decode_block(block: bytes) -> np.ndarray:
    """The ids of a block; damage is an error."""
    if len(block) < _HEADER.size + _CHECKSUM.size:
        raise BlockError("a block ends too early")
    magic, n, alphabet, lanes, n_words, ids_sum = _HEADER.unpack_from(block)
    checksum, = _CHECKSUM.unpack_from(block, _HEADER.size)
    body = block[_HEADER.size + _CHECKSUM.size:]
    whole = zlib.crc32(block[:_HEADER.size] + body) == checksum
    counted = _count_type(_lanes(n)[1] if n else 0)
    if magic != _MAGIC or len(body) != counted.itemsize * lanes + 4 * n_words or not whole:
        raise BlockError("a block is damaged")
    out = np.zeros(n, "<u4")
    if n:
        lanes, steps, long = _lanes(n)
        counts = np.frombuffer(body, counted, lanes)
        model = _Model(alphabet, lanes)
        coder = Decoder(np.frombuffer(body, "<u4", n_words, counted.itemsize * lanes), counts)
        ordered = np.zeros(n, np.uint32)
        for step in range(steps):
            active = lanes if step < steps - 1 else long
            model.expect(active)
            outcome = model.outcome(coder.where(active, model.total))
            coder.take(*model.interval(outcome))
            now = (model.by1 + (model.by2 - model.by1) * (outcome == 0)).astype(np.intp)
            other = np.flatnonzero(outcome == 2)
            value = coder.where(active, model.below[-1])
            # In order, neighbours are looked up in the same part of the table.
            value = np.sort((value[other] << _LANE_BITS) | other.astype(np.uint64))
            other = (value & _LANE_MASK).astype(np.intp)
            found = np.searchsorted(model.below, value >> _LANE_BITS, "right") - 1
            coder.take(*model.symbol(found, other, active))
            now[other] = found
            model.learn(now, outcome, other, step)
            ordered[step * lanes:step * lanes + active] = now
        out[_by_step(n)] = ordered
    if zlib.crc32(out.tobytes()) != ids_sum:
        raise BlockError("a block does not decode to its ids")
    return out
