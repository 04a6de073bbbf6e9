"""A range coder for many lanes at once.

Every lane is a coder of its own, carry-less, with 64 bits of state and 32-bit output; numpy
advances all of them together.  A lane moves on by a word once its span is shorter than one,
so it never moves on by two.
"""

from __future__ import annotations

import numpy as np

_WORD = np.uint64(32)
_SHORT = np.uint64(1 << 32)
_WIDE = np.uint64(1 << 33)
_LOW_MASK = np.uint64((1 << 32) - 1)
_FULL = np.uint64((1 << 64) - 1)


def _moved(low: np.ndarray, span: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """State of lanes that move on by a word; their spans are cut where a carry would pass."""
    return low << _WORD, np.minimum(span, _SHORT - (low & _LOW_MASK)) << _WORD


class Encoder:
    def __init__(self, lanes: int) -> None:
        self._every = np.arange(lanes, dtype=np.uint16)
        self._low = np.zeros(lanes, np.uint64)
        self._span = np.full(lanes, _FULL)
        self._out: list[tuple[np.ndarray, np.ndarray]] = []

    def put(self, start: np.ndarray, width: np.ndarray, total) -> None:
        """Code the intervals ``start`` and ``width`` out of ``total`` in the first lanes.

        All of ``total`` is no news, and takes next to no room.
        """
        n = len(start)
        low, span = self._low[:n], self._span[:n]
        unit = span // total
        low += start * unit
        np.multiply(unit, width, out=span)
        moving = np.flatnonzero(span < _SHORT)
        if len(moving):
            moved = low[moving]
            self._out.append((self._every[moving], (moved >> _WORD).astype(np.uint32)))
            low[moving], span[moving] = _moved(moved, span[moving])

    def finish(self) -> tuple[np.ndarray, np.ndarray]:
        """Words of all lanes, lane after lane, and how many each lane has."""
        # One word is enough where the span holds whatever may follow it.
        wide = self._span >= _WIDE
        last = np.where(wide, self._low + _LOW_MASK, self._low)
        self._out.append((self._every, (last >> _WORD).astype(np.uint32)))
        self._out.append((self._every[~wide], (last[~wide] & _LOW_MASK).astype(np.uint32)))
        lanes = np.concatenate([x[0] for x in self._out])
        words = np.concatenate([x[1] for x in self._out])
        return words[np.argsort(lanes, kind="stable")], np.bincount(lanes, minlength=len(self._every))


class Decoder:
    def __init__(self, words: np.ndarray, counts: np.ndarray) -> None:
        self._words = np.concatenate((words, np.zeros(2, np.uint32))).astype(np.uint64)
        self._place = np.concatenate(([0], np.cumsum(counts[:-1], dtype=np.int64)))
        self._low = np.zeros(len(counts), np.uint64)
        self._span = np.full(len(counts), _FULL)
        # What is coded, less the low end of the state.
        self._code = np.zeros(len(counts), np.uint64)
        for _ in range(2):
            self._code = (self._code << _WORD) | self._words[self._place]
            self._place += 1

    def where(self, n: int, total) -> np.ndarray:
        """The place in ``0 .. total - 1`` that the next interval of the first lanes holds."""
        self._unit = self._span[:n] // total
        return np.minimum(self._code[:n] // self._unit, total - np.uint64(1))

    def take(self, start: np.ndarray, width: np.ndarray) -> None:
        """Pass the intervals that :meth:`where` was asked for."""
        n = len(start)
        low, span, code, place = self._low[:n], self._span[:n], self._code[:n], self._place[:n]
        step = start * self._unit
        low += step
        code -= step
        np.multiply(self._unit, width, out=span)
        moving = np.flatnonzero(span < _SHORT)
        if len(moving):
            # Past the end of damaged data anything may be read; the checksums tell.
            at = place[moving]
            code[moving] = (code[moving] << _WORD) | self._words.take(at, mode="clip")
            place[moving] = at + 1
            low[moving], span[moving] = _moved(low[moving], span[moving])
