"""Double-array tries of equally long word sequences, walked at all text positions at once."""

from __future__ import annotations

import numpy as np

ROOT = 0
RADIX = 256
# Parents of more children get slots of their own; smaller ones fill the holes.
_LARGE = 16


class DoubleArrayTrie:
    """Sequences of ``width`` words, given as 64-bit hashes, one row each and no row twice.

    A word is its place in ``words``, written in one to three digits; a state is a slot of
    ``base`` and ``check``.  From state ``s`` digit ``c`` leads to slot ``base[s] + c`` if
    ``check`` there says ``s``.  ``accepts`` has a sequence's row number at the slot where
    it ends.
    """

    def __init__(self, sequences: np.ndarray) -> None:
        rows, self.width = sequences.shape
        self.size = rows
        self.words, symbols = np.unique(sequences, return_inverse=True)
        symbols = symbols.reshape(sequences.shape).astype(np.int64)
        self.digits = 1 + (len(self.words) > RADIX) + (len(self.words) > RADIX**2)
        digits = self._split(symbols).reshape(rows, -1)
        order = np.lexsort(digits.T[::-1])
        digits = digits[order]
        self._rng = np.random.default_rng(rows)
        self._base, self._check = np.zeros(1, np.int64), np.full(1, -1, np.int64)
        self._check[ROOT] = ROOT
        parent = np.zeros(rows, np.int64)
        for level in range(digits.shape[1]):
            opens = np.ones(rows, bool)
            opens[1:] = (parent[1:] != parent[:-1]) | (digits[1:, level] != digits[:-1, level])
            first = np.flatnonzero(opens)
            slots = self._place(parent[first], digits[first, level])
            parent = slots[np.cumsum(opens) - 1]
        self.accepts = np.full(len(self._base), -1, np.int32)
        self.accepts[parent] = order
        # Slots past the end are never looked at: every base leaves room for a digit.
        self.base, self.check = self._base.astype(np.int32), self._check.astype(np.int32)
        self.check[ROOT] = -1
        del self._base, self._check, self._rng

    def _split(self, symbols: np.ndarray) -> np.ndarray:
        """Digits of symbols along a new last axis, the highest first."""
        return np.stack(
            [symbols // RADIX**d % RADIX for d in reversed(range(self.digits))], axis=-1
        )

    def _place(self, parents: np.ndarray, digits: np.ndarray) -> np.ndarray:
        """Slots for the children of one level, those of one parent side by side."""
        states, first, sizes = np.unique(parents, return_index=True, return_counts=True)
        # Children lie in the order of their parents' rows, not of their states.
        by_row = np.argsort(first)
        states, sizes = states[by_row], sizes[by_row]
        owner = np.repeat(np.arange(len(states)), sizes)
        bases = np.zeros(len(states), np.int64)
        large = sizes > _LARGE
        start = len(self._check)
        bases[large] = start + RADIX * np.arange(int(large.sum()))
        self._grow(start + RADIX * int(large.sum()) + RADIX)
        self._take(large, owner, states, bases, digits)
        self._settle(np.flatnonzero((sizes > 1) & ~large), owner, states, bases, digits)
        single = np.flatnonzero(sizes == 1)
        if len(single):
            only = digits[np.cumsum(sizes)[single] - 1]
            # A base is not negative and leaves room for every digit.
            self._grow(len(self._check) + len(single) + 2 * RADIX)
            free = np.flatnonzero(self._check[RADIX:-RADIX] < 0) + RADIX
            bases[single] = free[:len(single)] - only
            self._take(sizes == 1, owner, states, bases, digits)
        self._base[states] = bases
        return bases[owner] + digits

    def _settle(self, waiting, owner, states, bases, digits) -> None:
        """Parents ask for bases at random until each has one whose slots are all free."""
        while len(waiting):
            mine = np.isin(owner, waiting)
            at = np.searchsorted(waiting, owner[mine])
            tried = self._rng.integers(0, len(self._check) - RADIX, len(waiting))
            slots = tried[at] + digits[mine]
            claims = np.full(len(self._check), len(waiting), np.int64)
            np.minimum.at(claims, slots, at)
            fits = (self._check[slots] < 0) & (claims[slots] == at)
            starts = np.flatnonzero(np.diff(at, prepend=-1))
            won = np.logical_and.reduceat(fits, starts)
            bases[waiting[won]] = tried[won]
            self._take(np.isin(np.arange(len(states)), waiting[won]), owner, states, bases, digits)
            if won.mean() < 0.3:
                self._grow(len(self._check) + len(slots) + RADIX)
            waiting = waiting[~won]

    def _take(self, whose, owner, states, bases, digits) -> None:
        mine = whose[owner]
        self._check[bases[owner[mine]] + digits[mine]] = states[owner[mine]]

    def _grow(self, room: int) -> None:
        more = room - len(self._base)
        if more > 0:
            self._base = np.concatenate((self._base, np.zeros(more, np.int64)))
            self._check = np.concatenate((self._check, np.full(more, -1, np.int64)))

    def symbols(self, hashes: np.ndarray) -> np.ndarray:
        """Each word's place among the words of the trie, -1 for others."""
        at = np.searchsorted(self.words, hashes)
        at[at == len(self.words)] = 0
        return np.where(self.words[at] == hashes, at, -1)

    def ending(self, symbols: np.ndarray, joined: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Positions at which a sequence begins, in order, and its row number.

        ``joined[i]`` says that word ``i + 1`` follows word ``i`` in the same piece; that of
        the last word is false.  All positions still alive take each step together.
        """
        places = np.flatnonzero(symbols >= 0)
        states = np.zeros(len(places), np.int32)
        for level in range(self.width):
            if level:
                alive = joined[places + level - 1]
                places, states = places[alive], states[alive]
                alive = symbols[places + level] >= 0
                places, states = places[alive], states[alive]
            word = symbols[places + level]
            for d in reversed(range(self.digits)):
                to = self.base[states] + word // RADIX**d % RADIX
                alive = self.check[to] == states
                places, states, word = places[alive], to[alive].astype(np.int32), word[alive]
        return places, self.accepts[states]
