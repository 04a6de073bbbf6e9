"""Invented texts."""

from __future__ import annotations

import random

LETTERS = "abcdefghijklmnop"

# What operators add, and what they use on the way.
ADDED = ["score", "n_lines", "rate", "copy", "licences", "n_words", "n_copies"]
CLASHING = [
    *ADDED, "draws", "cdf", "mean", "doc", "version", "dropped", "file", "place", "bucket", "bitmap", "row",
    "class", "sid", "gram", "target", "raw", "in_0", "in_1", "_row", "_file", "_place", "_maybe", "_id", "_doc",
    "_text", "_words", "_hashes", "_filled", "_grams", "_pairs", "_windows", "_ordered", "_places", "_trusted",
    "_weights", "_sum", "_own", "_raw", "_target", "_totals", "_all", "_ends", "_rate", "_runs", "_source",
    "_key", "_lines", "_version", "_own_version", "_dropped", "_parts", "_sequence", "_ids", "_matched",
]


def prose(rng: random.Random, n: int, vocabulary: int = 400) -> str:
    """Invented words; the same numbers give the same words."""
    return " ".join(
        "".join(LETTERS[(k >> s) & 15] for s in (0, 4, 8)) for k in (rng.randrange(vocabulary) for _ in range(n))
    )
