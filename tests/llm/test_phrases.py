"""Phrase collocations against plain Python, and the tries they are counted with."""

from __future__ import annotations

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from dockhand.llm import phrases
from dockhand.llm.doublearray import DoubleArrayTrie

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def counted(rows, max_words=5):
    found, totals = defaultdict(Counter), Counter()
    for lang, text in rows:
        lang = "und" if lang is None else lang
        for piece in re.split("[.,;:!?\n-\r]", (text or "").translate(LOWER)):
            words = re.findall("[^ \t]+", piece)
            totals[lang] += len(words)
            for size in range(1, max_words + 1):
                for i in range(len(words) - size + 1):
                    found[lang][tuple(words[i:i + size])] += 1
    return found, totals


def brute_force(rows, min_count, limit=2000, percent=100):
    found, totals = counted(rows)
    out = []
    for lang, f in found.items():
        candidates = {p: a for p, a in f.items() if len(p) > 1 and a >= min_count}
        gone = {
            q[i:i + size] for q, n in candidates.items() for size in range(2, len(q))
            for i in range(len(q) - size + 1) if 100 * n >= percent * f[q[i:i + size]]
        }
        ranked = []
        for p, a in candidates.items():
            if p not in gone:
                score, cut = min((1000 * a * totals[lang] // (f[p[:k]] * f[p[k:]]), k) for k in range(1, len(p)))
                ranked.append((-score, -a, " ".join(p).encode(), f[p[:cut]], f[p[cut:]]))
        for rank, (score, a, p, left, right) in enumerate(sorted(ranked)[:limit], 1):
            out.append((lang, rank, p.decode(), -a, left, right, totals[lang], -score))
    return sorted(out)


def texts(seed: int, n: int = 60) -> list[tuple]:
    rng = random.Random(seed)
    words = ["the", "of", "New", "york", "CITY", "état", "日本", "a\x00b", "x-y", "​", "\x1c", "ab", "ba"]
    ends = [" ", " ", " ", "  ", "\t", ", ", ".", "\n", "\r\n", "! ", " ?"]
    rows = [
        (rng.choice(["en", "en", "fr", None, ""]), "".join(rng.choice(words) + rng.choice(ends) for _ in range(rng.randrange(90))))
        for _ in range(n)
    ]
    return rows + [("en", None), (None, ""), ("en", " \t\n.,"), ("de", "new york city " * 300), ("de", "new york city")]


def frame(spark, rows):
    return spark.createDataFrame(
        [(i, lang, text, "x", 1) for i, (lang, text) in enumerate(rows)],
        "n long, lang string, text string, phrase string, id int",
    ).repartition(3)


def result(df, **options):
    return sorted(map(tuple, phrases.collocations(df, **options).collect()))


@pytest.mark.parametrize("seed,min_count,tries", [(1, 5, None), (2, 20, None), (3, 3, 7)])
def test_against_plain_python(spark, seed, min_count, tries):
    rows = texts(seed)
    options = {"max_sequences": tries} if tries else {}
    want = brute_force(rows, min_count)
    assert want and result(frame(spark, rows), min_count=min_count, **options) == want


def test_limit_and_absorption(spark):
    rows = texts(4)
    assert result(frame(spark, rows), min_count=4, limit=3) == brute_force(rows, 4, limit=3)
    got = result(frame(spark, rows), min_count=4, absorb_percent=50)
    assert got == brute_force(rows, 4, percent=50) != brute_force(rows, 4)


def test_long_texts_are_cut_between_pieces(spark, monkeypatch):
    rng = random.Random(6)
    long = " ".join(rng.choice(["one", "two", "three", "four."]) for _ in range(20_000))
    whole = " ".join(rng.choice(["one", "two", "three", "four"]) for _ in range(4_000))
    rows = [("en", long), ("en", whole), ("fr", long[:5000])]
    assert result(frame(spark, rows), min_count=100) == brute_force(rows, 100)
    # The same in this process, in parts that are much smaller than a text.
    monkeypatch.setattr(phrases, "PART_BYTES", 300)
    import pyarrow as pa

    batch = pa.RecordBatch.from_arrays(
        [pa.array([r[0] for r in rows]), pa.array([r[1] for r in rows])], names=["lang", "text"]
    )
    parts = list(phrases._portions(batch, 0, twice=False))
    assert len(parts) > 100 and sum(len(w.start) for w, _ in parts) == sum(len(t.split()) for _, t in rows)


def test_words_that_share_a_hash(spark, monkeypatch):
    """All is done again with other hashes."""
    seeds = []
    found = phrases._frequent_words

    def colliding(df, min_count, seed):
        seeds.append(seed)
        return found(df, min_count, seed) if seed else None

    monkeypatch.setattr(phrases, "_frequent_words", colliding)
    rows = texts(5)
    assert result(frame(spark, rows), min_count=5) == brute_force(rows, 5)
    assert seeds == [0, 1]


def test_hashes_are_of_the_word_alone():
    """Wherever a word stands, both its hashes are the same, and other words' are others."""
    import pyarrow as pa

    rng = random.Random(7)
    words = ["".join(rng.choice("abcdé") for _ in range(rng.randrange(1, 30))) for _ in range(500)]
    text = [" ".join(rng.choice(words) for _ in range(200)) for _ in range(50)]
    batch = pa.RecordBatch.from_arrays([pa.array(["en"] * 50), pa.array(text)], names=["lang", "text"])
    seen: dict[bytes, tuple] = {}
    for found, _ in phrases._portions(batch, 3, twice=True):
        for i in range(len(found.start)):
            pair = (int(found.key[i]), int(found.again[i]))
            assert seen.setdefault(found.word(i), pair) == pair
    assert len({k for k, _ in seen.values()}) == len({a for _, a in seen.values()}) == len(seen)


def test_products_beyond_64_bits(spark, monkeypatch):
    levels = spark.createDataFrame(
        [("en", "a", 1, 4 * 10**12), ("en", "b", 1, 3 * 10**12), ("en", "a b", 2, 2 * 10**12)],
        "lang string, phrase string, size int, n long",
    )
    totals = spark.createDataFrame([("en", 15 * 10**12)], "lang string, n_words long")
    monkeypatch.setattr(phrases, "frequent_phrases", lambda *a: (levels, totals))
    [row] = phrases.collocations(levels).collect()
    assert row.score == 1000 * (2 * 10**12) * (15 * 10**12) // (4 * 10**12 * 3 * 10**12) == 2500


def test_nothing_is_frequent(spark, no_docs):
    assert result(frame(spark, texts(1)), min_count=10**6) == []
    empty = spark.createDataFrame([], "lang string, text string")
    assert result(empty) == [] and phrases.collocations(empty).columns[:3] == ["lang", "rank", "phrase"]


@pytest.mark.parametrize("seed", range(40))
def test_trie(seed):
    rng = np.random.default_rng(seed)
    width, known = int(rng.integers(1, 6)), int(rng.integers(1, 700))
    words = rng.integers(1, 2**63, known + 3).astype(np.uint64)
    rows = np.unique(words[rng.zipf(1.5, (400, width)) % known], axis=0)
    rows = rows[rng.permutation(len(rows))]
    text = words[rng.zipf(1.5, 600) % (known + 3)]
    joined = rng.random(600) < 0.9
    joined[-1] = False
    trie = DoubleArrayTrie(rows)
    places, found = trie.ending(trie.symbols(text), joined)
    number = {tuple(r): i for i, r in enumerate(rows.tolist())}
    want = []
    for i in range(600 - width + 1):
        window = tuple(text[i:i + width].tolist())
        if joined[i:i + width - 1].all() and window in number:
            want.append((i, number[window]))
    assert list(zip(places.tolist(), found.tolist())) == want
