"""Packing: every id once, where it says, in full sequences."""

from __future__ import annotations

import random
from collections import defaultdict

import numpy as np
import pytest
import public_tokenizers
from texts import prose
from tokenizers import Tokenizer

from dockhand.llm import packing, tokens
from dockhand.llm.queries import PACKING_END_ID

PATH = public_tokenizers.path("word_bpe_49k.json")


def library(path: str) -> Tokenizer:
    t = Tokenizer.from_file(path)
    t.encode_special_tokens = True
    return t


def check(df, window: int = 2048, **options) -> list:
    rows = packing.pack(df, PATH, PACKING_END_ID, window=window, **options).collect()
    t = library(PATH)
    texts = sorted(
        ((r.doc_id, t.encode(r.text or "", add_special_tokens=False).ids + [PACKING_END_ID]) for r in df.collect()),
        key=repr,
    )
    pieces, sequences = defaultdict(list), defaultdict(list)
    for r in rows:
        ids = np.frombuffer(bytes(r.ids), "<u4").tolist()
        assert len(ids) == r.length > 0
        pieces[r.doc_id].append((r.start, ids, r.doc_tokens))
        sequences[r.sequence_id].append((r.offset, r.length))
    for placed in sequences.values():
        end = 0
        for offset, length in sorted(placed):
            assert offset == end
            end += length
        assert end <= window
    whole = defaultdict(list)
    for doc, ids in texts:
        whole[doc].append(ids)
    assert pieces.keys() == whole.keys()
    for doc, found in pieces.items():
        assert sorted(i for _, ids, _ in found for i in ids) == sorted(i for ids in whole[doc] for i in ids)
        if len(whole[doc]) == 1:
            joined = [i for _, ids, _ in sorted(found) for i in ids]
            assert joined == whole[doc][0]
            assert {n for _, _, n in found} == {len(joined)}
            starts = np.cumsum([0] + [len(ids) for _, ids, _ in sorted(found)])[:-1]
            assert [s for s, _, _ in sorted(found)] == starts.tolist()
    return [sum(n for _, n in placed) for placed in sequences.values()]


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(6)
    rows = [(i, prose(rng, int(rng.lognormvariate(4.5, 1)))) for i in range(400)]
    return spark.createDataFrame(rows, "doc_id bigint, text string").coalesce(2)


@pytest.mark.parametrize("window", [2048, 256])
@pytest.mark.parametrize("portion", [8_000_000, 20_000])
def test_no_padding(docs, window, portion):
    lengths = check(docs, window, portion_tokens=portion)
    assert all(n == window or n & (n - 1) == 0 for n in lengths)
    assert sum(n < window for n in lengths) <= 12 * 2 * (1 + 200_000 // portion)


def test_most_documents_stay_whole(docs):
    rows = packing.pack(docs, PATH, PACKING_END_ID).collect()
    cut = defaultdict(int)
    for r in rows:
        cut[r.doc_id] += 1
    assert sum(n == 1 for n in cut.values()) > 300


def test_odd_rows(odd_docs):
    check(odd_docs)


def test_empty_table(no_docs):
    assert packing.pack(no_docs, PATH, PACKING_END_ID).count() == 0


@pytest.mark.parametrize("window", [8, 64, 256, 2048])
def test_combinations_fill_a_window(window):
    combos = packing.combinations(window, 4)
    assert (combos.sum(axis=1) == window).all()
    assert len({tuple(sorted(c)) for c in combos.tolist()}) == len(combos)


def test_least_squares_use_up_the_histogram():
    combos = packing.combinations(64, 4)
    rng = np.random.default_rng(0)
    counts = np.zeros(len(combos))
    counts[rng.choice(len(combos), 20, replace=False)] = rng.integers(5, 50, 20)
    histogram = np.bincount(combos.ravel(), np.repeat(counts, 3), 65)
    histogram[0] = 0
    found = packing.repeat_counts(histogram, combos, 2000)
    used = np.bincount(combos.ravel(), np.repeat(found, 3), 65)
    assert (found >= 0).all()
    assert np.abs(used[1:] - histogram[1:]).sum() < 0.02 * histogram.sum()


@pytest.mark.parametrize("lengths", [[], [1], [7, 1], [63] * 40, [64 // 2] * 5, list(range(1, 64)) * 3])
def test_plan_holds_every_piece_once(lengths):
    places = defaultdict(list)
    sequences = packing.plan(lengths, 64)
    for sequence in sequences:
        total = sum(n for _, _, n in sequence)
        assert total == 64 or total & (total - 1) == 0
        for piece, start, n in sequence:
            places[piece].append((start, n))
    assert set(places) == {i for i, n in enumerate(lengths) if n}
    for piece, found in places.items():
        end = 0
        for start, n in sorted(found):
            assert start == end
            end += n
        assert end == lengths[piece]


@pytest.mark.parametrize("name", ["word_bpe_49k.json", "byte_bpe_50k.json"])
def test_ids_are_the_library_s(name):
    rng = random.Random(1)
    texts = [
        "", " ", "\n", "a", "a  b", " a", "a ", "a\t  b", "don't I'M we'll '5 ''s", "x.y,z!? ...", "1234 5",
        "  x  \n\n y\n", "\n \n a \n", "é É ñ ÿ Ÿ ß", "é", "İstanbul ıI", "ΑΣ ΑΣ.", "日本 語テ",
        "a\x1cb \x1c", "a  b", "a​b", "\x01 \x01x", "<|endoftext|> <|startoftext|>x", "x" * 5000,
        "foo\n\x01", "½ ² Ⅷ ٣", "_a_ a_b", "﻿x", "K Å", "\U0001f600\U0001f600 :)",
    ]
    alphabet = "aB'sé .,\n 1_-İß日\t "
    texts += ["".join(rng.choice(alphabet) for _ in range(rng.randrange(60))) for _ in range(800)]
    ours = tokens.WordTokenizer(public_tokenizers.path(name))
    want = [e.ids for e in library(public_tokenizers.path(name)).encode_batch(texts, add_special_tokens=False)]
    for _ in range(2):
        assert [np.frombuffer(x, ours.id_type).tolist() for x in ours.encode(texts)] == want


def test_memory_of_words_is_bounded(monkeypatch):
    monkeypatch.setattr(tokens, "MAX_WORDS", 5)
    monkeypatch.setattr(tokens, "PORTION", 20)
    ours = tokens.WordTokenizer(PATH)
    texts = [f"word{i} other{i} 日本{i}" for i in range(50)]
    want = [e.ids for e in library(PATH).encode_batch(texts, add_special_tokens=False)]
    assert [np.frombuffer(x, ours.id_type).tolist() for x in ours.encode(texts)] == want
    assert len(ours._known) < 20 and len(ours._known_parts) < 20
