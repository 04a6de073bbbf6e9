"""Suffix tree scores and licence scans against plain Python."""

from __future__ import annotations

import math
import random
import re
import textwrap
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from texts import prose

from dockhand.llm import licences, suffix_tree
from dockhand.llm.wordhash import word_hashes

WORDS = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
END = None


def tokens(text: str | None) -> list:
    return WORDS.findall((text or "").translate(LOWER)) + [END]


def in_training(doc_id) -> bool:
    return zlib.crc32(("" if doc_id is None else str(doc_id)).encode()) % 10 != 0


def check_base(df) -> list:
    docs = [(r.doc_id, tokens(r.text)) for r in df.collect()]
    seen = Counter(t for doc, text in docs if in_training(doc) for t in text)
    n, v = sum(seen.values()), len(seen)
    want = [
        (doc, not in_training(doc), len(text), sum(seen[t] > 0 for t in text), n,
         sum(math.log10((seen[t] + 0.1) / (n + 0.1 * (v + 1))) for t in text))
        for doc, text in docs
    ]
    rows = suffix_tree.score(df).collect()
    got = [(r.doc_id, r.held_out, r.n_tokens, r.n_known, r.train_tokens, r.base_score) for r in rows]

    def key(row):
        return repr(row[:5]), row[5]

    for a, b in zip(sorted(got, key=key), sorted(want, key=key), strict=True):
        assert a[:5] == b[:5] and a[5] == pytest.approx(b[5], rel=1e-9, abs=1e-6)
    assert all(r.score < 0 and math.isfinite(r.score) for r in rows)
    return rows


def test_base_scores(spark):
    rng = random.Random(3)
    check_base(spark.createDataFrame(
        [(i, prose(rng, rng.randrange(0, 300), 3000)) for i in range(150)], "doc_id bigint, text string"
    ))


def test_odd_rows(odd_docs):
    check_base(odd_docs)


def test_empty_table(no_docs):
    assert suffix_tree.score(no_docs).count() == 0


def test_contexts_help_on_rows_held_out(spark):
    """Text of fixed successions scores far better in context than word by word."""
    rng = random.Random(4)
    rows = []
    for i in range(300):
        k, text = rng.randrange(50), []
        for _ in range(200):
            text.append(f"w{k}")
            k = (k * 7 + 3 + (rng.random() < 0.1)) % 50
        rows.append((i, " ".join(text)))
    scored = check_base(spark.createDataFrame(rows, "doc_id bigint, text string"))
    held = [r for r in scored if r.held_out]
    assert held and sum(r.score for r in held) > 0.5 * sum(r.base_score for r in held)


RARE, START = "\x01rare", "\x01start"


def hash_of(word) -> int:
    """What ties of the most frequent words are told apart by."""
    if word is END:
        value = int(suffix_tree.END)
    else:
        data = word.encode()
        value = int(word_hashes(np.frombuffer(data, np.uint8), np.array([0, len(data)]))[0][0])
    return value - (1 << 64 if value >> 63 else 0)


def plain_tree(docs, alphabet: int, depth: int, min_share: float):
    """Scores of all texts by the rules of the tree, with dictionaries."""
    seen = Counter(t for doc, text in docs if in_training(doc) for t in text)
    n, total = sum(seen.values()), sum(seen.values()) + suffix_tree.ADDED * (len(seen) + 1)
    words = set(sorted(seen, key=lambda w: (-seen[w], hash_of(w)))[:alphabet])
    root = {w: (seen[w] + suffix_tree.ADDED) / total for w in words}
    root[RARE] = max(1 - sum(root.values()), suffix_tree.ADDED / total)

    def symbols(text):
        return [t if t in words else RARE for t in text]

    least, weight = max(1, min_share * n), suffix_tree.PARENT_WEIGHT
    retained: dict[tuple, dict] = {}
    # Every counted context's distribution, or that of the next shorter one where it is not retained.
    below: dict[tuple, dict] = {(): root}
    candidates = None
    for length in range(1, depth + 1):
        following: dict[tuple, Counter] = defaultdict(Counter)
        for doc, text in docs:
            if in_training(doc):
                padded = [START] * length + symbols(text)
                for i in range(length, len(padded)):
                    following[tuple(padded[i - length:i])][padded[i]] += 1
        frequent = {
            c: f for c, f in following.items()
            if sum(f.values()) >= least and (candidates is None or c in candidates)
        }
        for context, f in frequent.items():
            parent, count = below[context[1:]], sum(f.values())
            mixed = {x: (f[x] + weight * p) / (count + weight) for x, p in parent.items()}
            divergence = sum(
                mixed[x] * (math.log(mixed[x] / parent[x]) if f[x] else math.log(weight / (count + weight)))
                for x in mixed
            )
            if divergence >= suffix_tree.MIN_DIVERGENCE and count * divergence > 0.5 * len(f) * math.log(n):
                retained[context] = mixed
            below[context] = retained.get(context, parent)
        candidates = {
            (*c, x) for c, f in frequent.items() for x, k in f.items() if k >= least and (*c, x)[1:] in frequent
        }
    out = []
    for _, text in docs:
        padded, score = [START] * depth + symbols(text), 0.0
        for i, token in enumerate(text, depth):
            contexts = [tuple(padded[i - k:i]) for k in range(depth, 0, -1)]
            state = next((retained[c] for c in contexts if c in retained), root)
            score += math.log10(state[padded[i]])
            if padded[i] == RARE:
                score += math.log10((seen[token] + suffix_tree.ADDED) / total) - math.log10(root[RARE])
        out.append(score)
    return out, retained


def check_tree(df, monkeypatch, alphabet: int, min_share: float) -> dict:
    monkeypatch.setattr(suffix_tree, "ALPHABET", alphabet)
    docs = [(r.doc_id, tokens(r.text)) for r in df.collect()]
    want, retained = plain_tree(docs, alphabet, suffix_tree.DEPTH, min_share)
    rows = suffix_tree.score(df, min_share=min_share).collect()
    got = sorted((repr(r.doc_id), r.n_tokens, r.score) for r in rows)
    expected = sorted((repr(doc), len(text), score) for (doc, text), score in zip(docs, want))
    for a, b in zip(got, expected, strict=True):
        assert a[:2] == b[:2] and a[2] == pytest.approx(b[2], rel=1e-5, abs=1e-4)
    return retained


@pytest.mark.parametrize("alphabet,min_share", [(1000, 5e-4), (20, 1e-3), (60, 5e-3)])
def test_scores_against_a_plain_tree(spark, monkeypatch, alphabet, min_share):
    """Texts of a chain of second order, with rare words between."""
    rng = random.Random(11)
    rows = []
    for i in range(200):
        a, b, text = rng.randrange(12), rng.randrange(12), []
        for _ in range(rng.randrange(0, 250)):
            a, b = b, (3 * a + 5 * b + (rng.random() < 0.2)) % 12
            text.append(f"W{b}" if rng.random() < 0.9 else f"rare{rng.randrange(400)}")
        rows.append((i, " ".join(text)))
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    retained = check_tree(df, monkeypatch, alphabet, min_share)
    # Contexts of more than one word are among them, else the longest one is not put to the test.
    assert {len(c) for c in retained} >= {1, 2}


def test_scores_of_odd_rows_against_a_plain_tree(odd_docs, monkeypatch):
    check_tree(odd_docs, monkeypatch, 50, 1e-3)


def test_licences(spark):
    full = " ".join(licences.SENTENCES[i][0] for i in ("MitGrant", "MitNotice", "MitAsIs"))
    rows = [
        (1, f"Words before. {full}\nWords after.", "MIT", ""),
        (2, licences.SENTENCES["MitGrant"][0].upper() + " Then something else.", "MIT", ""),
        (3, "Nothing of that kind.", "", ""), (4, None, "", ""), (5, "", "", ""),
        (6, "A line\nLicensed under CC BY 4.0.\nanother", "CC-BY-4.0", ""),
        (7, licences.SENTENCES["GplHope"][0], "", "GplHope"),
    ]
    df = spark.createDataFrame([r[:2] for r in rows], "doc_id int, text string").selectExpr("*", "1 AS licences")
    found = licences.scan_licences(df)
    assert found.columns.count("licences") == 1
    got = {r.doc_id: (r.licences, r.unmatched_ids) for r in found.collect()}
    assert got == {doc: (names, left) for doc, _, names, left in rows}


def test_licences_of_odd_rows(odd_docs, no_docs):
    found = licences.scan_licences(odd_docs).collect()
    assert len(found) == odd_docs.count() and {r.licences for r in found} == {""}
    assert licences.scan_licences(no_docs).count() == 0


HEADS = ["", "A Heading\n\nCopyright (c) 2020 Some One\n\n", "A Heading\nCopyright (c) 2020 Some One\n", "Text before.\n\nCopyright 2020 X\n\n"]


@pytest.mark.parametrize("comment", ["", " * "])
def test_every_sentence_and_rule_is_found_in_wrapped_text(spark, comment):
    """Texts as they are published: wrapped, after a heading or a copyright line."""
    rows = []
    for head in HEADS:
        for name, listed in licences.SENTENCES.items():
            rows += [(head, [s], name, None) for s in listed]
        for name, ids in licences.RULES:
            rows.append((head, [licences.SENTENCES[i][0] for i in ids], ",".join(ids), name))
    texts = []
    for k, (head, listed, _, _) in enumerate(rows):
        body = "\n\n".join(textwrap.fill(s, 72) for s in listed)
        text = head + body + "\n\nMore words follow"
        texts.append((k, "\n".join(comment + line for line in text.split("\n"))))
    found = licences.scan_licences(spark.createDataFrame(texts, "k int, text string"))
    got = {r.k: (r.sentence_ids, r.licences) for r in found.collect()}
    for k, (_, _, ids, name) in enumerate(rows):
        assert got[k][0] == ids, texts[k]
        assert name is None or got[k][1] == name, texts[k]


def test_parts_of_a_longer_sentence_alone_are_nothing(spark):
    rows = [(1, "This program is free software: it is."), (2, "Version v. 2.0."),
            (3, "This program is free software: no. " + licences.SENTENCES["GplThreeLater"][0][32:])]
    found = licences.scan_licences(spark.createDataFrame(rows, "k int, text string"))
    assert {r.sentence_ids + r.licences for r in found.collect()} == {""}
