"""Suffix trees whose words outside the alphabet are counted after each context too."""

from __future__ import annotations

import math
import random
from collections import Counter

import pytest
from test_scoring import RARE, START, hash_of, in_training, plain_tree, tokens

from dockhand.llm import suffix_tree


def plain_every_word(docs, symbols: int, min_share: float) -> list[float]:
    """Scores by the contexts of a plain tree and each word's own counts after them."""
    _, retained = plain_tree(docs, symbols, suffix_tree.DEPTH, min_share)
    seen = Counter(t for doc, text in docs if in_training(doc) for t in text)
    total = sum(seen.values()) + suffix_tree.ADDED * (len(seen) + 1)
    ranked = sorted(seen, key=lambda w: (-seen[w], hash_of(w)))
    words = set(ranked[:symbols])
    depth, after, follow = suffix_tree.DEPTH, Counter(), Counter()
    root = {w: (seen[w] + suffix_tree.ADDED) / total for w in seen if w in words}
    root[RARE] = max(1 - sum(root.values()), suffix_tree.ADDED / total)

    def places(text):
        padded = [START] * depth + [t if t in words else RARE for t in text]
        for i, token in enumerate(text, depth):
            contexts = [tuple(padded[i - k:i]) for k in range(1, depth + 1)]
            yield token, [c for c in contexts if c in retained]

    for doc, text in docs:
        for token, contexts in places(text) if in_training(doc) else ():
            if token not in words:
                after.update((c, token) for c in contexts)
                follow.update(contexts)
    distinct = Counter(c for c, _ in after)
    out = []
    for _, text in docs:
        score = 0.0
        for token, contexts in places(text):
            state = retained[contexts[-1]] if contexts else root
            if token in words:
                score += math.log10(state[token])
                continue
            p = (seen[token] + suffix_tree.ADDED) / total / root[RARE]
            for c in contexts:
                if follow[c]:
                    p = (after[c, token] + distinct[c] * p) / (follow[c] + distinct[c])
            score += math.log10(state[RARE] * p)
        out.append(score)
    return out


def pairs_of_words(n: int):
    """Frequent words each followed by rare words of its own, then by the next frequent word."""
    rng = random.Random(12)
    rows = []
    for i in range(n):
        a, text = rng.randrange(8), []
        for _ in range(rng.randrange(0, 120)):
            text += [f"W{a}"] + [f"rare{a}_{rng.randrange(15)}"] * (rng.random() < 0.7)
            a = (3 * a + 1 + (rng.random() < 0.3)) % 8
        rows.append((i, " ".join(text)))
    return rows


@pytest.mark.parametrize("alphabet,min_share", [(12, 1e-2), (100, 2e-2), (1, 0.2)])
def test_every_word_against_a_plain_tree(spark, monkeypatch, alphabet, min_share):
    monkeypatch.setattr(suffix_tree, "ALPHABET", alphabet)
    rows = pairs_of_words(200)
    docs = [(i, tokens(text)) for i, text in rows]
    want = plain_every_word(docs, max(alphabet, int(1 / min_share)), min_share)
    df = spark.createDataFrame(rows, "doc_id bigint, text string").repartition(3)
    got = {r.doc_id: r for r in suffix_tree.score(df, min_share=min_share, every_word=True).collect()}
    capped = {r.doc_id: r for r in suffix_tree.score(df, min_share=min_share).collect()}
    for (doc, text), score in zip(docs, want, strict=True):
        assert got[doc].score == pytest.approx(score, rel=1e-5, abs=1e-4)
        assert got[doc][:-1] == pytest.approx(capped[doc][:-1])


def test_rare_words_keep_their_contexts(spark, monkeypatch):
    """Words outside the alphabet that follow one word only are expected there."""
    monkeypatch.setattr(suffix_tree, "ALPHABET", 10)
    df = spark.createDataFrame(pairs_of_words(300), "doc_id bigint, text string")
    every, share = (
        sum(r.score for r in suffix_tree.score(df, min_share=0.02, every_word=e).collect() if r.held_out)
        for e in (True, False)
    )
    assert every > 0.85 * share


def test_small_portions(spark, odd_docs, monkeypatch):
    """Portions of a few texts ask one by one for what one portion asks at once."""
    at_once = suffix_tree.score(odd_docs, every_word=True).collect()
    monkeypatch.setattr(suffix_tree, "PORTION_BYTES", 100)
    apart = suffix_tree.score(odd_docs, every_word=True).collect()

    def key(r):
        return repr(r.doc_id), r.n_tokens, round(r.score, 3)

    for a, b in zip(sorted(at_once, key=key), sorted(apart, key=key), strict=True):
        assert a[:-2] == b[:-2] and a[-2:] == pytest.approx(b[-2:])
