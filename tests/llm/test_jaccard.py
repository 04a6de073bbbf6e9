"""The Jaccard join against all pairs in plain Python."""

from __future__ import annotations

import random
import re
from collections import defaultdict

import numpy as np
import pytest
from texts import prose

from dockhand.llm import components, jaccard_join, wordhash

WORDS = re.compile("[^\x20\x09-\x0d]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def shingles(text: str | None, width: int = 4) -> frozenset:
    words = WORDS.findall((text or "").translate(LOWER))
    if len(words) < width:
        return frozenset([tuple(words)] if words else [])
    return frozenset(tuple(words[i:i + width]) for i in range(len(words) - width + 1))


def brute_force(rows: list, percent: int = 85, width: int = 4) -> list:
    sets = [shingles(t, width) for _, t in rows]
    parent = list(range(len(rows)))

    def find(x: int) -> int:
        while parent[x] != x:
            x = parent[x]
        return x

    for i in range(len(rows)):
        for j in range(i):
            both = len(sets[i] & sets[j])
            if both and 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both):
                parent[find(i)] = find(j)
    least = defaultdict(list)
    for i, (doc, _) in enumerate(rows):
        if doc is not None:
            least[find(i)].append(doc)
    return [
        (doc, len(sets[i]), min(least[find(i)], default=None) if sets[i] else doc)
        for i, (doc, _) in enumerate(rows)
    ]


def check(df, **options) -> list:
    rows = [(r.doc_id, r.text) for r in df.collect()]
    got = [
        (r.doc_id, r.n_shingles, r.component_id) for r in jaccard_join.jaccard_classes(df, **options).collect()
    ]
    want = brute_force(rows, options.get("percent", 85), options.get("width", 4))
    assert sorted(got, key=repr) == sorted(want, key=repr)
    return want


def edited(rng: random.Random, text: str, edits: int) -> str:
    words = text.split()
    for _ in range(edits):
        kind, at = rng.randrange(3), rng.randrange(len(words))
        words[at:at + (kind > 0)] = [f"new{rng.randrange(10**6)}"] * (kind < 2)
    return " ".join(words)


@pytest.fixture(scope="module")
def near(spark):
    """Chains, stars and lone copies, around the threshold, and a passage many share."""
    rng = random.Random(8)
    passage, rows = prose(rng, 60), []
    for _ in range(12):
        text = prose(rng, rng.randrange(20, 250))
        for _ in range(rng.randrange(1, 12)):
            rows.append(text)
            text = edited(rng, text, rng.randrange(0, 6))
    base = prose(rng, 150)
    rows += [edited(rng, base, rng.randrange(0, 4)) for _ in range(60)]
    rows += [passage + " " + prose(rng, rng.randrange(5, 60)) for _ in range(60)]
    rows += [prose(rng, rng.randrange(1, 8), 6) for _ in range(60)] + ["", " ", None]
    rows += [r.upper() for r in rows[:20] if r]
    rng.shuffle(rows)
    return spark.createDataFrame(list(enumerate(rows)), "doc_id bigint, text string").repartition(5)


def test_against_all_pairs(near):
    want = check(near)
    assert len({c for _, _, c in want}) < len(want) - 80


@pytest.mark.parametrize("percent,width", [(60, 4), (85, 2), (100, 4), (30, 1)])
def test_other_thresholds(near, percent, width):
    check(near, percent=percent, width=width)


@pytest.mark.parametrize("sets,grams", [(2, 10**6), (7, 10**6), (2048, 150)])
def test_small_blocks(near, monkeypatch, sets, grams):
    """Homes of many blocks, and meetings in pairs of blocks."""
    monkeypatch.setattr(jaccard_join, "BLOCK_SETS", sets)
    monkeypatch.setattr(jaccard_join, "BLOCK_GRAMS", grams)
    check(near)
    check(near, percent=50)


def test_texts_of_many_sets_are_shuffled_by_a_bitmap(near, monkeypatch):
    """The other way to the texts, for more wanted sets than can be broadcast."""
    monkeypatch.setattr(jaccard_join, "BROADCAST_BYTES", -1)
    check(near)


def test_odd_rows(odd_docs):
    check(odd_docs)


def test_empty_table(no_docs):
    result = jaccard_join.jaccard_classes(no_docs)
    assert result.count() == 0 and result.columns == ["doc_id", "n_shingles", "component_id"]


def test_all_ids_null(spark):
    df = spark.createDataFrame([(None, "a b c d e")] * 3 + [(None, None)], "doc_id bigint, text string")
    check(df)


@pytest.mark.parametrize("seed", range(5))
@pytest.mark.parametrize("percent", [85, 50])
def test_trie_finds_all_links(seed, percent):
    rng = np.random.default_rng(seed)
    base = rng.choice(300, 60, replace=False)
    sets = []
    for _ in range(70):
        keep = rng.random(60) < rng.choice([0.5, 0.9, 0.97])
        sets.append(np.unique(np.concatenate((base[keep], rng.integers(0, 300, rng.integers(0, 12))))).astype(np.uint64))
    sets = sorted((s for s in sets if len(s)), key=len)
    trie = jaccard_join.Trie(percent)
    for s in sets:
        trie.add(s)
    parent = list(range(len(sets)))

    def find(x: int) -> int:
        return x if parent[x] == x else find(parent[x])

    for i, a in enumerate(sets):
        for j in range(i):
            both = len(np.intersect1d(a, sets[j]))
            if 100 * both >= percent * (len(a) + len(sets[j]) - both):
                parent[max(find(i), find(j))] = min(find(i), find(j))
    assert [trie.find(i) for i in range(len(sets))] == [find(i) for i in range(len(sets))]
    for i, j in trie.links:
        both = len(np.intersect1d(sets[i], sets[j]))
        assert 100 * both >= percent * (len(sets[i]) + len(sets[j]) - both)


@pytest.mark.parametrize("percent", [1, 30, 50, 85, 100])
def test_needed_shared_in_sql(spark, percent):
    sizes = range(1, 400)
    df = spark.createDataFrame([(n,) for n in sizes], "n int")
    found = df.selectExpr("n", f"{jaccard_join._needed_sql('n', percent)} AS k").collect()
    assert {r.n: r.k for r in found} == {
        n: jaccard_join._needed_shared(n, jaccard_join._misses(n, percent)) for n in sizes
    }


def test_word_hashes_tell_words_apart():
    import pyarrow as pa

    texts = ["One two", "", " ", "two  ONE\tthree\n", "onetwo", "é É", "x" * 5000, "\x0btwo\x0c"]
    words = [w.translate(LOWER) for t in texts for w in WORDS.findall(t)]
    found, ends = [], []
    for _, data, offsets in wordhash.portions(pa.array(texts)):
        hashes, first = wordhash.word_hashes(data, offsets)
        found += hashes.tolist()
        ends += np.diff(first).tolist()
    assert ends == [len(WORDS.findall(t)) for t in texts]
    assert len(found) == len(words)
    assert len(set(found)) == len(set(words)) == len(set(zip(found, words)))


def test_portions_of_slices(monkeypatch):
    import pyarrow as pa

    monkeypatch.setattr(wordhash, "PORTION_BYTES", 10)
    texts = ["abc"] * 5 + ["x" * 50, "", "é"]
    for sliced in (pa.array(texts), pa.array(["skip", *texts, "skip"]).slice(1, len(texts))):
        got = [
            data[a:b].tobytes().decode()
            for _, data, offsets in wordhash.portions(sliced) for a, b in zip(offsets, offsets[1:])
        ]
        assert got == texts
    assert list(wordhash.portions(pa.array([], pa.string()))) == []


@pytest.mark.parametrize("edges", [
    [], [(1, 1)], [(i, i + 1) for i in range(40)], [(0, i) for i in range(1, 30)],
    [(5, 3), (3, 9), (20, 21), (9, 1), (22, 20)],
])
def test_components(spark, edges):
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    got = {r.node: r.root for r in components.connected_components(df).collect()}
    parent = {x: x for e in edges for x in e}
    for _ in edges:
        for a, b in edges:
            low = min(parent[a], parent[b])
            parent[a] = parent[b] = low
    assert {n: got.get(n, n) for n in parent} == parent


def test_whole_sets_meet_only_where_signatures_allow(spark):
    """Of sets that share a passage at a place, only the similar ones go on to meet whole."""
    rng = np.random.default_rng(4)
    passage = rng.integers(0, 1 << 59, 30, np.uint64)
    sets = [np.unique(np.concatenate((passage, rng.integers(0, 1 << 59, 170, np.uint64)))) for _ in range(50)]
    sets += [np.unique(np.append(sets[7][5:], np.uint64(9)))]
    rows = [
        (1, 0, 0, len(s), sid, sid, 0, 0, sid, bytearray(jaccard_join._signature(s))) for sid, s in enumerate(sets)
    ]
    placed = spark.createDataFrame(
        rows, "gram long, i int, j int, n long, sid long, home long, block int, side int, class long, signature binary"
    )
    assert {r.sid for r in jaccard_join._likely(placed, 80).collect()} == {7, 50}


@pytest.mark.parametrize("percent", [30, 80, 85])
def test_signatures_rule_out_no_similar_pair(percent):
    rng = np.random.default_rng(percent)
    sets = []
    for _ in range(120):
        base = sets[rng.integers(len(sets))] if sets and rng.random() < 0.7 else rng.integers(0, 1 << 59, rng.integers(1, 400), np.uint64)
        fresh = rng.integers(0, 1 << 59, rng.integers(0, 1 + len(base) // 3), np.uint64)
        sets.append(np.unique(np.concatenate((base[rng.random(len(base)) < 0.93], fresh, base[:1]))))
    sets.sort(key=len)
    found = jaccard_join._possible(
        np.array([len(s) for s in sets]), [jaccard_join._signature(s) for s in sets], percent,
        lambda k, first: np.zeros(k - first, bool),
    )
    similar = set()
    for i, a in enumerate(sets):
        for j in range(i):
            both = len(np.intersect1d(a, sets[j]))
            if 100 * both >= percent * (len(a) + len(sets[j]) - both):
                similar |= {i, j}
    assert similar and similar <= set(np.flatnonzero(found).tolist())
