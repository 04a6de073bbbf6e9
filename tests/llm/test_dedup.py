"""Exact and line dedup against plain Python."""

from __future__ import annotations

import hashlib
import random
from collections import Counter, defaultdict

import pytest
from texts import prose

from dockhand.llm import exact_dedup, line_dedup

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def sha(text: str) -> str:
    return hashlib.sha256(text.encode()).hexdigest()


def exact(rows: list) -> Counter:
    """Multiset of results; of repeated rows with the largest id one is kept."""
    groups = defaultdict(list)
    for i, text in rows:
        groups[sha((text or "").translate(LOWER))].append(i)
    out = Counter()
    for digest, ids in groups.items():
        known = [i for i in ids if i is not None]
        keep = max(known) if known else None
        left = True
        for i in ids:
            kept = left and i == keep
            left = left and not kept
            out[(i, keep, len(ids), kept, digest)] += 1
    return out


@pytest.fixture(scope="module")
def copies(spark):
    rng = random.Random(9)
    texts = [prose(rng, 20) for _ in range(30)]
    rows = [(i, texts[min(29, int(rng.expovariate(0.2)))]) for i in range(300)]
    rows = [(i, t.upper() if i % 3 else t) for i, t in rows] + [(1000 + i, prose(rng, 8)) for i in range(200)]
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(7)


def found(df, **options) -> Counter:
    rows = exact_dedup.exact_duplicates(df, **options).collect()
    return Counter((r.doc_id, r.keep_id, r.group_size, r.kept, r.text_sha256) for r in rows)


@pytest.mark.parametrize("bits", [exact_dedup.MAX_BITS, 32768])
def test_exact(copies, bits, monkeypatch):
    monkeypatch.setattr(exact_dedup, "MIN_BITS", 32768)
    assert found(copies, max_bits=bits) == exact([tuple(r) for r in copies.collect()])


def test_exact_odd_rows(odd_docs):
    assert found(odd_docs) == exact([(r.doc_id, r.text) for r in odd_docs.collect()])


def test_exact_empty_table(no_docs):
    result = exact_dedup.exact_duplicates(no_docs)
    assert result.count() == 0
    assert result.columns == ["doc_id", "keep_id", "group_size", "kept", "text_sha256"]


def test_only_possibly_repeated_rows_are_marked(spark):
    hashed = spark.range(20_000).selectExpr("sha2(CAST(id % 19900 AS STRING), 256) AS text_sha256", "id")
    marked = exact_dedup.possibly_repeated(hashed)
    rows = {r.id: r.maybe for r in marked.collect()}
    assert all(rows[i] for i in rows if i < 100 or i >= 19_900)
    assert sum(rows.values()) < 2_000


def lines(rows: list, min_docs: int, keep_first: bool = False) -> Counter:
    seen, first = defaultdict(set), {}
    split = {}
    for i, text in sorted(set(rows), key=lambda r: (r[0] is not None, r[0] or 0, r[1] or "")):
        keys = [x.strip(" \t\n\x0b\x0c\r").translate(LOWER) for x in (text or "").split("\n")]
        split[i, text] = keys
        for place, key in enumerate(keys):
            if key:
                seen[key].add((i, text))
                first.setdefault(key, (i, text, place))
    shared = {k for k, docs in seen.items() if len(docs) >= min_docs}
    out = Counter()
    for i, text in rows:
        keys = split[i, text]
        drop = [
            k in shared and not (keep_first and first[k] == (i, text, place)) for place, k in enumerate(keys)
        ]
        kept = [x for x, d in zip((text or "").split("\n"), drop) if not d]
        out[(i, "\n".join(kept), len(keys), sum(drop))] += 1
    return out


@pytest.fixture(scope="module")
def pages(spark):
    rng = random.Random(4)
    common = [prose(rng, 5) for _ in range(6)] + ["Ünïcode LINE", "x"]
    rows = []
    for i in range(120):
        own = [prose(rng, 6) for _ in range(rng.randrange(4))]
        some = [rng.choice([f" {c}\t", c.upper(), c]) for c in rng.sample(common, rng.randrange(4))]
        text = own + some + ["", " "][: rng.randrange(3)] + ["the hot line"] * (i % 3)
        if i == 7:
            text = [f"only line {k}" if k % 3 else common[0] for k in range(700)]
        rng.shuffle(text)
        rows.append((i, "\n".join(text)))
    return spark.createDataFrame(rows, "doc_id bigint, text string").repartition(5)


def dropped(df, **options) -> Counter:
    rows = line_dedup.drop_lines(df, **options).collect()
    return Counter((r.doc_id, r.text, r.n_lines, r.n_dropped) for r in rows)


@pytest.mark.parametrize("keep_first", [False, True])
@pytest.mark.parametrize("min_docs", [10, 40])
def test_lines(pages, keep_first, min_docs):
    rows = [tuple(r) for r in pages.collect()]
    got = dropped(pages, min_docs=min_docs, keep_first=keep_first)
    if not keep_first:
        assert got == lines(rows, min_docs)
        assert sum(r[3] for r in got) > 50
    else:
        assert got == lines(rows, min_docs, True)


@pytest.mark.parametrize("min_docs", [1, 2])
def test_lines_of_odd_rows(odd_docs, min_docs):
    rows = [(r.doc_id, r.text) for r in odd_docs.collect()]
    assert dropped(odd_docs, min_docs=min_docs) == lines(rows, min_docs)


def test_lines_of_an_empty_table(no_docs):
    result = line_dedup.drop_lines(no_docs)
    assert result.count() == 0 and result.columns.count("n_lines") == 1


def test_bitmaps_leave_out_what_stays(pages):
    for r in line_dedup.line_bitmaps(pages, min_docs=10).collect():
        assert [w.word for w in r.dropped] == sorted({w.word for w in r.dropped})
        assert all(w.bits for w in r.dropped)


def test_lines_spread_by_range_without_another_shuffle(spark, pages, monkeypatch, capsys):
    rows = spark.range(10).selectExpr("id AS doc_id", "'a' AS text")
    monkeypatch.setattr(line_dedup, "written", lambda df, name: (df.explain(), df)[1])
    line_dedup.line_bitmaps(rows)
    plan = capsys.readouterr().out.split("== Physical Plan ==")[1]
    assert plan.count("Exchange") == 1 and "rangepartitioning(h1" in plan and "Python" not in plan
