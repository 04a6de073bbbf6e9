"""Source mixing against plain Python, and its rates."""

from __future__ import annotations

import hashlib
import math
import random
from collections import Counter

import pytest
from texts import prose

from dockhand.llm import mixing


def draw(doc_id, text: str | None, rate: float, seed: int = 0) -> int:
    """A row without an id draws by its text."""
    key = hashlib.md5((text or "").encode()).hexdigest() if doc_id is None else doc_id
    parts = max(1, math.ceil(rate / mixing.MAX_MEAN))
    mean, total = rate / parts, 0
    for j in range(1, parts + 1):
        unit = int(hashlib.md5(f"{key}:{seed}:{j}".encode()).hexdigest()[:13], 16) / 16**13
        k, p = 0, math.exp(-mean)
        below = p
        while below <= unit:
            k += 1
            p *= mean / k
            below += p
        total += k
    return total


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(2)
    rows = [(i, prose(rng, 5 + i % 30), f"s{min(9, int(rng.expovariate(0.7)))}") for i in range(900)]
    return spark.createDataFrame(rows, "doc_id bigint, text string, source string").repartition(6)


def rates(rows, weights=None) -> dict:
    chars = Counter()
    for r in rows:
        chars[r.source] += len(r.text or "")
    weight = {s: math.sqrt(c) if weights is None else weights.get(s, 0) for s, c in chars.items()}
    return {
        s: weight[s] / (sum(weight.values()) or 1) * sum(chars.values()) / c if c else 1.0
        for s, c in chars.items()
    }


def check(df, weights=None, frame=None) -> Counter:
    rows = df.collect()
    rate = rates(rows, weights)
    want = Counter()
    for r in rows:
        for copy in range(1, draw(r.doc_id, r.text, rate[r.source]) + 1):
            want[r.doc_id, r.text, r.source, copy] += 1
    got = mixing.mix(df, weights=frame).collect()
    assert Counter((r.doc_id, r.text, r.source, r.copy) for r in got) == want
    for r in got:
        assert r.rate == pytest.approx(rate[r.source])
    return want


def test_against_plain_python(docs):
    check(docs)


def test_given_weights(spark, docs):
    weights = {"s0": 1.0, "s3": 3.0}
    frame = spark.createDataFrame(list(weights.items()), "source string, weight double")
    got = check(docs, weights, frame)
    assert {k[2] for k in got} == {"s0", "s3"}


def test_large_means(spark, docs):
    few = docs.filter("doc_id < 3").withColumn("source", docs.doc_id.cast("string"))
    frame = spark.createDataFrame([("0", 1.0)], "source string, weight double")
    small = few.selectExpr("doc_id", "repeat(text, CASE WHEN doc_id = 0 THEN 1 ELSE 400 END) AS text", "source")
    got = check(small, {"0": 1.0}, frame)
    assert sum(got.values()) > mixing.MAX_MEAN


def test_odd_rows(odd_docs):
    check(odd_docs)


def test_rows_without_ids_draw_by_themselves(spark):
    """A source of null ids has its rate, and no value of the shuffle's key has all its rows."""
    rng = random.Random(8)
    rows = [(None, prose(rng, 20, 10**6), f"s{i % 2}") for i in range(600)] + [
        (i, prose(rng, 2000, 10**6), "large") for i in range(20)
    ]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, source string")
    want = check(docs)
    for source in ("s0", "s1"):
        n = sum(k[2] == source for k in want)
        expected = rates(docs.collect())[source] * 300
        assert abs(n - expected) < 5 * math.sqrt(expected)
    keys = Counter(r.shuffle_key for r in mixing.mix(docs).collect())
    assert max(keys.values()) == 1


def test_empty_table(no_docs):
    result = mixing.mix(no_docs)
    assert result.count() == 0 and result.columns.count("rate") == 1


def test_shuffled_globally_and_the_same_each_time(docs):
    runs = [[(r.doc_id, r.copy) for r in mixing.mix(docs).collect()] for _ in range(2)]
    assert runs[0] == runs[1] != sorted(runs[0])
    keys = [r.shuffle_key for r in mixing.mix(docs).collect()]
    assert keys == sorted(keys)
    assert [(r.doc_id, r.copy) for r in mixing.mix(docs, seed=1).collect()] != runs[0]
