"""Quality rules against plain Python."""

from __future__ import annotations

import math
import random
import re
from collections import Counter

import pytest
import xxhash
from texts import prose
from dockhand.llm import quality, queries

WORDS = re.compile("[^\x20\x09-\x0d]+")


def hashed(data: bytes, seed: int = 42) -> int:
    return xxhash.xxh64(data, seed=seed & (1 << 64) - 1).intdigest()


def counts(text: str | None) -> dict:
    text = text or ""
    words = WORDS.findall(text)
    windows = [tuple(words[i:i + 3]) for i in range(len(words) - 2)]
    often = Counter(windows)
    inside = {i + k for i, w in enumerate(windows) if often[w] > 1 for k in range(3)}
    lines = [line for line in text.split("\n") if WORDS.search(line)]
    return {
        "n_words": len(words), "word_chars": sum(map(len, words)),
        "n_symbols": sum(c in "#*$%&|<>" for c in text), "n_dup_lines": len(lines) - len(set(lines)),
        "n_repeat_words": len(inside),
        "base_failed": len(words) < 50 or 100 * len(inside) > 50 * len(words),
    }


def buckets(text: str | None) -> list[int]:
    def number(h: int) -> bytes:
        return h.to_bytes(8, "little")

    single = [hashed(w.encode()) for w in WORDS.findall(text or "")]
    pairs = [hashed(number(b), hashed(number(a))) for a, b in zip(single, single[1:])]
    return [h % quality.BUCKETS for h in single + pairs]


def scores(texts: list[tuple], trusted: set) -> list[float]:
    raw, target = Counter(), Counter()
    for i, text in texts:
        found = buckets(text)
        raw.update(found)
        if i in trusted and i is not None:
            target.update(found)
    n_raw, n_target, size = raw.total(), target.total(), quality.BUCKETS
    weight = {
        b: round((math.log((target[b] + 1) / (n_target + size)) - math.log((raw[b] + 1) / (n_raw + size))) * quality.UNIT)
        if n_target else 0 for b in raw
    }
    out = []
    for _, text in texts:
        found = buckets(text)
        out.append(sum(weight[b] for b in found) / len(found) / quality.UNIT if found else 0.0)
    return out


@pytest.fixture(scope="module")
def docs(spark):
    rng = random.Random(3)
    rows = []
    for i in range(60):
        text = prose(rng, rng.randrange(5, 200))
        if i % 5 == 0:
            text = " ".join(w + rng.choice(["%%%", "$$"]) for w in text.split())
        if i % 7 == 0:
            text = "\n".join([text, text, " ", prose(rng, 4), " "])
        if i % 11 == 0:
            text += " one two" * rng.randrange(1, 120)
        rows.append((i, text))
    return spark.createDataFrame(rows, "doc_id int, text string")


def check(spark, docs, trusted: set) -> None:
    ids = spark.createDataFrame([(t,) for t in trusted], "doc_id bigint")
    rows = quality.judge(docs, ids).collect()
    texts = [(r.doc_id, r.text) for r in rows]
    assert sorted(map(str, texts)) == sorted(str((r.doc_id, r.text)) for r in docs.collect())
    for r, want in zip(rows, scores(texts, trusted)):
        plain = counts(r.text)
        assert {k: r[k] for k in plain} == plain, r.text
        assert r.score == pytest.approx(want, abs=2e-6)
        assert r.kept == (not plain["base_failed"] and r.score >= quality.THRESHOLD)


def test_against_plain_python(spark, docs):
    check(spark, docs, {i for i in range(60) if i % 5})


def test_nothing_trusted(spark, docs):
    check(spark, docs, set())


def test_odd_rows(spark, odd_docs):
    check(spark, odd_docs, {1, 6, None})


def test_empty_table(spark, no_docs):
    result = quality.judge(no_docs, spark.createDataFrame([], "doc_id bigint"))
    assert result.count() == 0
    assert result.columns.count("kept") == result.columns.count("score") == 1


def test_bounded_trusted_rows_are_the_same_each_time(spark, docs):
    ids = docs.select("doc_id")
    runs = [quality.bucket_weights(docs, ids, max_trusted=5).first()[0] for _ in range(2)]
    assert runs[0] == runs[1] != quality.bucket_weights(docs, ids).first()[0]


def test_junk_is_told_from_prose(spark):
    rng = random.Random(1)
    # Enough text that the pseudo-counts of all buckets together weigh less than it does.
    rows = [(i, prose(rng, 400, 60) if i % 4 else prose(rng, 400, 60).replace(" ", "%%% ")) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    trusted = docs.filter("doc_id % 4 <> 0 AND doc_id < 200").select("doc_id")
    kept = {r.doc_id for r in quality.judge(docs, trusted).filter("kept").collect()}
    assert kept == {i for i in range(400) if i % 4}


def test_no_python_and_one_pass_over_arrays(spark, docs, tmp_path, capsys):
    # Rows made in Python name it in their plan, so the plan is that of a file.
    docs.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    quality.judge(docs, docs.select("doc_id")).filter("kept").explain("formatted")
    plan = capsys.readouterr().out
    assert "Python" not in plan and "Pandas" not in plan and "Arrow" not in plan
    tree = plan[:plan.index("(1) ")]
    assert tree.index("Filter") < tree.index("CollectMetrics") < tree.index("Project")


def held_out_scores(texts: list[tuple], trusted: set) -> list[float]:
    found = [Counter(buckets(text)) for _, text in texts]
    known = [i is not None and i in trusted for i, _ in texts]
    raw, target = Counter(), Counter()
    for own, t in zip(found, known):
        raw.update(own)
        if t:
            target.update(own)
    out = []
    for own, t in zip(found, known):
        n, others = own.total(), raw.total() - own.total()
        rate = (target.total() - t * n) / others if others else 0
        out.append(sum(
            m * math.log((target[b] - t * m + quality.EXPECTED) / ((raw[b] - m) * rate + quality.EXPECTED))
            for b, m in own.items()
        ) / n if n else 0.0)
    return out


@pytest.mark.parametrize("odd, trusted", [
    (False, {i for i in range(60) if i % 5}), (False, set()), (True, {1, 6, None}), (True, {1, 2, 3, 4, 5, 6, 7, 8}),
])
def test_held_out_against_plain_python(spark, docs, odd_docs, odd, trusted):
    df = odd_docs if odd else docs
    ids = spark.createDataFrame([(t,) for t in trusted], "doc_id bigint")
    rows = quality.judge(df, ids, held_out=True).collect()
    texts = [(r.doc_id, r.text) for r in rows]
    assert sorted(map(str, texts)) == sorted(str((r.doc_id, r.text)) for r in df.collect())
    for r, want in zip(rows, held_out_scores(texts, trusted)):
        plain = counts(r.text)
        assert {k: r[k] for k in plain} == plain
        assert r.score == pytest.approx(want, abs=1e-9)
        assert r.kept == (not plain["base_failed"] and r.score >= quality.THRESHOLD)


def test_held_out_on_an_empty_table(spark, no_docs):
    assert quality.judge(no_docs, spark.createDataFrame([], "doc_id bigint"), held_out=True).count() == 0


@pytest.mark.parametrize("size", ["sf0.001", "sf0.01"])
def test_few_clean_rows_go_where_the_trusted_text_is_small(spark, size):
    data = f"/root/testdata/{size}"
    labels = spark.read.parquet(f"{data}/labels.parquet").withColumnRenamed("doc_id", "labelled")
    rows = queries.op1_quality_rules(spark, data).filter("NOT base_failed")
    rows = rows.join(labels, rows.doc_id == labels.labelled, "left").collect()
    trusted = [r.kept for r in rows if r.quality == 1 and r.toxic == 0]
    unknown = [r.kept for r in rows if r.labelled is None]
    assert sum(trusted) >= 0.98 * len(trusted) > 0
    assert sum(unknown) >= 0.9 * len(unknown) > 0


def test_junk_goes_where_rows_are_held_out(spark):
    rng = random.Random(1)
    rows = [(i, prose(rng, 400, 60) if i % 4 else prose(rng, 400, 60).replace(" ", "%%% ")) for i in range(400)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    trusted = docs.filter("doc_id % 4 <> 0 AND doc_id < 200").select("doc_id")
    kept = {r.doc_id for r in quality.judge(docs, trusted, held_out=True).filter("kept").collect()}
    assert kept == {i for i in range(400) if i % 4}


def test_the_tables_of_buckets_are_not_copied_for_each_row(spark, docs, tmp_path):
    """A step that hands them on copies 1 MB for each row, however short its text."""
    docs.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    judged = quality.judge(docs, docs.select("doc_id"), held_out=True)
    step, copied = judged._jdf.queryExecution().optimizedPlan(), 0
    while not step.children().isEmpty():
        copied += "_raw#" in step.output().mkString(" ")
        step = step.children().apply(0)
    assert copied == 0


def test_arrays_that_are_sorted_hold_no_nulls(spark, docs):
    """Spark sorts an array that may hold nulls as objects, not as numbers."""
    schema = quality._measured(docs, "doc_id", "text").schema
    assert [schema[c].dataType.containsNull for c in ("_grams", "_pairs", "_windows")] == [False] * 3


def test_the_counts_of_buckets_take_no_lambdas(spark, docs):
    """Spark runs lambdas without compiling them."""
    listed = quality._listed(docs, quality._chosen(docs.select("doc_id"), 10), "doc_id", "text")
    assert "lambda" not in listed._jdf.queryExecution().optimizedPlan().toString()


@pytest.mark.parametrize("text", ["a", "a a", "a a a a", "a b", "a b a b a b c", " "])
def test_held_out_buckets_that_occur_once_and_often(spark, text):
    rows = [(1, text), (2, "a b c"), (3, "c c a b a"), (4, text), (5, None)]
    df = spark.createDataFrame(rows, "doc_id bigint, text string")
    ids = spark.createDataFrame([(1,), (3,)], "doc_id bigint")
    got = {r.doc_id: r.score for r in quality.judge(df, ids, held_out=True).collect()}
    for (i, _), want in zip(rows, held_out_scores(rows, {1, 3})):
        assert got[i] == pytest.approx(want, abs=1e-9)


def test_no_table_of_buckets_is_copied_for_each_row(spark, docs, tmp_path):
    docs.write.parquet(str(tmp_path / "docs"))
    docs = spark.read.parquet(str(tmp_path / "docs"))
    judged = quality.judge(docs, docs.select("doc_id"), held_out=True)
    step = judged._jdf.queryExecution().optimizedPlan()
    while not step.children().isEmpty():
        output = step.output().mkString(" ")
        assert not any(f"_{name}#" in output for name in ("raw", "target", "raw_once", "target_once"))
        step = step.children().apply(0)
