"""Conversation repair against a search over all edits."""

from __future__ import annotations

import hashlib
import heapq
import random
import re
import zlib
from collections import defaultdict

import pytest
import xxhash

from dockhand.llm import conversations

BLANK = " \t\n\x0b\x0c\r"
SHOWN = ["gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]


def damage(rows):
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        key = ":".join(" " if x is None else str(x) for x in (conv, turn))
        draw = zlib.crc32(key.encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        if draw == 1:
            text = ""
        if draw == 2:
            text = re.sub("[.!?]", "", text)
        if draw == 4:
            role = "user"
        by[conv] += [] if draw == 0 else [(turn, role, text)] * (2 if draw == 3 else 1)
    return by


def order(row):
    """By turn, nulls first, then role, then a hash of the text."""
    turn, role, text = row
    digest = xxhash.xxh64(text.encode(), seed=42).intdigest()
    return turn is not None, turn or 0, role.encode(), digest - (1 << 64 if digest >> 63 else 0)


def cheapest(rows, kinds):
    """The first of the cheapest edits, of equal ones the least as text."""
    heap, done = [(0, "", 0, "", ())], set()
    while True:
        cost, audit, i, last, out = heapq.heappop(heap)
        if (i, last) in done:
            continue
        done.add((i, last))
        if i == len(rows) and last in ("", "a"):
            return cost, audit, out
        wanted = {"": "su", "s": "u", "u": "a", "a": "u"}[last]
        given = [(g, full) for g, full in (("u", "user"), ("a", "assistant")) if g in wanted]
        for g, full in given:
            heapq.heappush(heap, (cost + 3, audit + "I", i, g, (*out, (full, ""))))
        if i < len(rows):
            _, role, text = rows[i]
            more = 3 if kinds[i] == "truncated" else 0
            heapq.heappush(heap, (cost + 4, audit + "D", i + 1, last, out))
            if kinds[i] not in ("blank", "duplicate"):
                if role and role[0] in wanted:
                    heapq.heappush(heap, (cost + more, audit + "K", i + 1, role[0], (*out, (role, text))))
                for g, full in given:
                    heapq.heappush(heap, (cost + 3 + more, audit + "R", i + 1, g, (*out, (full, text))))


def brute_force(ids, by):
    found = {}
    for conv in ids:
        rows, seen, kinds = sorted(by[conv], key=order), set(), []
        for _, role, text in rows:
            bare = text.strip(BLANK)
            kinds.append(
                "blank" if not bare else "duplicate" if (role, text) in seen
                else "truncated" if bare[-1] not in ".!?" else ""
            )
            seen.add((role, text))
        turns = [t for t, _, _ in rows if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[1][:1] + b[1][:1] not in ("su", "ua", "au") for a, b in zip(rows, rows[1:]))
        cost, audit, out = cheapest(rows, kinds)
        digest = hashlib.sha256("\n".join(f"{r}:{t}" for r, t in out).encode()).hexdigest()
        found[conv] = (
            gaps, *(kinds.count(k) for k in ("blank", "duplicate", "truncated")), illegal, cost, audit, digest
        )
    return found


def random_rows(seed: int, conversations_: int = 40, ids=None) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for conv in [None, *range(conversations_)]:
        for t in range(rng.choice([1, 2, 5, 30])):
            rows.append((
                conv, rng.choice([t, t, t, t + 3, None]),
                rng.choice(["user", "assistant", "system", "tool", "", None, "User", "user", "assistant"]),
                rng.choice(["hi.", "yes!", "no", "", None, " \n", "Why?\t", "same.", "a b.c", "état", " "]),
            ))
    return rows


def frame(spark, rows, kind="long"):
    df = spark.createDataFrame(rows, f"conv_id {kind}, turn long, role string, text string")
    return df.selectExpr("*", "'x' AS conv", "1 AS place", "'y' AS edits", "2 AS code").repartition(3)


def report(df, turns=None, block=conversations.BLOCK):
    turns = conversations.damaged(df) if turns is None else turns
    rows = conversations.repair_report(conversations.as_turns(df), turns, block).collect()
    assert len({r.conv for r in rows}) == len(rows)
    return {r.conv: tuple(r[c] for c in SHOWN) for r in rows}


@pytest.mark.parametrize("seed,block", [(1, 4096), (1, 3), (2, 1)])
def test_against_a_search(spark, seed, block):
    rows = random_rows(seed)
    ids = {r[0] for r in rows}
    assert report(frame(spark, rows), block=block) == brute_force(ids, damage(rows))


def test_undamaged_turns_and_text_ids(spark):
    rows = [(None if c is None else f"id {c}", t, r, x) for c, t, r, x in random_rows(3, 20)]
    df = frame(spark, rows, "string")
    by = defaultdict(list)
    for conv, turn, role, text in rows:
        by[conv].append((turn, " " if role is None else role, " " if text is None else text))
    assert report(df, conversations.as_turns(df)) == brute_force({r[0] for r in rows}, by)


def test_conversation_over_many_partitions_and_blocks(spark):
    """A conversation with most of all rows, whose texts repeat."""
    rng = random.Random(4)
    rows = [(7, t // 2, ["user", "assistant", "system"][rng.randrange(3) if t % 5 == 0 else t % 2], f"text {t % 700}.")
            for t in range(3000)]
    rows += random_rows(5, 10)
    spark.conf.set("spark.sql.shuffle.partitions", "7")
    try:
        got = report(frame(spark, rows), block=64)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "4")
    assert got == brute_force({r[0] for r in rows}, damage(rows))


def test_repaired_turns(spark):
    given = [(0, "assistant", "hello."), (1, "user", "cut"), (2, "user", "Why?")]
    turns = conversations.as_turns(frame(spark, [*[(1, *r) for r in given], (2, 0, "user", " ")]))
    plan = conversations.plan_repairs(turns)
    rows = sorted(conversations.repaired_turns(turns, plan).collect(), key=lambda r: r.position)
    cost, audit, out = cheapest(given, ["", "truncated", ""])
    assert [(r.conv, r.position, r.role, r.text) for r in rows] == [(1, i, *r) for i, r in enumerate(out)]
    assert [r.edit for r in rows] == [e for e in audit if e != "D"]
    found = {r.conv: (r.edits, r.cost) for r in plan.collect()}
    assert found == {1: (audit, cost), 2: ("D", 4)}


def test_no_turns_and_no_table(spark):
    df = frame(spark, [(1, 0, "user", "hi."), (None, None, None, None)])
    nothing = conversations.as_turns(df).filter("turn > 99")
    empty = hashlib.sha256(b"").hexdigest()
    assert report(df, nothing) == {1: (0, 0, 0, 0, 0, 0, "", empty), None: (0, 0, 0, 0, 0, 0, "", empty)}
    assert report(frame(spark, [])) == {}


@pytest.mark.parametrize("seed", range(30))
def test_blocks_compose(seed):
    """Costs and walks of blocks are those of the whole, wherever it is cut."""
    rng = random.Random(seed)
    codes = bytes(rng.choice([0, 1, 2, 3, 4, 5, 6, 9, 10, 11]) for _ in range(rng.randrange(1, 40)))
    after = list(conversations.AT_END)
    whole = conversations.through_block(conversations.block_costs(codes), after)
    cut = rng.randrange(len(codes) + 1)
    first, last = codes[:cut], codes[cut:]
    middle = conversations.through_block(conversations.block_costs(last), after)
    assert conversations.through_block(conversations.block_costs(first), middle) == whole
    ends, edits = conversations.block_walks(codes, after)
    one_ends, one_edits = conversations.block_walks(first, middle)
    two_ends, two_edits = conversations.block_walks(last, after)
    for state in range(conversations.STATES):
        assert edits[state] == one_edits[state] + two_edits[one_ends[state]]
        assert ends[state] == two_ends[one_ends[state]]
