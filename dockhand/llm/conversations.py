"""Conversation repair by dynamic programming with checkpoints.

A conversation is put right by the cheapest edits after which the roles' initials read
``(s?(ua)+)?``.  What the rest of it costs from each of four states is computed backwards,
but kept only at checkpoints, one for each ``BLOCK`` rows:

1. Rows are ordered by range, so that a conversation of any length spreads over tasks, and
   leave one byte each: what can be done with the row.  Blocks of bytes carry what they
   cost from every state to every other.
2. Backwards over blocks, each conversation's cost vector at every checkpoint; one vector
   is held at a time.
3. Each block recomputes its vectors from its checkpoint and walks forward from every state,
   always by the tight edit whose initial is least; blocks do this independently.
4. Forward over blocks, the walk that begins where the last one ended is taken.

Steps 2 and 4 see a few numbers a block, never the rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockhand.llm.common import SPACE_CLASS, SPACES, ship_code, written

# Rows between checkpoints, the square root of 16 million.
BLOCK = 4096
# What edits cost, and the roles they can give.
REROLE, DELETE, INSERT, CUT_OFF = 3, 4, 3, 3
ROLES = {"u": "user", "a": "assistant"}

# States: nothing yet, after s, after u, after a.  All costs are below FAR.
START, SYSTEM, USER, ASSISTANT = range(4)
STATES = 4
FAR = 1 << 60
ENDS = (0, FAR, FAR, 0)
# The state that an inserted or changed turn leads to, and its initial.
NEXT = (USER, USER, ASSISTANT, USER)
GIVEN = "uuau"

# A row's byte: its role's initial and two flags.
INITIALS = "sua"
OTHER = 3
MUST_GO, IS_CUT_OFF = 4, 8


def _kept(code: int, state: int) -> int | None:
    """The state after keeping a row, nothing where that is not allowed."""
    if code & MUST_GO:
        return None
    initial = code & 3
    if initial == 0:
        return SYSTEM if state == START else None
    if initial == OTHER:
        return None
    return NEXT[state] if INITIALS[initial] == GIVEN[state] else None


def _steps() -> list[list[list[tuple[str, int, int]]]]:
    """For each byte and state the edits of that row: initial, state after, cost."""
    table = []
    for code in range(16):
        more = CUT_OFF if code & IS_CUT_OFF else 0
        row = []
        for state in range(STATES):
            edits = [("D", state, DELETE)]
            kept = _kept(code, state)
            if kept is not None:
                edits.append(("K", kept, more))
            if not code & MUST_GO:
                edits.append(("R", NEXT[state], REROLE + more))
            row.append(edits)
        table.append(row)
    return table


STEPS = _steps()


def _with_inserts(costs: list[int]) -> list[int]:
    """Costs when turns may be inserted first."""
    costs = list(costs)
    for _ in range(STATES):
        for state in range(STATES):
            costs[state] = min(costs[state], INSERT + costs[NEXT[state]])
    return costs


AT_END = tuple(_with_inserts(list(ENDS)))


def _before(code: int, after: list[int]) -> list[int]:
    """The cost vector in front of a row."""
    return _with_inserts([min(cost + after[to] for _, to, cost in edits) for edits in STEPS[code]])


def block_costs(codes: bytes) -> list[int]:
    """What a block costs from state ``i`` to state ``j``, at ``4 * i + j``.

    Turns inserted before a row belong to its block, those after the last row do not.
    """
    columns = []
    for end in range(STATES):
        costs = [FAR] * STATES
        costs[end] = 0
        for code in reversed(codes):
            costs = _before(code, costs)
        columns.append(costs)
    return [min(columns[j][i], FAR) for i in range(STATES) for j in range(STATES)]


def through_block(costs: list[int], after: list[int]) -> list[int]:
    """The cost vector in front of a block, from the one behind it."""
    return [min(costs[STATES * i + j] + after[j] for j in range(STATES)) for i in range(STATES)]


def block_walks(codes: bytes, after: list[int]) -> tuple[list[int], list[str]]:
    """From each state, the state after the block and the ASCII-least of its tight edits."""
    vectors = [list(after)]
    for code in reversed(codes):
        vectors.append(_before(code, vectors[-1]))
    vectors.reverse()
    ends, edits = [], []
    for state in range(STATES):
        done = []
        for i, code in enumerate(codes):
            while True:
                left = vectors[i][state]
                options = [
                    (name, to) for name, to, cost in STEPS[code][state] if cost + vectors[i + 1][to] == left
                ]
                if INSERT + vectors[i][NEXT[state]] == left:
                    options.append(("I", NEXT[state]))
                name, state = min(options)
                done.append(name)
                if name != "I":
                    break
        ends.append(state)
        edits.append("".join(done))
    return ends, edits


def last_inserts(state: int) -> str:
    """What a conversation in this state still needs after its last row."""
    return "I" * (AT_END[state] // INSERT)


def _initial(role: Column) -> Column:
    return F.substring(role, 1, 1)


def _codes(initial: Column, blank: Column) -> Column:
    last = F.substring(F.rtrim(F.col("text"), F.lit(SPACES)), -1, 1)
    number = F.when(initial == "s", 0).when(initial == "u", 1).when(initial == "a", 2).otherwise(OTHER)
    cut_off = ~blank & ~last.isin(".", "!", "?")
    return (
        number + F.when(blank, MUST_GO).otherwise(0) + F.when(cut_off, IS_CUT_OFF).otherwise(0)
    ).cast("int")


_KEYS = ["conv", "turn", "role", "h1", "h2"]


def _hashed(turns: DataFrame) -> DataFrame:
    return turns.select(
        "*", F.xxhash64("text").alias("h1"), F.xxhash64(F.lit(1), "text").alias("h2")
    )


def _ordered(turns: DataFrame) -> DataFrame:
    """Rows without their texts, with ``place``, a number that follows their order.

    Order is by turn (nulls first), then role, then a hash of the text.  Of rows with the
    role and text of an earlier one ``code`` says that they must go.
    """
    full = F.col("text").rlike("[^" + SPACE_CLASS[1:])
    light = written(
        _hashed(turns).select(
            *_KEYS, full.alias("full"), _codes(_initial(F.col("role")), ~full).alias("code")
        ).withColumn("dealt", F.monotonically_increasing_id())
        .repartitionByRange(*_KEYS, "dealt").sortWithinPartitions(*_KEYS, "dealt")
        .withColumn("place", F.monotonically_increasing_id()).drop("dealt"),
        "turns_ordered",
    )
    same = ["conv", "role", "h1", "h2"]
    repeated = light.filter("full").groupBy(*same).agg(
        F.min("place").alias("earliest"), F.count("*").alias("n")
    ).filter("n > 1").drop("n")
    on = F.lit(True)
    for name in same:
        on = on & F.col(f"a.{name}").eqNullSafe(F.col(f"b.{name}"))
    later = light.filter("full").alias("a").join(repeated.alias("b"), on).filter(
        "place > earliest"
    ).select("place", F.lit(True).alias("again"))
    return light.join(later, "place", "left").select(
        "conv", "turn", "place", _initial(F.col("role")).alias("initial"), "full",
        F.coalesce("again", F.lit(False)).alias("again"),
        F.when(F.col("again"), F.col("code").bitwiseAND(3) + MUST_GO).otherwise(F.col("code")).alias("code"),
    ).repartitionByRange("place").sortWithinPartitions("place")


_BLOCKS = (
    "conv {id}, place long, codes binary, costs array<long>, first_initial string, last_initial string,"
    " first_turn long, last_turn long, turns long, blank long, duplicate long, truncated long, illegal long"
)
_LEGAL = {"su", "ua", "au"}


def _blocks(block: int):
    """Consecutive rows of a conversation as blocks, with their counts."""

    def closed(rows: list[tuple]) -> dict:
        codes = bytes(r[5] for r in rows)
        initials = [r[2] for r in rows]
        turns = [r[1] for r in rows if r[1] is not None]
        return {
            "conv": rows[0][6], "place": rows[0][0], "codes": codes, "costs": block_costs(codes),
            "first_initial": initials[0], "last_initial": initials[-1],
            "first_turn": turns[0] if turns else None, "last_turn": turns[-1] if turns else None,
            "turns": len(set(turns)),
            "blank": sum(not r[3] for r in rows), "duplicate": sum(r[4] for r in rows),
            "truncated": sum(bool(c & IS_CUT_OFF) for c in codes),
            "illegal": sum(x + y not in _LEGAL for x, y in zip(initials, initials[1:])),
        }

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows: list[tuple] = []
        schema = None
        for batch in batches:
            done = []
            columns = [batch.column(c).to_pylist() for c in
                       ("place", "turn", "initial", "full", "again", "code", "conv")]
            schema = pa.schema([("conv", batch.schema.field("conv").type), *_BLOCK_FIELDS])
            for row in zip(*columns):
                if rows and (row[6] != rows[0][6] or len(rows) == block):
                    done.append(closed(rows))
                    rows = []
                rows.append(row)
            if done:
                yield pa.RecordBatch.from_pylist(done, schema)
        if rows:
            yield pa.RecordBatch.from_pylist([closed(rows)], schema)

    return run


_BLOCK_FIELDS = [
    ("place", pa.int64()), ("codes", pa.binary()), ("costs", pa.list_(pa.int64())),
    ("first_initial", pa.string()), ("last_initial", pa.string()),
    *[(n, pa.int64()) for n in (
        "first_turn", "last_turn", "turns", "blank", "duplicate", "truncated", "illegal")],
]


def _backward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Each block's checkpoint: blocks come by conversation, the last one first.

    ``cost`` is that of the rest from the block on, begun at the start.
    """
    now, after = object(), None
    for batch in batches:
        places, vectors, totals = [], [], []
        for conv, place, costs in zip(*[batch.column(c).to_pylist() for c in ("conv", "place", "costs")]):
            if conv != now:
                now, after = conv, list(AT_END)
            places.append(place)
            vectors.append(after)
            after = through_block(costs, after)
            totals.append(after[START])
        yield pa.RecordBatch.from_arrays(
            [pa.array(places, pa.int64()), pa.array(vectors, pa.list_(pa.int64())), pa.array(totals, pa.int64())],
            names=["place", "after", "cost"],
        )


def _walks(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        found = [
            block_walks(codes, after)
            for codes, after in zip(batch.column("codes").to_pylist(), batch.column("after").to_pylist())
        ]
        kept = [c for c in batch.schema.names if c not in ("codes", "costs", "after")]
        yield pa.RecordBatch.from_arrays(
            [*[batch.column(c) for c in kept],
             pa.array([ends for ends, _ in found], pa.list_(pa.int64())),
             pa.array([edits for _, edits in found], pa.list_(pa.string()))],
            names=[*kept, "ends", "edits"],
        )


_SUMS = ["blank", "duplicate", "truncated", "illegal"]
_TOTALS = ["gaps", *_SUMS, "cost"]


def _forward(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The walk taken in each block; a conversation's figures are those of its last row."""
    names = ["conv", "place", "first_initial", "last_initial", "first_turn", "last_turn", "turns", *_SUMS,
             "cost", "ends", "edits"]
    held, now = None, object()
    state = sums = lows = kind = None

    def out(rows: list[dict]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pylist(rows, pa.schema([("conv", kind), *_PLAN_FIELDS]))

    def finish() -> dict:
        last = {**held, "edits": held["edits"] + last_inserts(state)}
        first_turn, last_turn, turns = lows["first"], lows["last"], lows["turns"]
        gaps = 0 if first_turn is None else last_turn - first_turn + 1 - turns
        return {**last, **sums, "gaps": gaps, "is_last": True}

    for batch in batches:
        done, kind = [], batch.schema.field("conv").type
        for row in zip(*[batch.column(c).to_pylist() for c in names]):
            r = dict(zip(names, row))
            if held is not None and r["conv"] == now:
                sums["illegal"] += (held["last_initial"] + r["first_initial"]) not in _LEGAL
                done.append({**held, "is_last": False})
            else:
                if held is not None:
                    done.append(finish())
                now, state = r["conv"], START
                sums = {**dict.fromkeys(_SUMS, 0), "cost": r["cost"]}
                lows = {"first": None, "last": None, "turns": 0}
            for name in _SUMS:
                sums[name] += r[name]
            if r["turns"]:
                lows["turns"] += r["turns"] - (lows["last"] == r["first_turn"])
                lows["first"] = r["first_turn"] if lows["first"] is None else lows["first"]
                lows["last"] = r["last_turn"]
            held = {"conv": now, "place": r["place"], "last_initial": r["last_initial"],
                    "edits": r["edits"][state]}
            state = r["ends"][state]
        if done:
            yield out(done)
    if held is not None:
        yield out([finish()])


_PLAN_FIELDS = [
    ("place", pa.int64()), ("edits", pa.string()), ("is_last", pa.bool_()),
    *[(n, pa.int64()) for n in _TOTALS],
]


def plan_repairs(turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """The cheapest edits of each conversation, a row for each block of it.

    ``turns`` has ``conv``, ``turn``, ``role`` and ``text`` (see :func:`as_turns`).  Columns:
    ``conv``, ``place`` (orders the blocks), ``edits`` (initials of Keep, Rerole, Delete and
    Insert, in order); and where ``is_last``, the whole conversation's ``gaps``, ``blank``,
    ``duplicate``, ``truncated``, ``illegal`` and ``cost``.  No turns give no rows.
    """
    ship_code(turns.sparkSession)
    kind = turns.schema["conv"].dataType.simpleString()
    blocks = written(
        _ordered(turns).mapInArrow(_blocks(block), _BLOCKS.replace("{id}", kind)), "turn_blocks"
    )
    by_conversation = F.xxhash64("conv")
    checkpoints = (
        blocks.select("conv", "place", "costs").repartition(by_conversation)
        .sortWithinPartitions("conv", F.desc("place")).mapInArrow(_backward, "place long, after array<long>, cost long")
    )
    kept = [f for f in blocks.schema if f.name not in ("codes", "costs")]
    rest = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in kept)
    walks = blocks.join(checkpoints, "place").select(
        "codes", "after", *[f.name for f in kept], "cost"
    ).mapInArrow(
        _walks, f"{rest}, cost long, ends array<long>, edits array<string>"
    ).repartition(by_conversation).sortWithinPartitions("conv", "place")
    plan = f"conv {kind}, place long, edits string, is_last boolean, " + ", ".join(f"{n} long" for n in _TOTALS)
    return written(walks.mapInArrow(_forward, plan), "turn_plan")


def as_turns(
    df: DataFrame, conv_col: str = "conv_id", turn_col: str = "turn", role_col: str = "role",
    text_col: str = "text",
) -> DataFrame:
    """Any table of turns under the names used here; a null role or text is one space.

    Rows without a conversation id are one conversation.  Other columns are left behind.
    """
    return df.select(
        F.col(conv_col).alias("conv"), F.col(turn_col).cast("bigint").alias("turn"),
        F.coalesce(F.col(role_col).cast("string"), F.lit(" ")).alias("role"),
        F.coalesce(F.col(text_col).cast("string"), F.lit(" ")).alias("text"),
    )


def _repaired(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edits, then texts, conversation by conversation; out come the turns that stay."""
    now, edits, at, state, position = object(), "", 0, START, 0
    size = 0
    for batch in batches:
        rows: list[tuple] = []
        kind = batch.schema.field("conv").type

        def insert() -> None:
            nonlocal at, state, position
            while at < len(edits) and edits[at] == "I":
                rows.append((now, position, ROLES[GIVEN[state]], "", "I"))
                at, state, position = at + 1, NEXT[state], position + 1

        columns = [batch.column(c).to_pylist() for c in ("conv", "edits", "role", "text")]
        for conv, more, role, text in zip(*columns):
            if conv != now:
                now, edits, at, state, position = conv, "", 0, START, 0
            if more is not None:
                edits += more
                continue
            insert()
            edit = edits[at]
            at += 1
            if edit == "R":
                role = ROLES[GIVEN[state]]
            if edit != "D":
                rows.append((conv, position, role, text, edit))
                position += 1
                state = SYSTEM if state == START and role[:1] == "s" else NEXT[state]
            insert()
        if rows:
            yield pa.RecordBatch.from_arrays(
                [pa.array(c, t) for c, t in zip(
                    zip(*rows), (kind, pa.int64(), pa.string(), pa.string(), pa.string()))],
                names=["conv", "position", "role", "text", "edit"],
            )


def repaired_turns(turns: DataFrame, plan: DataFrame) -> DataFrame:
    """The turns of all repaired conversations, by conversation and ``position`` from 0.

    The edits of a conversation, a character a row, come before its texts; of these one is
    held at a time.  Columns: ``conv``, ``position``, ``role``, ``text``, ``edit`` (K, R or I).
    The rows of a conversation lie in order in one partition.
    """
    kind = turns.schema["conv"].dataType.simpleString()
    texts = _hashed(turns).select(
        *_KEYS, "text", F.lit(None).cast("long").alias("place"), F.lit(None).cast("string").alias("edits"),
        F.lit(True).alias("is_text"),
    )
    edits = plan.select(
        "conv", *[F.lit(None).cast(turns_type).alias(n) for n, turns_type in (
            ("turn", "long"), ("role", "string"), ("h1", "long"), ("h2", "long"), ("text", "string"))],
        "place", "edits", F.lit(False).alias("is_text"),
    )
    return (
        texts.unionByName(edits).repartition(F.xxhash64("conv"))
        .sortWithinPartitions("conv", "is_text", "place", *_KEYS[1:])
        .select("conv", "edits", "role", "text")
        .mapInArrow(_repaired, f"conv {kind}, position long, role string, text string, edit string")
    )


def digests(repaired: DataFrame) -> DataFrame:
    """SHA-256 of each conversation's ``role:text`` lines, read in the order they lie in.

    ``repaired`` comes straight from :func:`repaired_turns`.  A digest is made of all of a
    conversation in order, so one task reads it, a batch at a time.
    """
    kind = repaired.schema["conv"].dataType.simpleString()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, digest, field = object(), None, None

        def out(rows: list[tuple]) -> pa.RecordBatch:
            return pa.RecordBatch.from_arrays(
                [pa.array([r[0] for r in rows], field), pa.array([r[1] for r in rows], pa.string())],
                names=["conv", "repaired_sha256"],
            )

        for batch in batches:
            done, field = [], batch.schema.field("conv").type
            for conv, role, text in zip(*[batch.column(c).to_pylist() for c in ("conv", "role", "text")]):
                if conv != now:
                    if digest:
                        done.append((now, digest.hexdigest()))
                    now, digest = conv, hashlib.sha256()
                else:
                    digest.update(b"\n")
                digest.update(f"{role}:{text}".encode())
            if done:
                yield out(done)
        if digest:
            yield out([(now, digest.hexdigest())])

    return repaired.select("conv", "role", "text").mapInArrow(run, f"conv {kind}, repaired_sha256 string")


def damaged(df: DataFrame) -> DataFrame:
    """Turns with planted faults, by a hash of conversation and turn (see :func:`as_turns`).

    Of twenty rows one goes, one loses its text, one its full stops, one comes twice and one
    becomes the user's.
    """
    key = F.concat_ws(
        ":", *[F.coalesce(F.col(c).cast("string"), F.lit(" ")) for c in ("conv", "turn")]
    )
    draw = F.crc32(F.encode(key, "UTF-8")) % 20
    return (
        as_turns(df).withColumn("draw", draw).filter("draw <> 0")
        .withColumn("copy", F.explode(F.when(F.col("draw") == 3, F.array(F.lit(1), F.lit(2))).otherwise(F.array(F.lit(1)))))
        .select(
            "conv", "turn", F.when(F.col("draw") == 4, "user").otherwise(F.col("role")).alias("role"),
            F.when(F.col("draw") == 1, "").when(F.col("draw") == 2, F.regexp_replace("text", "[.!?]", ""))
            .otherwise(F.col("text")).alias("text"),
        )
    )


def repair_report(conversations: DataFrame, turns: DataFrame, block: int = BLOCK) -> DataFrame:
    """One row for each id of ``conversations`` (``conv``): faults, edits and digest.

    Columns: ``conv``, ``gaps``, ``blank``, ``duplicate``, ``truncated``, ``illegal``, ``cost``,
    ``audit``, ``repaired_sha256``.  A conversation without turns has zeros, no edits and the
    digest of nothing.
    """
    plan = plan_repairs(turns, block)
    edits = F.transform(F.sort_array(F.collect_list(F.struct("place", "edits"))), lambda x: x["edits"])
    whole = plan.groupBy("conv").agg(
        F.array_join(edits, "").alias("audit"), *[F.max(n).alias(n) for n in _TOTALS]
    )
    found = digests(repaired_turns(turns, plan))
    ids = conversations.select("conv").distinct().withColumnRenamed("conv", "id")
    same = F.col("id").eqNullSafe(F.col("conv"))
    return ids.join(whole, same, "left").drop("conv").join(found, same, "left").select(
        F.col("id").alias("conv"), *[F.coalesce(n, F.lit(0).cast("bigint")).alias(n) for n in _TOTALS],
        F.coalesce("audit", F.lit("")).alias("audit"),
        F.coalesce("repaired_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("repaired_sha256"),
    )
