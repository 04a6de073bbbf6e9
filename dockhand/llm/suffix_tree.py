"""Scoring texts with a probabilistic suffix tree.

Symbols are the most frequent words, one class for all rarer words, and the end.  A context
is the last one to three symbols.  Contexts seen often enough are counted, level by level,
and retained where the distribution of their next symbol diverges from that of the context
one shorter.  Each retained state mixes its own counts with its parent's distribution, and
a token is scored in the state of its longest retained context.  Within the class of rare
words a word has its share of the plain word counts or, with ``every_word``, of the counts
after each retained context, mixed with its share in the parent by the number of distinct
words there (Witten and Bell).  Every word that reaches the share asked of a context is a
symbol then, so the alphabet leaves out neither a context nor a next word.

The tree has a fixed largest size and goes to every task.  Counts of words, and of rare words
after retained contexts, grow with the corpus and never meet in one place: each portion of
documents asks for the counts of its distinct ones, and gets them back by hash bucket.
"""

from __future__ import annotations

import zlib
from collections.abc import Iterator
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockhand.llm.common import ship_code, shuffle_partitions, text_of, written
from dockhand.llm.wordhash import portions, word_hashes

# Words that are symbols of their own; with ``every_word`` also all that may be contexts.
ALPHABET = 1000
DEPTH = 3
# Contexts with at least this share of all training tokens are counted, so at most 2,000 of
# each length.
MIN_SHARE = 5e-4
# Retained are contexts whose next symbol diverges by so many nats a token, and by more in
# all than describing the distribution costs.
MIN_DIVERGENCE = 0.002
# How many tokens of its own a state needs to outweigh its parent.
PARENT_WEIGHT = 30.0
# The count added to that of every word, and of one word for all unknown ones.
ADDED = 0.1
# A portion of documents that asks for word counts together.
PORTION_BYTES = 12 << 20

END = np.uint64(0x5851F42D4C957F2D)
_MAX_DISTINCT = 1_000_000
# Rare tokens whose kinds are counted at a time, and training tokens that a bucket of kinds is for.
_MAX_KINDS = 3_000_000
_BUCKET_TOKENS = 4_000_000
_ROWS = 64


def in_training(id_col: str) -> Column:
    """Whether a row is learnt from; a null id counts as an empty text."""
    text = F.coalesce(F.col(id_col).cast("string"), F.lit(""))
    return F.crc32(F.encode(text, "UTF-8")) % 10 != 0


def _token_arrays(texts: pa.Array) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Portions of a column: first row, hashes of all tokens with ends, places of the texts."""
    for first, data, offsets in portions(texts):
        hashes, places = word_hashes(data, offsets)
        yield first, np.insert(hashes, places[1:], END), places + np.arange(len(places))


# Counts of words.


def _word_counts(df: DataFrame, buckets: int) -> DataFrame:
    """``bucket``, sorted ``hashes`` and their ``counts`` of the tokens of all texts."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        for batch in batches:
            for _, tokens, _ in _token_arrays(batch.column(0)):
                held, counts = _merged(held, counts, *np.unique(tokens, return_counts=True))
                if len(held) > _MAX_DISTINCT:
                    yield _bucketed(held, counts, buckets)
                    held, counts = np.zeros(0, np.uint64), np.zeros(0, np.int64)
        yield _bucketed(held, counts, buckets)

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, held, counts = None, None, None
        for batch in batches:
            for bucket, hashes, numbers in zip(*[c.to_pylist() for c in batch.columns]):
                if bucket != now:
                    if now is not None:
                        yield _bucket_row(now, held, counts)
                    now, held, counts = bucket, np.zeros(0, np.uint64), np.zeros(0, np.int64)
                held, counts = _merged(
                    held, counts, np.frombuffer(hashes, np.uint64), np.frombuffer(numbers, np.int32)
                )
        if now is not None:
            yield _bucket_row(now, held, counts)

    schema = "bucket int, hashes binary, counts binary"
    partial = df.select("text").mapInArrow(count, schema)
    return partial.repartition("bucket").sortWithinPartitions("bucket").mapInArrow(
        add, schema + ", tokens long, words long"
    )


def _merged(hashes, counts, more, numbers) -> tuple[np.ndarray, np.ndarray]:
    if not len(hashes):
        return more, numbers.astype(np.int64)
    both, place = np.unique(np.concatenate((hashes, more)), return_inverse=True)
    sums = np.zeros(len(both), np.int64)
    sums += np.bincount(place[: len(hashes)], counts, len(both)).astype(np.int64)
    sums += np.bincount(place[len(hashes):], numbers, len(both)).astype(np.int64)
    return both, sums


def _edges(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """Where each bucket begins among sorted hashes; buckets are ranges of hashes."""
    width = (1 << 64) // buckets + 1
    limits = np.array([min(b * width, (1 << 64) - 1) for b in range(1, buckets)], np.uint64)
    return np.concatenate(([0], np.searchsorted(hashes, limits), [len(hashes)]))


def _bucketed(hashes: np.ndarray, counts: np.ndarray, buckets: int) -> pa.RecordBatch:
    edges = _edges(hashes, buckets)
    filled = [b for b in range(buckets) if edges[b] < edges[b + 1]]
    return pa.RecordBatch.from_arrays([
        pa.array(filled, pa.int32()),
        pa.array([hashes[edges[b]:edges[b + 1]].tobytes() for b in filled], pa.binary()),
        pa.array(
            [counts[edges[b]:edges[b + 1]].astype(np.int32).tobytes() for b in filled], pa.binary()
        ),
    ], ["bucket", "hashes", "counts"])


def _bucket_row(bucket: int, hashes: np.ndarray, counts: np.ndarray) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([
        pa.array([bucket], pa.int32()), pa.array([hashes.tobytes()], pa.binary()),
        pa.array([counts.astype(np.int64).tobytes()], pa.binary()),
        pa.array([int(counts.sum())], pa.int64()), pa.array([len(hashes)], pa.int64()),
    ], ["bucket", "hashes", "counts", "tokens", "words"])


def _most_frequent(counted: DataFrame, limit: int) -> list[tuple[int, int]]:
    """The hashes and counts of the most frequent words; ``limit`` of them at most."""

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for hashes, counts in zip(*[c.to_pylist() for c in batch.columns]):
                numbers = np.frombuffer(counts, np.int64)
                top = np.argsort(-numbers, kind="stable")[:limit]
                yield pa.RecordBatch.from_arrays([
                    pa.array(np.frombuffer(hashes, np.int64)[top], pa.int64()),
                    pa.array(numbers[top], pa.int64()),
                ], ["hash", "count"])

    found = counted.select("hashes", "counts").mapInArrow(best, "hash long, count long")
    rows = found.orderBy(F.desc("count"), "hash").limit(limit).collect()
    return [(r["hash"], r["count"]) for r in rows]


# The tree.


@dataclass
class Tree:
    """The model of all tasks, of bounded size."""

    words: np.ndarray  # sorted hashes of the words that are symbols
    counts: np.ndarray  # their counts
    tokens: int
    distinct: int
    # For each length: sorted codes of the contexts counted, and their states, -1 for none.
    codes: list[np.ndarray] = field(default_factory=list)
    states: list[np.ndarray] = field(default_factory=list)
    # log10 of every symbol's probability in every state; state 0 has no context.
    logs: np.ndarray | None = None
    # Each state's parent.
    parents: list[int] = field(default_factory=lambda: [0])

    @property
    def rare(self) -> int:
        return len(self.words)

    @property
    def symbols(self) -> int:
        """Words, the rare class, and the start, which only contexts have."""
        return len(self.words) + 2

    @property
    def total(self) -> float:
        return self.tokens + ADDED * (self.distinct + 1)

    def root(self) -> np.ndarray:
        """The probability of each symbol without context."""
        known = (self.counts + ADDED) / self.total
        return np.concatenate((known, [max(1.0 - known.sum(), ADDED / self.total), 0.0]))

    def symbols_of(self, tokens: np.ndarray) -> np.ndarray:
        if not len(self.words):
            return np.zeros(len(tokens), np.int64)
        place = np.minimum(np.searchsorted(self.words, tokens), len(self.words) - 1)
        return np.where(self.words[place] == tokens, place, self.rare)

    def contexts(self, symbols: np.ndarray, places: np.ndarray, length: int) -> np.ndarray:
        """The code of the last ``length`` symbols before every token."""
        inside = np.arange(len(symbols)) - np.repeat(places[:-1], np.diff(places))
        code = np.zeros(len(symbols), np.int64)
        for d in range(length, 0, -1):
            before = np.full(len(symbols), self.symbols - 1)
            before[d:] = np.where(inside[d:] >= d, symbols[:-d], self.symbols - 1)
            code = code * self.symbols + before
        return code

    @property
    def kind(self) -> type:
        """The type of a state's number."""
        return np.uint16 if len(self.parents) < 1 << 16 else np.uint32

    def states_of(self, symbols: np.ndarray, places: np.ndarray) -> np.ndarray:
        """The state of every token: that of its longest retained context."""
        state = np.zeros(len(symbols), np.int64)
        for length, (codes, states) in enumerate(zip(self.codes, self.states), 1):
            at = _found(codes, self.contexts(symbols, places, length))
            longer = np.where(at >= 0, states[at], -1) if len(states) else at
            state = np.where(longer >= 0, longer, state)
        return state

    def chains(self) -> np.ndarray:
        """A row per state: the retained contexts it ends in, shortest first, itself last; 0 beyond."""
        chains = np.zeros((len(self.parents), len(self.codes)), np.int64)
        for state, parent in enumerate(self.parents[1:], 1):
            # A parent has the smaller number.
            chains[state] = chains[parent]
            chains[state, np.count_nonzero(chains[parent])] = state
        return chains


def _found(codes: np.ndarray, wanted: np.ndarray) -> np.ndarray:
    """The place of each wanted code, -1 where it is not there."""
    if not len(codes):
        return np.full(len(wanted), -1)
    place = np.minimum(np.searchsorted(codes, wanted), len(codes) - 1)
    return np.where(codes[place] == wanted, place, -1)


def _next_counts(df: DataFrame, tree: Tree, codes: np.ndarray, length: int) -> np.ndarray:
    """How often each symbol follows each context; a matrix of bounded size."""
    spark = df.sparkSession
    shared = spark.sparkContext.broadcast((tree, codes))

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, codes = shared.value
        width = tree.symbols
        sums = np.zeros(len(codes) * width, np.int64)
        for batch in batches:
            for _, tokens, places in _token_arrays(batch.column(0)):
                symbols = tree.symbols_of(tokens)
                at = _found(codes, tree.contexts(symbols, places, length))
                seen = at >= 0
                sums += np.bincount(at[seen] * width + symbols[seen], minlength=len(sums))
        for i in range(0, len(codes), _ROWS):
            part = sums[i * width:(i + _ROWS) * width]
            if part.any():
                yield pa.RecordBatch.from_arrays([
                    pa.array([i], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())
                ], ["row", "counts"])

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for row, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(zlib.decompress(counts), np.int64)
                sums[row] = sums[row] + part if row in sums else part
        for row, part in sums.items():
            yield pa.RecordBatch.from_arrays([
                pa.array([row], pa.int32()), pa.array([zlib.compress(part.tobytes(), 1)], pa.binary())
            ], ["row", "counts"])

    schema = "row int, counts binary"
    summed = df.select("text").mapInArrow(count, schema).repartition("row").mapInArrow(add, schema)
    matrix = np.zeros((len(codes), tree.symbols), np.int64)
    for r in summed.collect():
        part = np.frombuffer(zlib.decompress(r["counts"]), np.int64).reshape(-1, tree.symbols)
        matrix[r["row"]:r["row"] + len(part)] = part
    shared.unpersist()
    return matrix


def _grow(train: DataFrame, tree: Tree, depth: int, min_share: float) -> None:
    """Count the contexts of each length and retain those that diverge from their parent."""
    least = max(1, min_share * tree.tokens)
    width = tree.symbols
    distributions = [tree.root()]
    # Of the length before: codes, distributions used below them, whether counted.
    parents = {0: 0}
    codes = np.arange(width)
    for length in range(1, depth + 1):
        matrix = _next_counts(train, tree, codes, length)
        frequent = matrix.sum(axis=1) >= least
        codes, matrix = codes[frequent], matrix[frequent]
        states, own = np.full(len(codes), -1), {}
        for i, code in enumerate(codes.tolist()):
            parent = parents[code % width ** (length - 1)]
            counts = matrix[i]
            n = counts.sum()
            mixed = (counts + PARENT_WEIGHT * distributions[parent]) / (n + PARENT_WEIGHT)
            used = counts > 0
            divergence = float(
                (mixed[used] * np.log(mixed[used] / distributions[parent][used])).sum()
                + (mixed[~used] * np.log(PARENT_WEIGHT / (n + PARENT_WEIGHT))).sum()
            )
            cost = 0.5 * np.count_nonzero(used) * np.log(tree.tokens)
            if divergence >= MIN_DIVERGENCE and n * divergence > cost:
                states[i] = len(distributions)
                own[code] = len(distributions)
                distributions.append(mixed)
                tree.parents.append(parent)
            else:
                own[code] = parent
        tree.codes.append(codes)
        tree.states.append(states)
        # A context one longer is this one and a symbol after it, if its own suffix counts.
        rows, after = np.nonzero(matrix >= least)
        longer = codes[rows] * width + after
        codes = np.sort(longer[np.isin(longer % width ** length, codes)])
        parents = own
        if not len(codes):
            break
    with np.errstate(divide="ignore"):
        tree.logs = np.log10(np.array(distributions)).astype(np.float32)


# Kinds of rare tokens: the word, and the state it is met in.


@dataclass
class _Kinds:
    """Distinct kinds, sorted by word and state."""

    words: np.ndarray  # sorted hashes of the words
    word: np.ndarray  # of each kind, the place of its word
    state: np.ndarray
    counts: np.ndarray
    at: np.ndarray | None = None  # of each token that they were made of, the place of its kind

    @classmethod
    def of(cls, tokens: np.ndarray, states: np.ndarray, counts: np.ndarray | None = None) -> _Kinds:
        """The kinds of tokens; ``counts`` says for how many each stands."""
        words, word = np.unique(tokens, return_inverse=True)
        both, at = np.unique(word.astype(np.int64) << 32 | states.astype(np.int64), return_inverse=True)
        numbers = np.bincount(at, counts, len(both)).astype(np.int64)
        return cls(words, both >> 32, both & 0xFFFFFFFF, numbers, at)

    @classmethod
    def read(cls, row: tuple, kind: type) -> _Kinds:
        """What :meth:`rows` wrote of one bucket; without sizes every word is in state 0."""
        hashes, sizes, states, counts = row
        words = np.frombuffer(hashes, np.uint64)
        if sizes is None:
            word, state = np.arange(len(words)), np.zeros(len(words), np.int64)
        else:
            word = np.repeat(np.arange(len(words)), np.frombuffer(sizes, kind))
            state = np.frombuffer(states, kind).astype(np.int64)
        return cls(words, word, state, np.zeros(0, np.int64) if counts is None else np.frombuffer(counts, np.int64))

    def rows(self, buckets: int, kind: type) -> list[tuple[int, bytes, bytes, bytes, bytes]]:
        """Of each bucket: its number, words, number of states a word has, states, counts."""
        edges = _edges(self.words, buckets)
        begins = np.searchsorted(self.word, edges)
        sizes = np.bincount(self.word, minlength=len(self.words)).astype(kind)
        states = self.state.astype(kind)
        return [
            (b, self.words[a:z].tobytes(), sizes[a:z].tobytes(), states[i:j].tobytes(), self.counts[i:j].tobytes())
            for b, (a, z, i, j) in enumerate(zip(edges, edges[1:], begins, begins[1:])) if a < z
        ]

    def after(self, chains: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """How often a word follows each state, longer contexts included: codes and counts."""
        codes = [np.zeros(0, np.int64)]
        numbers = [np.zeros(0, np.int64)]
        for states in chains[self.state].T:
            codes.append((self.word << 32 | states)[states > 0])
            numbers.append(self.counts[states > 0])
        both, at = np.unique(np.concatenate(codes), return_inverse=True)
        return both, np.bincount(at, np.concatenate(numbers), len(both)).astype(np.int64)


def _kind_counts(df: DataFrame, tree: Tree, buckets: int) -> DataFrame:
    """The kinds of all rare tokens, with ``counts``; a row per bucket."""
    shared = df.sparkSession.sparkContext.broadcast(tree)
    schema = "bucket int, hashes binary, sizes binary, states binary, counts binary"

    def table(rows: list[tuple]) -> pa.RecordBatch:
        kinds = [pa.int32()] + [pa.binary()] * 4
        return pa.RecordBatch.from_arrays(
            [pa.array([r[c] for r in rows], kind) for c, kind in enumerate(kinds)],
            ["bucket", "hashes", "sizes", "states", "counts"],
        )

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.value
        held: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0
        for batch in batches:
            for _, tokens, places in _token_arrays(batch.column(0)):
                symbols = tree.symbols_of(tokens)
                rare = symbols == tree.rare
                held.append((tokens[rare], tree.states_of(symbols, places)[rare]))
                size += len(held[-1][0])
                if size >= _MAX_KINDS:
                    yield table(_Kinds.of(*map(np.concatenate, zip(*held))).rows(buckets, tree.kind))
                    held, size = [], 0
        if held:
            yield table(_Kinds.of(*map(np.concatenate, zip(*held))).rows(buckets, tree.kind))

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind = shared.value.kind
        now, held, size = None, [], 0

        def merged() -> _Kinds:
            return _Kinds.of(
                np.concatenate([k.words[k.word] for k in held]), np.concatenate([k.state for k in held]),
                np.concatenate([k.counts for k in held]),
            )

        for batch in batches:
            for bucket, *row in zip(*[c.to_pylist() for c in batch.columns]):
                if bucket != now:
                    if held:
                        yield table(merged().rows(buckets, kind))
                    now, held, size = bucket, [], 0
                held.append(_Kinds.read(row, kind))
                size += len(held[-1].word)
                if size > 2 * len(held[0].word) + _MAX_KINDS:
                    held = [merged()]
                    size = len(held[0].word)
        if held:
            yield table(merged().rows(buckets, kind))

    partial = df.select("text").mapInArrow(count, schema)
    return partial.repartition(buckets, "bucket").sortWithinPartitions("bucket").mapInArrow(add, schema)


def _rare_totals(counted: DataFrame, tree: Tree) -> np.ndarray:
    """Of each state, how many distinct rare words follow it, and how many rare tokens."""
    shared = counted.sparkSession.sparkContext.broadcast(tree)

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree = shared.value
        chains, sums = tree.chains(), np.zeros((2, len(tree.parents)), np.int64)
        for batch in batches:
            for row in zip(*[c.to_pylist() for c in batch.columns]):
                codes, numbers = _Kinds.read(row, tree.kind).after(chains)
                state = codes & 0xFFFFFFFF
                sums += [np.bincount(state, n, len(tree.parents)).astype(np.int64) for n in (None, numbers)]
        state = np.flatnonzero(sums[0])
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in (state, *sums[:, state])], ["state", "words", "tokens"])

    columns = counted.select("hashes", "sizes", "states", "counts")
    totals = np.zeros((2, len(tree.parents)), np.int64)
    for r in columns.mapInArrow(total, "state long, words long, tokens long").groupBy("state").agg(
        F.sum("words").alias("words"), F.sum("tokens").alias("tokens")
    ).collect():
        totals[:, r["state"]] = r["words"], r["tokens"]
    return totals


# Scores.


def _local(df: DataFrame, tree: Tree, buckets: int, id_type: T.DataType, every_word: bool) -> DataFrame:
    """What a document's portion knows by itself, and what it must ask for.

    It asks by bucket for kinds of rare tokens; documents have no bucket and name the kinds of
    their rare tokens by number.  Without ``every_word`` all kinds are of state 0.
    """
    shared = df.sparkSession.sparkContext.broadcast(tree)
    schema = T.StructType([
        T.StructField("portion", T.LongType()), T.StructField("bucket", T.IntegerType()),
        T.StructField("hashes", T.BinaryType()), T.StructField("sizes", T.BinaryType()),
        T.StructField("states", T.BinaryType()), T.StructField("doc", id_type),
        T.StructField("n_tokens", T.LongType()), T.StructField("known", T.LongType()),
        T.StructField("base", T.DoubleType()), T.StructField("model", T.DoubleType()),
        T.StructField("rare", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tree = shared.value
        root = tree.root()
        plain = np.log10(np.where(root > 0, root, 1.0))
        number = TaskContext.get().partitionId() << 24
        docs: list[pa.Array] = []
        parts: list[tuple[np.ndarray, np.ndarray]] = []
        size = 0

        def flush() -> Iterator[pa.RecordBatch]:
            tokens = np.concatenate([p[0] for p in parts])
            counts = np.concatenate([np.diff(p[1]) for p in parts])
            places = np.concatenate(([0], np.cumsum(counts)))
            symbols = tree.symbols_of(tokens)
            state = tree.states_of(symbols, places)
            rare = symbols == tree.rare
            model = tree.logs[state, symbols].astype(np.float64) - np.where(rare, plain[tree.rare], 0.0)
            base = np.where(rare, 0.0, plain[symbols])
            kinds = _Kinds.of(tokens[rare], state[rare] if every_word else 0 * state[rare])
            rows = kinds.rows(buckets, tree.kind)
            k = len(rows)
            yield pa.RecordBatch.from_arrays([
                pa.array([number] * k, pa.int64()), pa.array([r[0] for r in rows], pa.int32()),
                *[pa.array([r[c] for r in rows], pa.binary()) for c in (1, 2, 3)],
                pa.nulls(k, docs[0].type), pa.nulls(k, pa.int64()), pa.nulls(k, pa.int64()),
                pa.nulls(k, pa.float64()), pa.nulls(k, pa.float64()), pa.nulls(k, pa.binary()),
            ], [f.name for f in schema])
            begins = places[:-1]
            n_rare = np.add.reduceat(rare.astype(np.int64), begins)
            rare_places = np.concatenate(([0], np.cumsum(n_rare))).tolist()
            raw = kinds.at.astype(np.uint32).tobytes()
            names = pa.concat_arrays(docs)
            sums = [np.add.reduceat(x, begins) for x in (base, model)]
            for i in range(0, len(begins), 2048):
                to = min(i + 2048, len(begins))
                yield pa.RecordBatch.from_arrays([
                    pa.array([number] * (to - i), pa.int64()), pa.nulls(to - i, pa.int32()),
                    *[pa.nulls(to - i, pa.binary())] * 3, names.slice(i, to - i),
                    pa.array(counts[i:to], pa.int64()), pa.array((counts - n_rare)[i:to], pa.int64()),
                    pa.array(sums[0][i:to]), pa.array(sums[1][i:to]),
                    pa.array([raw[4 * a:4 * b] for a, b in zip(rare_places[i:to], rare_places[i + 1:to + 1])], pa.binary()),
                ], [f.name for f in schema])

        for batch in batches:
            for first, tokens, places in _token_arrays(batch.column(1)):
                docs.append(batch.column(0).slice(first, len(places) - 1))
                parts.append((tokens, places))
                size += len(tokens) * 8
                if size >= PORTION_BYTES:
                    yield from flush()
                    docs, parts, size = [], [], 0
                    number += 1
        if parts:
            yield from flush()

    return df.select("doc", "text").mapInArrow(run, schema)


def _answered(asked: DataFrame, counted: DataFrame, tree: Tree, totals: np.ndarray, buckets: int) -> DataFrame:
    """``portion``, ``bucket`` and of the kinds it asked for, in their order, the words' ``counts``
    and the ``logs`` of their share of the rare class in their state, as a part of all tokens.

    ``totals`` are those of :func:`_rare_totals`.  A bucket's counts come first, so that questions are answered as they stream by.
    """
    shared = asked.sparkSession.sparkContext.broadcast((tree, totals))

    def answer(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tree, (words, tokens) = shared.value
        chains, total, rare = tree.chains(), tree.total, tree.root()[tree.rare]
        nothing = _Kinds(*[np.zeros(0, np.int64)] * 4)
        now, held, plain, codes, numbers = None, nothing, None, None, None
        for batch in batches:
            for bucket, portion, *row in zip(*[c.to_pylist() for c in batch.columns]):
                wanted = _Kinds.read(row, tree.kind)
                if portion is None or bucket != now:
                    now, held = bucket, wanted if portion is None else nothing
                    # The last one is of words that are not there.
                    plain = np.bincount(held.word, held.counts, len(held.words) + 1).astype(np.int64)
                    codes, numbers = held.after(chains)
                    numbers = np.append(numbers, 0)
                if portion is None:
                    continue
                at = _found(held.words, wanted.words)[wanted.word]
                count = plain[at]
                share = (count + ADDED) / total
                for states in chains[wanted.state].T:
                    # A code of no word is negative and not found.
                    n = numbers[_found(codes, at << 32 | states)]
                    mixed = n * rare + words[states] * share
                    # A state that no rare word follows in training has the share of its parent.
                    weight = np.where(states > 0, words[states] + tokens[states], 0)
                    share = np.where(weight > 0, mixed / np.maximum(weight, 1), share)
                yield pa.RecordBatch.from_arrays([
                    pa.array([portion], pa.int64()), pa.array([bucket], pa.int32()),
                    pa.array([count.tobytes()], pa.binary()),
                    pa.array([np.log10(share).astype(np.float32).tobytes()], pa.binary()),
                ], ["portion", "bucket", "counts", "logs"])

    columns = ["bucket", "portion", "hashes", "sizes", "states", "counts"]
    known = counted.withColumn("portion", F.lit(None).cast("long")).select(columns)
    questions = asked.withColumn("counts", F.lit(None).cast("binary")).select(columns)
    return (
        known.unionByName(questions).repartition(buckets, "bucket").sortWithinPartitions("bucket", "portion")
        .mapInArrow(answer, "portion long, bucket int, counts binary, logs binary")
    )


def _finished(documents: DataFrame, answers: DataFrame, total: float, tasks: int) -> DataFrame:
    """The documents with the rare words' part added, portion by portion."""
    schema = T.StructType([
        documents.schema["doc"], T.StructField("n_tokens", T.LongType()), T.StructField("n_known", T.LongType()),
        T.StructField("base_score", T.DoubleType()), T.StructField("score", T.DoubleType()),
    ])

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, parts, known, plain, logs = None, [], None, None, None
        for batch in batches:
            rows = zip(*[batch.column(i).to_pylist() for i in range(4)], batch.column(8).to_pylist())
            out = []
            for k, (portion, bucket, counts, shares, rare) in enumerate(rows):
                if portion != now:
                    now, parts, known = portion, [], None
                if bucket is not None:
                    parts.append((np.frombuffer(counts, np.int64), np.frombuffer(shares, np.float32)))
                    continue
                if known is None:
                    numbers, logs = (
                        np.concatenate([np.zeros(0, kind)] + [p[i] for p in parts])
                        for i, kind in enumerate((np.int64, np.float32))
                    )
                    known, plain, logs = numbers > 0, np.log10((numbers + ADDED) / total), logs.astype(np.float64)
                at = np.frombuffer(rare, np.uint32)
                out.append((k, int(known[at].sum()), float(plain[at].sum()), float(logs[at].sum())))
            if not out:
                continue
            chosen = pa.array([o[0] for o in out])
            doc, n_tokens, base, model, _, known_here = (
                batch.column(i).take(chosen) for i in range(4, 10)
            )
            plain_here, logs_here = (np.array([o[i] for o in out]) for i in (2, 3))
            yield pa.RecordBatch.from_arrays([
                doc, n_tokens, pa.array(known_here.to_numpy() + np.array([o[1] for o in out])),
                pa.array(base.to_numpy() + plain_here), pa.array(model.to_numpy() + logs_here),
            ], [f.name for f in schema])

    empty = documents.select(
        "portion", F.lit(None).cast("int").alias("bucket"), F.lit(None).cast("binary").alias("counts"),
        F.lit(None).cast("binary").alias("logs"), "doc", "n_tokens", "base", "model", "rare", "known",
    )
    told = answers.select("portion", "bucket", "counts", "logs").select(
        "*", *[F.lit(None).cast(empty.schema[c].dataType).alias(c) for c in empty.columns[4:]]
    )
    return (
        told.unionByName(empty).repartition(tasks, "portion")
        .sortWithinPartitions("portion", F.asc_nulls_last("bucket"))
        .mapInArrow(finish, schema)
    )


def train(
    df: DataFrame, buckets: int, depth: int = DEPTH, min_share: float = MIN_SHARE, every_word: bool = False
) -> tuple[Tree, DataFrame]:
    """The tree and the word counts of column ``text``.

    With ``every_word`` the alphabet leaves out no word that a context can have.
    """
    counted = written(_word_counts(df, buckets), "lm_counts")
    sizes = counted.agg(F.sum("tokens"), F.sum("words")).first()
    # No more words than that can have the share of tokens that a context needs.
    symbols = max(ALPHABET, int(1 / min_share)) if every_word else ALPHABET
    top = sorted((h % (1 << 64), c) for h, c in _most_frequent(counted, symbols))
    tree = Tree(
        np.array([h for h, _ in top], np.uint64), np.array([c for _, c in top], np.int64),
        sizes[0] or 0, sizes[1] or 0,
    )
    _grow(df, tree, depth, min_share)
    return tree, counted


def score(
    df: DataFrame, id_col: str = "doc_id", text_col: str = "text", depth: int = DEPTH, min_share: float = MIN_SHARE,
    every_word: bool = False,
) -> DataFrame:
    """One row per row: log10 probabilities of its text, by word counts and by the tree.

    Words are lower-cased in A-Z, and one end follows them; a null text is empty, so only
    its end is scored.  Rows whose id's crc32 is no multiple of 10 are learnt from.
    Columns: the id, ``held_out``, ``n_tokens``, ``n_known`` (tokens found in training),
    ``train_tokens``, ``base_score``, ``score``.  Without any training row, every token has
    probability 1.  Rows of one id are scored each.

    With ``every_word`` the words that are no symbols are counted after each retained context
    too, one by one; without, they share the probability of their class by plain counts.
    """
    spark: SparkSession = df.sparkSession
    ship_code(spark)
    docs = df.select(F.col(id_col).alias("doc"), text_of(text_col).alias("text"))
    buckets = max(64, 2 * shuffle_partitions(spark))
    training = docs.filter(in_training("doc"))
    tree, counted = train(training, buckets, depth, min_share, every_word)
    totals = np.zeros((2, len(tree.parents)), np.int64)
    if every_word:
        buckets = max(buckets, tree.tokens // _BUCKET_TOKENS)
        counted = written(_kind_counts(training, tree, buckets), "lm_kinds")
        totals = _rare_totals(counted, tree)
    else:
        counted = counted.withColumns({c: F.lit(None).cast("binary") for c in ("sizes", "states")})
    local = written(_local(docs, tree, buckets, docs.schema["doc"].dataType, every_word), "lm_portions")
    answers = _answered(local.filter("bucket IS NOT NULL"), counted, tree, totals, buckets)
    scored = _finished(local.filter("bucket IS NULL"), answers, tree.total, buckets)
    return scored.select(
        F.col("doc").alias(id_col), (~in_training("doc")).alias("held_out"), "n_tokens", "n_known",
        F.lit(tree.tokens).cast("bigint").alias("train_tokens"), "base_score", "score",
    )
