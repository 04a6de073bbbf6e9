"""Phrase collocations, counted level by level with broadcast double-array tries.

Words are hashed with their language to 64 bits; a second hash tells whether two words of
one language share the first, in which case all is done again with other hashes.  A pass
over the texts at level ``k`` broadcasts a trie of the candidates of ``k`` words.  Tasks move
the states of all text positions through it together, add up the accepting ones, and
propose the candidates of the next level: windows whose first and last ``k`` words are both
candidates.  Spark sums what the tasks found.  Only windows proposed often enough go on, so
every phrase that is frequent is a candidate, and no more than the text holds is listed.

A trie has at most ``MAX_SEQUENCES`` phrases.  More candidates than that are dealt to several
tries, each with a pass of its own, and a window is then proposed by its first words alone.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Callable, Iterator
from functools import lru_cache, reduce

import numpy as np
import pyarrow as pa
from pyspark.errors import PySparkException
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from dockhand.llm.common import ship_code, text_of, written
from dockhand.llm.doublearray import DoubleArrayTrie
from dockhand.llm.wordhash import mix, portions

# Bytes that part words, bytes that part pieces too, the language of null.
BLANKS = b" \t"
BREAKS = b".,;:!?\n\x0b\x0c\r"
UNKNOWN = "und"

# A trie of so many phrases takes below 100 MB with its words.
MAX_SEQUENCES = 1 << 20
# Tasks add up what they found when it has so many rows, and hand it on when that leaves half.
FLUSH_ROWS = 1 << 19
# Texts go in parts of about so many bytes, those of more are cut between pieces.
PART_BYTES = 1 << 19
# Words whose text a task has handed on; one that another pushes out is handed on again.
KNOWN = 1 << 20
# A language's phrases are ranked in so many parts first.
PARTS = 64

_lower = np.arange(256, dtype=np.uint8)
_lower[ord("A"):ord("Z") + 1] += 32
_blank, _break = np.zeros(256, bool), np.zeros(256, bool)
_break[list(BREAKS)] = True
_blank[list(BLANKS + BREAKS)] = True
_FACTORS = (0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F)  # odd, so they have inverses


@lru_cache(maxsize=8)
def _byte_values(which: int, seed: int) -> np.ndarray:
    return np.random.default_rng((20250611, which, seed)).integers(1, 1 << 64, 256, np.uint64)


_grown: dict[int, np.ndarray] = {}


def _powers(which: int, n: int) -> np.ndarray:
    """At least ``n`` powers of a factor and of its inverse, kept for the next texts."""
    if which not in _grown or _grown[which].shape[1] < n:
        factor = _FACTORS[which]
        # Said to be unsigned before anything is made of them: a mix of sizes would be floats.
        pair = np.array([[factor], [pow(factor, -1, 1 << 64)]], np.uint64)
        powers = np.repeat(pair, max(n, PART_BYTES), axis=1)
        powers[:, 0] = 1
        _grown[which] = np.multiply.accumulate(powers, axis=1)
    return _grown[which]


class _Words:
    """All words of some texts: two hashes, where they lie, and whether the next one follows."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, salts: np.ndarray, seed: int, twice: bool) -> None:
        self.data = _lower[data]
        inside = np.zeros(len(data) + 2, bool)
        inside[1:-1] = ~_blank[data]
        begins = inside[1:-1] & ~inside[:-2]
        ends = inside[1:-1] & ~inside[2:]
        full = offsets[:-1] < offsets[1:]
        edges, lasts = offsets[:-1][full], offsets[1:][full] - 1
        begins[edges] = inside[1:-1][edges]
        ends[lasts] = inside[1:-1][lasts]
        self.start, self.end = np.flatnonzero(begins), np.flatnonzero(ends) + 1
        self.text = np.searchsorted(offsets, self.start, "right") - 1
        breaks = np.zeros(len(data) + 1, np.int64)
        np.cumsum(_break[data], out=breaks[1:])
        self.joined = np.zeros(len(self.start), bool)
        self.joined[:-1] = (breaks[self.start[1:]] == breaks[self.end[:-1]]) & (
            self.text[1:] == self.text[:-1]
        )
        self.key = self._hashed(0, salts, seed)
        self.again = self._hashed(1, salts, seed) if twice else None

    def _hashed(self, which: int, salts: np.ndarray, seed: int) -> np.ndarray:
        n = len(self.data) + 1
        up, down = _powers(which, n)
        sums = np.zeros(n, np.uint64)
        np.cumsum(_byte_values(which, seed)[self.data] * up[:n - 1], out=sums[1:])
        plain = (sums[self.end] - sums[self.start]) * down[self.start]
        return mix(mix(plain + (self.end - self.start).astype(np.uint64)) ^ salts[self.text])

    def word(self, i: int) -> bytes:
        return self.data[self.start[i]:self.end[i]].tobytes()


def _salt(lang: str, seed: int) -> int:
    return int.from_bytes(hashlib.blake2b(f"{seed}:{lang}".encode(), digest_size=8).digest(), "big")


def _cut(data: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """More offsets, so that texts above ``PART_BYTES`` end between pieces now and then."""
    more = []
    for i in np.flatnonzero(np.diff(offsets) > PART_BYTES).tolist():
        at = offsets[i] + PART_BYTES
        while at < offsets[i + 1]:
            found = np.flatnonzero(_break[data[at:at + PART_BYTES]])
            if len(found):
                more.append(at + found[0] + 1)
                at = more[-1] + PART_BYTES
            else:
                at += PART_BYTES
    return np.sort(np.concatenate((offsets, np.array(more, np.int64))))


def _portions(batch: pa.RecordBatch, seed: int, twice: bool) -> Iterator[tuple[_Words, pa.Array]]:
    """The words of a batch of ``lang`` and ``text``, with the language of each text."""
    lang, text = batch.column("lang"), batch.column("text")
    for first, data, offsets in portions(text):
        cuts = _cut(data, offsets)
        source = first + np.clip(np.searchsorted(offsets, cuts[:-1], "right") - 1, 0, len(offsets) - 2)
        coded = lang.take(pa.array(source)).dictionary_encode()
        salts = np.array([_salt(x, seed) for x in coded.dictionary.to_pylist()], np.uint64)
        codes, i = coded.indices.to_numpy(zero_copy_only=False), 0
        while i < len(cuts) - 1:
            j = max(i + 1, int(np.searchsorted(cuts, cuts[i] + PART_BYTES, "right")) - 1)
            words = _Words(
                data[cuts[i]:cuts[j]], cuts[i:j + 1] - cuts[i], salts[codes[i:j]], seed, twice
            )
            if len(words.start):
                yield words, coded.slice(i, j - i)
            i = j


def _distinct(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct pairs: an order of all, where each pair begins in it, and its number."""
    both = mix(a ^ mix(b))
    order = np.argsort(both)
    for again in (False, True):
        x, y = a[order], b[order]
        new = np.ones(len(order), bool)
        new[1:] = (x[1:] != x[:-1]) | (y[1:] != y[:-1])
        if again or not (new[1:] & (both[order][1:] == both[order][:-1])).any():
            break
        order = np.lexsort((b, a))
    first = np.flatnonzero(new)
    return order, first, np.diff(np.append(first, len(order)))


class _Sums:
    """Numbers of pairs, added up now and then."""

    def __init__(self) -> None:
        self.parts: list[tuple[np.ndarray, ...]] = []
        self.rows = 0

    def add(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """Count pairs; returns where the first of each kind stands."""
        order, first, n = _distinct(a, b)
        one = order[first]
        self.parts.append((a[one], b[one], n))
        self.rows += len(one)
        return one

    def _merge(self) -> None:
        a, b, n = (np.concatenate(c) for c in zip(*self.parts))
        order, first, _ = _distinct(a, b)
        one = order[first]
        self.parts = [(a[one], b[one], np.add.reduceat(n[order], first))]
        self.rows = len(one)

    def take(self, last: bool = False) -> tuple[np.ndarray, ...] | None:
        """The sums, if there are many or these are the last ones."""
        if not self.rows or not last and self.rows < FLUSH_ROWS:
            return None
        self._merge()
        if not last and self.rows < FLUSH_ROWS // 2:
            return None
        found, self.parts, self.rows = self.parts[0], [], 0
        return found


def _batch(names: list[str], types: list[pa.DataType], rows: int, **columns) -> pa.RecordBatch:
    """A batch in which columns that are not given are null."""
    return pa.RecordBatch.from_arrays(
        [pa.array(columns[n], t) if n in columns else pa.nulls(rows, t) for n, t in zip(names, types)],
        names=names,
    )


_SHARD = (
    ["lang", "word", "key", "again", "n"],
    [pa.string(), pa.string(), pa.int64(), pa.int64(), pa.int64()],
)


def _count_words(seed: int) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Three kinds of rows: a word's hashes and number, its text, a language's number of words."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, totals, known = _Sums(), Counter(), np.zeros(KNOWN, np.uint64)

        def counted(last: bool) -> Iterator[pa.RecordBatch]:
            found = sums.take(last)
            if found:
                key, again, n = found
                yield _batch(*_SHARD, len(n), key=key.view(np.int64), again=again.view(np.int64), n=n)

        for batch in batches:
            for words, lang in _portions(batch, seed, twice=True):
                of_text = np.bincount(words.text, minlength=len(lang))
                for name, n in zip(lang.cast(pa.string()).to_pylist(), of_text.tolist()):
                    totals[name] += n
                one = sums.add(words.key, words.again)
                slot = (words.key[one] & np.uint64(KNOWN - 1)).astype(np.int64)
                new = known[slot] != words.key[one]
                one, slot = one[new], slot[new]
                known[slot] = words.key[one]
                yield _batch(
                    *_SHARD, len(one), lang=lang.take(pa.array(words.text[one])).cast(pa.string()),
                    word=pa.array([words.word(i) for i in one.tolist()], pa.binary()).cast(pa.string()),
                    key=words.key[one].view(np.int64),
                )
                yield from counted(last=False)
        yield from counted(last=True)
        yield _batch(*_SHARD, len(totals), lang=list(totals), n=list(totals.values()))

    return run


_FOUND = (["id", "next", "n"], [pa.int64()] * 3)


def _walk(
    trie, ids, seed: int, single: bool, count: bool, propose: bool
) -> Callable[[Iterator[pa.RecordBatch]], Iterator[pa.RecordBatch]]:
    """Tasks that give each candidate's number, and the windows of one word more with theirs."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sequences: DoubleArrayTrie = trie.value
        own, width = ids.value, sequences.width
        accepted = np.zeros(sequences.size, np.int64)
        windows = _Sums()

        def proposed(last: bool) -> Iterator[pa.RecordBatch]:
            found = windows.take(last)
            if found:
                end, after, n = found
                yield _batch(*_FOUND, len(n), id=own[end.astype(np.int64)], next=after.view(np.int64), n=n)

        for batch in batches:
            for words, _ in _portions(batch, seed, twice=False):
                places, ends = sequences.ending(sequences.symbols(words.key), words.joined)
                if count:
                    accepted += np.bincount(ends, minlength=sequences.size)
                if not propose:
                    continue
                wider = words.joined[places + width - 1]
                if single:
                    is_start = np.zeros(len(words.start) + 1, bool)
                    is_start[places] = True
                    wider &= is_start[places + 1]
                places, ends = places[wider], ends[wider].astype(np.uint64)
                if len(places):
                    windows.add(ends, words.key[places + width])
                    yield from proposed(last=False)
        yield from proposed(last=True)
        seen = np.flatnonzero(accepted)
        yield _batch(*_FOUND, len(seen), id=own[seen], n=accepted[seen])

    return run


def _frequent_words(texts: DataFrame, min_count: int, seed: int) -> tuple[DataFrame, DataFrame] | None:
    """Frequent words and each language's number of words; nothing when two words collide."""
    shards = written(
        texts.mapInArrow(_count_words(seed), "lang string, word string, key long, again long, n long"),
        "phrase_words",
    )
    keys = written(
        shards.filter("again IS NOT NULL").groupBy("key").agg(
            F.sum("n").alias("n"), (F.min("again") != F.max("again")).alias("collide")
        ).filter(F.col("n") >= min_count),
        "phrase_frequent_words",
    )
    if keys.filter("collide").take(1):
        return None
    totals = shards.filter("key IS NULL").groupBy("lang").agg(F.sum("n").alias("n_words"))
    # Each task has given its words' texts, so they become one row a word before the join.
    texts_of = shards.filter("word IS NOT NULL").groupBy("key").agg(
        F.max(F.struct("lang", "word")).alias("text")
    )
    words = texts_of.join(keys, "key").select(
        F.monotonically_increasing_id().alias("id"), "text.lang", F.col("text.word").alias("phrase"),
        F.array("key").alias("words"), "n",
    )
    return written(words, "phrase_level"), written(totals, "phrase_totals")


def _level(
    texts: DataFrame, candidates: DataFrame, width: int, seed: int, min_count: int, count: bool,
    propose: bool, max_sequences: int,
) -> DataFrame | None:
    """What is frequent among the candidates of a width and the windows of one word more.

    One pass for each trie.  ``next`` is null for the candidates themselves.
    """
    context, found = texts.sparkSession.sparkContext, []
    shards = -(-candidates.count() // max_sequences)
    for shard in range(shards):
        own = candidates.filter(F.pmod(F.xxhash64("id"), F.lit(shards)) == shard)
        own = own.select("id", "words").toArrow()
        if not own.num_rows:
            continue
        words = own.column("words").combine_chunks().flatten().to_numpy().view(np.uint64)
        trie = context.broadcast(DoubleArrayTrie(words.reshape(own.num_rows, width)))
        ids = context.broadcast(own.column("id").to_numpy())
        walk = _walk(trie, ids, seed, shards == 1, count, propose)
        sums = texts.mapInArrow(walk, "id long, next long, n long").groupBy("id", "next").agg(
            F.sum("n").alias("n")
        )
        found.append(written(sums.filter(F.col("n") >= min_count), "phrase_pass"))
        trie.unpersist()
        ids.unpersist()
    return reduce(DataFrame.unionByName, found) if found else None


def frequent_phrases(
    df: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    max_words: int = 5,
    min_count: int = 100,
    max_sequences: int = MAX_SEQUENCES,
) -> tuple[DataFrame, DataFrame]:
    """All phrases found at least ``min_count`` times, and each language's number of words.

    A text is lower-cased (A-Z) and split into pieces at ``. , ; : ! ?`` and line breaks, a
    piece into words at spaces and tabs; a phrase is up to ``max_words`` words that follow each
    other in a piece, and overlapping occurrences count.  A null text is empty, a null
    language is ``und``; other columns are not looked at, so ids may repeat or be missing.
    An empty table has no phrases.  Columns: ``lang``, ``phrase`` (joined by spaces),
    ``size`` and ``n``; and ``lang``, ``n_words``.
    """
    spark = df.sparkSession
    ship_code(spark)
    texts = df.select(
        F.coalesce(F.col(lang_col).cast("string"), F.lit(UNKNOWN)).alias("lang"),
        text_of(text_col).alias("text"),
    )
    for seed in range(64):
        found = _frequent_words(texts, min_count, seed)
        if found:
            break
    else:
        raise PySparkException("no hash tells the frequent words apart")
    words, totals = found
    level, levels = words, [words.withColumn("size", F.lit(1))]
    for width in range(1, max_words + 1):
        passed = _level(
            texts, level, width, seed, min_count, count=width > 1, propose=width < max_words,
            max_sequences=max_sequences,
        )
        if passed is None:
            break
        if width > 1:
            counts = passed.filter("next IS NULL").select("id", "n")
            level = written(level.join(counts, "id"), "phrase_counts")
            levels.append(level.withColumn("size", F.lit(width)))
        if width < max_words:
            wider = passed.filter("next IS NOT NULL").select("id", "next")
            last = words.select(F.col("words")[0].alias("next"), F.col("phrase").alias("last"))
            level = written(
                wider.join(level, "id").join(last, "next").select(
                    F.monotonically_increasing_id().alias("id"), "lang",
                    F.concat_ws(" ", "phrase", "last").alias("phrase"),
                    F.concat("words", F.array("next")).alias("words"),
                ),
                "phrase_level",
            )
    phrases = reduce(DataFrame.unionByName, [x.select("lang", "phrase", "size", "n") for x in levels])
    return phrases, totals


def _parts(first: str, last: str) -> Column:
    """Words ``first`` to ``last`` (SQL, from 1, both included) of ``parts`` as a phrase."""
    return F.expr(f"array_join(slice(parts, {first}, {last} - {first} + 1), ' ')")


def collocations(
    df: DataFrame,
    lang_col: str = "lang",
    text_col: str = "text",
    max_words: int = 5,
    min_count: int = 100,
    absorb_percent: int = 100,
    limit: int = 2000,
    max_sequences: int = MAX_SEQUENCES,
) -> DataFrame:
    """The phrases of two words or more whose parts belong together most, per language.

    Of a phrase found ``a`` times, each cut into a part found ``l`` and one found ``r`` times
    scores ``floor(1000 * a * n / (l * r))``, ``n`` being the language's words; the lowest score
    counts, of equal ones that of the shortest first part.  A phrase whose words lie
    together in a longer one goes if that is found at least ``absorb_percent`` times as often.
    The ``limit`` best by score, count and phrase (by UTF-8 bytes) are ranked from 1.  All is
    integer arithmetic of 38 digits.  See :func:`frequent_phrases` for words and odd rows.
    Columns: ``lang``, ``rank``, ``phrase``, ``a``, ``l``, ``r``, ``n``, ``score``.
    """
    phrases, totals = frequent_phrases(df, lang_col, text_col, max_words, min_count, max_sequences)
    phrases = written(phrases, "phrases")
    whole = phrases.filter("size > 1").withColumn("parts", F.split("phrase", " "))
    cuts = whole.withColumn("cut", F.explode(F.expr("sequence(1, size - 1)"))).select(
        "lang", "phrase", F.col("n").alias("a"), "cut",
        _parts("1", "cut").alias("left_part"), _parts("cut + 1", "size").alias("right_part"),
    )

    def part(name: str, number: str) -> DataFrame:
        return phrases.select("lang", F.col("phrase").alias(name), F.col("n").alias(number))

    scored = (
        cuts.join(part("left_part", "l"), ["lang", "left_part"])
        .join(part("right_part", "r"), ["lang", "right_part"])
        .join(F.broadcast(totals.withColumnRenamed("n_words", "n")), "lang")
        .withColumn("score", F.expr(
            "cast(cast(a AS decimal(19)) * cast(n AS decimal(19)) AS decimal(38)) * 1000"
            " div (cast(l AS decimal(19)) * cast(r AS decimal(19)))"
        ))
        .groupBy("lang", "phrase", "a", "n")
        .agg(F.min(F.struct("score", "cut", "l", "r")).alias("lowest"))
    )
    inner = whole.withColumn("width", F.explode(F.expr("sequence(2, size)"))).filter("width < size")
    inner = inner.withColumn("at", F.explode(F.expr("sequence(1, size - width + 1)"))).select(
        "lang", _parts("at", "at + width - 1").alias("phrase"), "n"
    ).groupBy("lang", "phrase").agg(F.max("n").alias("longer"))
    absorbed = F.coalesce(F.col("longer") * 100 >= F.col("a") * absorb_percent, F.lit(False))
    left = scored.join(inner, ["lang", "phrase"], "left").filter(~absorbed).select(
        "lang", "phrase", "a", "lowest.l", "lowest.r", "n", "lowest.score"
    )
    best = [F.desc("score"), F.desc("a"), F.asc("phrase")]
    deal = F.pmod(F.xxhash64("phrase"), F.lit(PARTS))
    in_part = F.row_number().over(Window.partitionBy("lang", deal).orderBy(*best))
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(*best))
    ranked = left.withColumn("rank", in_part).filter(F.col("rank") <= limit)
    return ranked.withColumn("rank", rank.cast("bigint")).filter(F.col("rank") <= limit).select(
        "lang", "rank", "phrase", "a", "l", "r", "n", "score"
    )
