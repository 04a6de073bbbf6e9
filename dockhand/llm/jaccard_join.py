"""Jaccard self-join of word n-gram sets by prefix trees.

Grams are ordered globally, rare ones first.  Two similar sets must share a gram among
their first few in that order, so sets meet where they share such a gram.  There they are
stored in a trie; a set walks it once, the overlap with a shared beginning is counted once
for all sets below, and a subtree is left when what remains of both cannot reach the
overlap that is needed.

Where a set meets others:

1. Rows with the same set become one before anything else.
2. Two similar sets have their first ``k`` common grams among the first grams of both, ``k``
   more than one of them can miss.  A set of whose first grams fewer than ``k`` occur in
   other sets has no partner and goes no further.
3. Each set goes once, whole, to one home: the shared gram that most sets have.  Homes are
   split into blocks of bounded size; the classes found in blocks of one home meet again
   through one member each.
4. What is left are grams whose sets still lie in different classes and never met.  There
   their signatures meet first, a bit or two for each gram, in pairs of blocks where they are
   many.  Only sets with a partner that the signatures do not rule out meet once more, whole.

Classes only spare comparisons inside a class, so no link between classes is lost.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from itertools import groupby

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from dockhand.llm.common import BROADCAST_BYTES, join_few, ship_code, stored_bytes, text_of, written
from dockhand.llm.components import connected_components
from dockhand.llm.exact_dedup import BUCKET_BITS, _is_set
from dockhand.llm.wordhash import mix, portions, shingle_sets

# Grams are counted in so many buckets, to order them; 2 MB as logarithms, broadcast.
COUNT_BITS = 21
_CHUNK_BITS = 15
# A block holds at most so many grams (but always one set), and so many sets.
BLOCK_GRAMS = 2_000_000
BLOCK_SETS = 2048
# Bits of the filter that keeps texts without a possible partner out of the shuffle; 2 MB.
FILTER_BITS = 1 << 24


def _digest(grams: np.ndarray) -> tuple[int, int]:
    """128 bits that stand for a set, whatever its order."""
    return (
        int(mix(grams).sum(dtype=np.uint64).astype(np.int64)),
        int(mix(grams ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64).astype(np.int64)),
    )


def _ordered(grams: np.ndarray, ranks: np.ndarray) -> np.ndarray:
    """A set as sorted keys of the global order: rank of the gram's count, then its hash."""
    bucket = (grams & np.uint64((1 << COUNT_BITS) - 1)).astype(np.int64)
    keys = (ranks[bucket].astype(np.uint64) << np.uint64(59)) | (grams >> np.uint64(5))
    keys.sort()
    return keys


def _signature(grams: np.ndarray) -> bytes:
    """Bits of a set, as many as the power of two from its size on, 64 at least.

    Each gram turns one bit over, so two signatures of a width differ in no more bits than
    the sets do in grams.  Halves laid over each other are the signature of half the width.
    """
    bits = 1 << max(6, (len(grams) - 1).bit_length())
    seen = np.bincount((grams & np.uint64(bits - 1)).astype(np.int64), minlength=bits)
    return np.packbits((seen & 1).astype(np.uint8), bitorder="little").tobytes()


def _misses(size: int, percent: int) -> int:
    """How many of its grams a set can have that a set similar to it has not."""
    return size - -(-percent * size // 100)


def _needed_shared(size: int, misses: int) -> int:
    """Grams a set must share among its first ``misses`` and so many more."""
    return min(1 + misses // 3, size - misses)


def _needed_sql(size: str, percent: int) -> str:
    """:func:`_needed_shared` of a column."""
    misses = f"({size} - ({percent} * {size} + 99) div 100)"
    return f"least(1 + {misses} div 3, {size} - {misses})"


def _sketches(df: DataFrame, width: int) -> DataFrame:
    """Size and digest of every row's set, and counts of all grams in chunks of buckets."""
    schema = T.StructType([
        T.StructField("doc", df.schema["doc"].dataType), T.StructField("n", T.LongType()),
        T.StructField("d1", T.LongType()), T.StructField("d2", T.LongType()),
        T.StructField("chunk", T.IntegerType()), T.StructField("counts", T.BinaryType()),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts = np.zeros(1 << COUNT_BITS, np.uint32)
        kind = None
        for batch in batches:
            kind = batch.schema.field(0).type
            for first, data, offsets in portions(batch.column(1)):
                sets = list(shingle_sets(data, offsets, width))
                seen = np.concatenate(sets) & np.uint64(len(counts) - 1)
                counts += np.bincount(seen.astype(np.int64), minlength=len(counts)).astype(np.uint32)
                digests = [_digest(s) for s in sets]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, len(sets)),
                    pa.array([len(s) for s in sets], pa.int64()),
                    pa.array([d[0] for d in digests], pa.int64()),
                    pa.array([d[1] for d in digests], pa.int64()),
                    pa.nulls(len(sets), pa.int32()), pa.nulls(len(sets), pa.binary()),
                ], [f.name for f in schema])
        for chunk, part in enumerate(counts.reshape(-1, 1 << _CHUNK_BITS)):
            if part.any():
                yield pa.RecordBatch.from_arrays([
                    pa.nulls(1, kind), *[pa.nulls(1, pa.int64())] * 3,
                    pa.array([chunk], pa.int32()), pa.array([part.tobytes()], pa.binary()),
                ], [f.name for f in schema])

    return df.mapInArrow(run, schema)


def _count_ranks(sketches: DataFrame) -> np.ndarray:
    """The logarithm of each bucket's count, at most 31; of fixed size."""

    def add(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            for chunk, counts in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist()):
                part = np.frombuffer(counts, np.uint32).astype(np.int64)
                sums[chunk] = sums[chunk] + part if chunk in sums else part
        for chunk, part in sums.items():
            ranks = np.minimum(np.log2(np.maximum(part, 1)), 31).astype(np.uint8)
            yield pa.RecordBatch.from_arrays(
                [pa.array([chunk], pa.int32()), pa.array([ranks.tobytes()], pa.binary())],
                ["chunk", "ranks"],
            )

    chunks = sketches.filter("chunk IS NOT NULL").select("chunk", "counts")
    ranks = np.zeros(1 << COUNT_BITS, np.uint8)
    for row in chunks.repartition("chunk").mapInArrow(add, "chunk int, ranks binary").collect():
        start = row["chunk"] << _CHUNK_BITS
        ranks[start:start + (1 << _CHUNK_BITS)] = np.frombuffer(row["ranks"], np.uint8)
    return ranks


def _prefixes(df: DataFrame, width: int, percent: int, ranks) -> DataFrame:
    """The first grams of every row's set, in the global order."""
    schema = T.StructType([
        T.StructField("doc", df.schema["doc"].dataType),
        T.StructField("d1", T.LongType()), T.StructField("d2", T.LongType()),
        T.StructField("prefix", T.ArrayType(T.LongType())),
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = ranks.value
        for batch in batches:
            for first, data, offsets in portions(batch.column(1)):
                sets = list(shingle_sets(data, offsets, width))
                misses = [_misses(len(s), percent) for s in sets]
                keys = [
                    _ordered(s, order)[: m + _needed_shared(len(s), m)].view(np.int64)
                    for s, m in zip(sets, misses)
                ]
                places = np.concatenate(([0], np.cumsum([len(k) for k in keys])))
                digests = [_digest(s) for s in sets]
                yield pa.RecordBatch.from_arrays([
                    batch.column(0).slice(first, len(sets)),
                    pa.array([d[0] for d in digests], pa.int64()),
                    pa.array([d[1] for d in digests], pa.int64()),
                    pa.ListArray.from_arrays(
                        pa.array(places, pa.int32()), pa.array(np.concatenate(keys), pa.int64())
                    ),
                ], [f.name for f in schema])

    return df.mapInArrow(run, schema)


def _whole_sets(df: DataFrame, width: int, ranks) -> DataFrame:
    """The ordered sets of rows whose digest is ``d1``, ``d2``, for their ``text``."""
    kept = df.drop("text", "d1", "d2")
    schema = T.StructType([
        *kept.schema, T.StructField("grams", T.BinaryType()), T.StructField("signature", T.BinaryType())
    ])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        order = ranks.value
        for batch in batches:
            d1, d2 = batch.column(1).to_pylist(), batch.column(2).to_pylist()
            for first, data, offsets in portions(batch.column(0)):
                rows, grams, signatures = [], [], []
                for i, s in enumerate(shingle_sets(data, offsets, width), first):
                    if _digest(s) == (d1[i], d2[i]):
                        keys = _ordered(s, order)
                        rows.append(i)
                        grams.append(keys.tobytes())
                        signatures.append(_signature(keys))
                chosen = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays(
                    [*[batch.column(i).take(chosen) for i in range(3, batch.num_columns)],
                     pa.array(grams, pa.binary()), pa.array(signatures, pa.binary())],
                    [f.name for f in schema],
                )

    return df.select("text", "d1", "d2", *kept.columns).mapInArrow(run, schema)


class _Node:
    """A stretch of grams that all sets below begin with, after those of the nodes above."""

    __slots__ = ("grams", "children", "least", "most", "ends", "one")

    def __init__(self, grams: np.ndarray, size: int, member: int) -> None:
        self.grams = grams
        self.children: dict[int, _Node] = {}
        self.least = self.most = size
        self.ends: list[int] = []  # members whose set ends here
        self.one: int | None = member  # any member, while all below are of one class


class Trie:
    """Ordered sets of one block, joined as they are added, the smallest first."""

    def __init__(self, percent: int, skip: Callable[[int, int], bool] | None = None) -> None:
        self._percent = percent
        self._skip = skip
        self._root: dict[int, _Node] = {}
        self._sets: list[np.ndarray] = []
        self._parents: list[int] = []
        self._last: int | None = None
        self.links: list[tuple[int, int]] = []

    def find(self, x: int) -> int:
        parents = self._parents
        while parents[x] != x:
            parents[x] = parents[parents[x]]
            x = parents[x]
        return x

    def _union(self, a: int, b: int) -> None:
        a, b = self.find(a), self.find(b)
        self._parents[max(a, b)] = min(a, b)

    def _needed(self, a: int, b: int) -> int:
        """Overlap that sets of these sizes must have."""
        return -(-self._percent * (a + b) // (100 + self._percent))

    def add(self, grams: np.ndarray, same_as: int | None = None) -> int:
        """Link a set, no smaller than those before, to all it is similar to, and store it.

        ``same_as`` is an earlier member known to be of the same class.
        """
        me = len(self._sets)
        self._parents.append(me)
        if same_as is not None:
            self._union(me, same_as)
        if self._last is not None and not (self._skip and self._skip(me, self._last)):
            # The set met last is a likely partner, and then spares its whole class.
            other = self._sets[self._last]
            overlap = np.intersect1d(grams, other, assume_unique=True).size
            if overlap >= self._needed(len(grams), len(other)):
                self._link(me, self._last)
        self._walk(me, grams)
        self._sets.append(grams)
        self._insert(me, grams)
        if self._last is None:
            self._last = me
        return me

    def _link(self, me: int, other: int) -> None:
        self._union(me, other)
        self.links.append((me, other))
        self._last = other

    def _walk(self, me: int, grams: np.ndarray) -> None:
        size = len(grams)
        shortest = -(-self._percent * size // 100)
        # Node, overlap so far, grams of the path so far, own grams passed.
        stack = [(node, 0, 0, 0) for node in self._root.values()]
        while stack:
            node, overlap, depth, passed = stack.pop()
            if node.most < shortest or (node.one is not None and self.find(node.one) == self.find(me)):
                continue
            needed = self._needed(size, max(node.least, shortest))
            start, step, alive = 0, 64, True
            while start < len(node.grams):
                part = node.grams[start:start + step]
                places = np.searchsorted(grams, part)
                inside = places < size
                overlap += int(np.count_nonzero(grams[places[inside]] == part[inside]))
                depth += len(part)
                passed = int(np.searchsorted(grams, part[-1], "right"))
                if overlap + min(size - passed, node.most - depth) < needed:
                    alive = False
                    break
                start += step
                step *= 2
            if not alive:
                continue
            for other in node.ends:
                if overlap >= self._needed(size, len(self._sets[other])) and self.find(other) != self.find(me):
                    if not (self._skip and self._skip(me, other)):
                        self._link(me, other)
            stack += [(child, overlap, depth, passed) for child in node.children.values()]

    def _insert(self, me: int, grams: np.ndarray) -> None:
        children, size, start = self._root, len(grams), 0
        while True:
            key = int(grams[start])
            node = children.get(key)
            if node is None:
                children[key] = node = _Node(grams[start:], size, me)
                node.ends.append(me)
                return
            length = min(len(node.grams), size - start)
            differ = np.flatnonzero(node.grams[:length] != grams[start:start + length])
            shared = int(differ[0]) if differ.size else length
            if shared < len(node.grams):
                below = _Node(node.grams[shared:], 0, 0)
                below.children, below.ends, below.one = node.children, node.ends, node.one
                below.least, below.most = node.least, node.most
                node.grams, node.ends = node.grams[:shared], []
                node.children = {int(below.grams[0]): below}
            node.least, node.most = min(node.least, size), max(node.most, size)
            if node.one is not None and self.find(node.one) != self.find(me):
                node.one = None
            start += shared
            if start == size:
                node.ends.append(me)
                return
            children = node.children


def _by_group(batches: Iterator[pa.RecordBatch], keys: int) -> Iterator[tuple[tuple, list[tuple]]]:
    """Groups of a partition sorted by its first ``keys`` columns, then size and ``sid``.

    A set that comes again, because a row of the input does, is left out.
    """
    rows = (row for batch in batches for row in zip(*[c.to_pylist() for c in batch.columns]))
    for key, group in groupby(rows, key=lambda r: r[:keys]):
        yield key, [next(same) for _, same in groupby(group, key=lambda r: r[keys + 1])]


def _join_homes(sets: DataFrame, percent: int) -> DataFrame:
    """``sid`` and ``other``: each set with the first one of its class in its block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for _, rows in _by_group(batches, 2):
            trie = Trie(percent)
            for row in rows:
                trie.add(np.frombuffer(row[4], np.uint64))
            sids = [r[3] for r in rows]
            yield pa.RecordBatch.from_arrays([
                pa.array(sids, pa.int64()),
                pa.array([sids[trie.find(i)] for i in range(len(sids))], pa.int64()),
            ], ["sid", "other"])

    return (
        sets.select("home", "block", "n", "sid", "grams")
        .repartition("home", "block").sortWithinPartitions("home", "block", "n", "sid")
        .mapInArrow(run, "sid long, other long")
    )


def _folded(signature: np.ndarray, words: int) -> np.ndarray:
    """A signature in as many words, no more than it has."""
    return np.bitwise_xor.reduce(signature.reshape(-1, words), axis=0)


def _possible(
    sizes: np.ndarray, signatures: list[bytes], percent: int, met: Callable[[int, int], np.ndarray]
) -> np.ndarray:
    """Which of some sets, the smallest first, may be similar to another of them.

    ``met(k, first)`` tells which of the sets from ``first`` up to ``k`` count as met by ``k``.
    """
    found = np.zeros(len(sizes), bool)
    bits = [np.frombuffer(s, np.uint64) for s in signatures]
    lengths = np.array([len(b) for b in bits])
    # Sets of one width are neighbours.
    starts = np.concatenate(([0], np.flatnonzero(np.diff(lengths)) + 1, [len(bits)])).tolist()
    widths = [(a, b, np.stack(bits[a:b])) for a, b in zip(starts, starts[1:])]
    firsts = np.searchsorted(sizes, -(-percent * sizes // 100)).tolist()
    for k, first in enumerate(firsts):
        if first == k:
            continue
        both = sizes[first:k] + sizes[k]
        apart = both - 2 * -(-percent * both // (100 + percent))
        differ = np.full(k - first, np.iinfo(np.int64).max)
        for a, b, table in widths:
            low, high = max(a, first), min(b, k)
            if low < high:
                own = _folded(bits[k], table.shape[1])
                differ[low - first:high - first] = np.bitwise_count(table[low - a:high - a] ^ own).sum(axis=1)
        likely = (differ <= apart) & ~met(k, first)
        if likely.any():
            found[k] = True
            found[first:k] |= likely
    return found


def _likely(placed: DataFrame, percent: int) -> DataFrame:
    """The rows of ``placed`` with a partner at their place that signatures do not rule out."""
    schema = placed.drop("signature").schema

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, i, j), rows in _by_group(batches, 3):
            classes = np.array([r[8] for r in rows], np.int64)
            homes = np.array([r[5] for r in rows], np.int64)
            blocks = np.array([r[6] for r in rows], np.int64)
            sides = np.array([r[7] for r in rows], np.int64)

            def met(k: int, first: int) -> np.ndarray:
                at = slice(first, k)
                known = (classes[at] == classes[k]) | ((homes[at] == homes[k]) & (blocks[at] == blocks[k]))
                return known | (sides[at] == sides[k]) if i != j else known

            found = _possible(np.array([r[3] for r in rows], np.int64), [r[9] for r in rows], percent, met)
            kept = [rows[k] for k in np.flatnonzero(found).tolist()]
            yield pa.RecordBatch.from_arrays([
                pa.array([r[at] for r in kept], pa.int32() if f.dataType == T.IntegerType() else pa.int64())
                for at, f in enumerate(schema)
            ], [f.name for f in schema])

    return (
        placed.repartition("gram", "i", "j").sortWithinPartitions("gram", "i", "j", "n", "sid")
        .mapInArrow(run, schema)
    )


def _once(likely: DataFrame) -> DataFrame:
    """Without places at which just the same sets, on the same sides, meet as at another."""
    place = ["gram", "i", "j"]
    side = "CASE WHEN i < j THEN side = i END"
    met = likely.groupBy(*place).agg(
        F.count("*").alias("sets"), F.expr(f"bit_xor(xxhash64(sid, {side}))").alias("who"),
        F.expr(f"bit_xor(xxhash64(1, sid, {side}))").alias("who2"),
    )
    first = met.groupBy("sets", "who", "who2", F.expr("i < j")).agg(F.min(F.struct(*place)).alias("p"))
    return likely.join(first.select("p.*"), place, "left_semi")


def _join_rest(sets: DataFrame, percent: int) -> DataFrame:
    """Links ``a``, ``b`` between classes, of sets that did not meet before."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (_, i, j), rows in _by_group(batches, 3):
            met = [(r[5], r[6], r[7] if i != j else None) for r in rows]

            def skip(a: int, b: int) -> bool:
                return met[a][:2] == met[b][:2] or (i != j and met[a][2] == met[b][2])

            trie = Trie(percent, skip)
            first: dict[int, int] = {}
            for k, row in enumerate(rows):
                trie.add(np.frombuffer(row[9], np.uint64), first.get(row[8]))
                first.setdefault(row[8], k)
            links = sorted({(rows[a][8], rows[b][8]) for a, b in trie.links})
            yield pa.RecordBatch.from_arrays([
                pa.array([x[0] for x in links], pa.int64()), pa.array([x[1] for x in links], pa.int64())
            ], ["a", "b"])

    return (
        sets.select("gram", "i", "j", "n", "sid", "home", "block", "side", "class", "grams")
        .repartition("gram", "i", "j").sortWithinPartitions("gram", "i", "j", "n", "sid")
        .mapInArrow(run, "a long, b long")
    )


def _blocked(members: DataFrame, key: str) -> DataFrame:
    """Adds ``blocks``, how many a group needs, and ``block``, one of them for each member."""
    sizes = members.groupBy(key).agg(
        F.greatest(
            F.ceil(F.sum("n") / BLOCK_GRAMS), F.ceil(F.count("*") / BLOCK_SETS)
        ).cast("int").alias("blocks")
    )
    return members.join(sizes, key).withColumn(
        "block", F.pmod(F.xxhash64("sid"), F.col("blocks")).cast("int")
    )


def jaccard_classes(
    df: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    width: int = 4,
    percent: int = 85,
) -> DataFrame:
    """One row per input row: the size of its n-gram set and its component.

    Words are lower-cased in A-Z.  A set holds the distinct ``width``-word shingles; a text
    of fewer words has its whole sequence as one; without words or text the set is empty and
    linked with nothing.  Two rows are linked when 100 times the intersection is at least
    ``percent`` times the union.  Columns: the id, ``n_shingles`` and ``component_id``, the
    smallest id reachable by links, which a null id never is unless all are null.  Rows of
    one id count each with its own text.  An empty table gives no rows.
    """
    spark = df.sparkSession
    ship_code(spark)
    docs = df.select(F.col(id_col).alias("doc"), text_of(text_col).alias("text"))
    sketches = written(_sketches(docs, width), "jaccard_sketches")
    rows = sketches.filter("chunk IS NULL").select("doc", "n", "d1", "d2")
    ranks = spark.sparkContext.broadcast(_count_ranks(sketches))
    key = ["n", "d1", "d2"]
    classes = written(
        rows.filter("n > 0").groupBy(*key).agg(F.min("doc").alias("rep"))
        .withColumn("sid", F.monotonically_increasing_id()),
        "jaccard_classes",
    )

    # Grams that the first grams of several sets share.
    prefixes = _prefixes(docs, width, percent, ranks).withColumnRenamed("doc", "own")
    same = (prefixes["d1"] == classes["d1"]) & (prefixes["d2"] == classes["d2"])
    owners = prefixes.join(classes, same & F.col("own").eqNullSafe(F.col("rep")))
    shared = _in_several(owners.select("sid", F.col("n").cast("int").alias("n"), F.explode("prefix").alias("gram")))
    # Without the sets that share too few, others share fewer.
    shared = _in_several(_grams_of(_sharing(shared, percent)))
    listed = written(_sharing(shared, percent), "jaccard_shared")
    homes = listed.select("sid", "n", F.element_at("all", -1)["gram"].alias("home"))
    candidates = written(_blocked(homes, "home"), "jaccard_homes")
    shared = _without_last(listed, percent)

    wanted = written(candidates.join(classes.select("sid", "rep", "d1", "d2"), "sid"), "jaccard_wanted")
    sets = written(_whole_sets(_texts_of(docs, wanted), width, ranks), "jaccard_sets")

    # Homes, block by block, then one member of each class of the homes with many blocks.
    pairs = written(_join_homes(sets, percent), "jaccard_links")
    links, split, count = pairs, sets.filter("blocks > 1"), None
    while True:
        firsts = split.join(pairs.filter("sid = other").select("sid"), "sid", "left_semi").drop("blocks", "block")
        firsts = written(_blocked(firsts, "home"), "jaccard_firsts")
        left = firsts.count()
        if not left or left == count:
            break
        pairs = written(_join_homes(firsts, percent), "jaccard_links")
        links = links.unionByName(pairs)
        split, count = firsts.filter("blocks > 1"), left
    roots = written(_roots(links, candidates), "jaccard_roots")

    # Grams whose sets are of several classes and did not all meet.
    spread = (
        shared.join(roots, "sid").groupBy("gram")
        .agg(
            F.min("class").alias("c0"), F.max("class").alias("c1"),
            F.min(F.struct("home", "block")).alias("h0"), F.max(F.struct("home", "block")).alias("h1"),
            F.count("*").alias("sets"), F.expr("bit_xor(xxhash64(sid))").alias("who"),
            F.expr("bit_xor(xxhash64(1, sid))").alias("who2"),
        )
        .filter("c0 <> c1 AND h0 <> h1")
        # The same sets need to meet once only.
        .groupBy("sets", "who", "who2").agg(F.min("gram").alias("gram")).select("gram")
    )
    meeting = _blocked(
        shared.drop("sets").join(written(spread, "jaccard_spread"), "gram")
        .join(roots.withColumnRenamed("block", "own_block"), "sid"),
        "gram",
    ).withColumnRenamed("block", "side").withColumnRenamed("own_block", "block")
    placed = meeting.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1))).select(
        "gram", F.least("side", "other").alias("i"), F.greatest("side", "other").alias("j"),
        "sid", "home", "block", "side", "class",
    )
    signed = placed.join(sets.select("sid", "n", "signature"), "sid").select(
        "gram", "i", "j", "n", "sid", "home", "block", "side", "class", "signature"
    )
    likely = written(_once(written(_likely(signed, percent), "jaccard_signed")), "jaccard_likely")
    ids = written(likely.select("sid").distinct().withColumn("wanted", F.lit(True)), "jaccard_ids")
    whole = join_few(sets.select("sid", "grams"), ids, ["sid"], "left").filter("wanted")
    more = written(
        _join_rest(likely.join(whole.select("sid", "grams"), "sid"), percent).distinct(), "jaccard_more"
    )
    final = connected_components(more)
    components = (
        roots.join(final, F.col("class") == F.col("node"), "left")
        .select("sid", F.coalesce("root", "class").alias("component"))
    )
    named = classes.join(components, "sid", "left").withColumn(
        "component", F.coalesce("component", "sid")
    )
    smallest = written(
        named.groupBy("component").agg(F.min("rep").alias("component_id"), F.count("*").alias("sets"))
        .filter("sets > 1").drop("sets"),
        "jaccard_names",
    )
    by_set = written(
        named.join(smallest, "component", "left")
        .select(*key, F.coalesce("component_id", "rep").alias("component_id")),
        "jaccard_named",
    )
    return rows.join(by_set, key, "left").select(
        F.col("doc").alias(id_col), F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("component_id")).otherwise(F.col("doc")).alias("component_id"),
    )


def _texts_of(docs: DataFrame, wanted: DataFrame) -> DataFrame:
    """The wanted sets with the texts of their rows ``rep``.

    No text is shuffled where the list of the wanted is small enough to broadcast; beyond
    that a bitmap of their rows keeps other texts out of the shuffle.
    """
    same = F.col("doc").eqNullSafe(F.col("rep"))
    if stored_bytes(wanted) <= BROADCAST_BYTES:
        return docs.join(F.broadcast(wanted), same).drop("doc", "rep")
    position = F.pmod(F.xxhash64("doc"), F.lit(FILTER_BITS))
    bitmap = wanted.select(F.pmod(F.xxhash64("rep"), F.lit(FILTER_BITS)).alias("p")).groupBy(
        F.floor(F.col("p") / BUCKET_BITS).alias("bucket")
    ).agg(F.bitmap_construct_agg(F.col("p") % BUCKET_BITS).alias("bitmap"))
    likely = docs.join(
        F.broadcast(bitmap), F.floor(position / BUCKET_BITS) == F.col("bucket")
    ).filter(_is_set(F.col("bitmap"), position)).select("doc", "text")
    return likely.join(wanted, same).drop("doc", "rep")


def _in_several(grams: DataFrame) -> DataFrame:
    """The rows whose gram is in more than one set, with ``sets``, how many."""
    same = Window.partitionBy("gram")
    several = grams.select(
        "*", F.min("sid").over(same).alias("least"), F.max("sid").over(same).alias("most"),
        F.count("*").over(same).cast("int").alias("sets"),
    )
    return several.filter("least <> most").drop("least", "most")


def _sharing(grams: DataFrame, percent: int) -> DataFrame:
    """``sid``, ``n`` and ``all``, its grams, of the sets that share as many as they must."""
    listed = grams.groupBy("sid", "n").agg(F.sort_array(F.collect_set(F.struct("sets", "gram"))).alias("all"))
    return listed.filter(f"size(all) >= {_needed_sql('n', percent)}")


def _grams_of(listed: DataFrame) -> DataFrame:
    return listed.select("sid", "n", F.explode("all.gram").alias("gram"))


def _without_last(listed: DataFrame, percent: int) -> DataFrame:
    """The grams at which sets meet: all but the most frequent of each set.

    Similar sets share ``k`` grams here, the ``k`` of the smaller one.  In the order of
    frequency, the first of them has ``k - 1`` others behind it in both sets, so it stays
    when each set leaves out ``k - 1``, for the ``k`` of the smallest partner it can have.
    """
    smallest = f"({percent} * n + 99) div 100"
    kept = f"slice(all, 1, cast(size(all) - {_needed_sql(f'({smallest})', percent)} + 1 AS int))"
    return listed.select("sid", "n", F.explode(F.expr(kept)).alias("g")).select(
        "sid", "n", "g.gram", "g.sets"
    )


def _roots(links: DataFrame, candidates: DataFrame) -> DataFrame:
    """``sid``, ``class``, ``home``, ``block`` of every candidate after the home joins."""
    edges = links.filter("sid <> other").select(F.col("sid").alias("a"), F.col("other").alias("b"))
    found = connected_components(edges)
    return candidates.join(found, F.col("sid") == F.col("node"), "left").select(
        "sid", F.coalesce("root", "sid").alias("class"), "home", "block"
    )
