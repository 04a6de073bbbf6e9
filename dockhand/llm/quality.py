"""Quality rules: plain counts, and a log-likelihood ratio over hashed n-grams.

Words and pairs of words are hashed into a fixed number of buckets.  Two multinomials over
the buckets, of the trusted documents and of the whole corpus, give each bucket the log of
the ratio of its probabilities.  A document's score is the mean over its n-grams, so length
does not matter, and documents below a threshold go.  The buckets' counts or weights are the
only thing shared, arrays of fixed size.

Held out, a document is compared with the other documents alone, and a bucket's trusted count
with the count that the raw multinomial lets expect, the same pseudo-count added to both.  So
n-grams that the other documents hardly have weigh next to nothing, however small the corpus.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from dockhand.llm.common import Aside, text_of, words_of

BUCKETS = 1 << 16
# Pseudo-count of every bucket in both multinomials.
SMOOTHING = 1.0
# Trusted n-grams as expected that are added to a bucket's counts where rows are held out.
EXPECTED = 8.0
# Weights are fixed-point numbers, so that sums are the same in any order.
UNIT = 1 << 20
# Documents whose mean log ratio is below this are rejected.
THRESHOLD = -0.1
# The target multinomial is fitted on at most so many trusted rows, the ones with the
# smallest hashes of their ids; their ids are broadcast, 8 bytes each.
MAX_TRUSTED = 200_000
MIN_WORDS = 50
MAX_REPEATED_PERCENT = 50

_SYMBOLS = "#*$%&|<>"
# The bucket of a hash.
_BUCKET = f"cast({{}} & {BUCKETS - 1}L AS int)"


def _measured(df: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Every row with its words hashed and the plain counts."""
    out = df.withColumn("_text", text_of(text_col))
    out = out.withColumn("_words", words_of(F.col("_text")))
    # (?U) is off: the classes are ASCII.  Possessive, so long runs take no stack.
    out = out.withColumn("_hashes", F.expr("transform(_words, w -> xxhash64(w))")).withColumn(
        "_filled", F.expr(rf"filter(split(_text, '\n'), x -> x RLIKE '[^\\x20\\x09-\\x0D]')")
    )
    return out.withColumns({
        "n_words": F.size("_words").cast("bigint"),
        "word_chars": F.length(F.concat_ws("", "_words")).cast("bigint"),
        "n_symbols": F.length(F.regexp_replace("_text", f"[^{_SYMBOLS}]++", "")).cast("bigint"),
        "n_dup_lines": F.expr("cast(size(_filled) - size(array_distinct(_filled)) AS bigint)"),
        # A bitwise AND, a remainder that is never null: arrays without nulls sort as numbers.
        # An empty slice is such an array too; a cast empty array is not.
        "_grams": F.expr(f"transform(_hashes, h -> {_BUCKET.format('h')})"),
        "_pairs": F.expr(
            "transform(slice(_hashes, 1, greatest(size(_hashes) - 1, 0)),"
            f" (h, i) -> {_BUCKET.format('xxhash64(h, _hashes[i + 1])')})"
        ),
        "_windows": F.expr(
            "transform(slice(_hashes, 1, greatest(size(_hashes) - 2, 0)),"
            " (h, i) -> xxhash64(h, _hashes[i + 1], _hashes[i + 2]))"
        ),
    })


def _repeat_words(df: DataFrame) -> DataFrame:
    """Adds ``n_repeat_words``: words in 3-word windows that the text has twice or more.

    Equal windows are neighbours once sorted; the places of those that have an equal
    neighbour are sorted again, and each adds the words up to the next one's start.
    """
    repeats = "size(array_distinct(_windows)) < size(_windows)"
    ordered = df.withColumn("_ordered", F.expr(
        f"CASE WHEN {repeats} THEN sort_array(transform(_windows, (w, i) -> struct(w, i))) END"
    ))
    places = ordered.withColumn("_places", F.expr(
        "sort_array(transform(filter(_ordered, (x, k) ->"
        " (k > 0 AND _ordered[greatest(k - 1, 0)].w = x.w)"
        " OR (k < size(_ordered) - 1 AND _ordered[least(k + 1, size(_ordered) - 1)].w = x.w)),"
        " x -> x.i))"
    ))
    return places.withColumn("n_repeat_words", F.expr(
        "CASE WHEN _places IS NULL THEN 0L ELSE aggregate("
        "transform(_places, (p, k) -> CASE WHEN k = size(_places) - 1 THEN 3"
        " ELSE least(3, _places[least(k + 1, size(_places) - 1)] - p) END), 0L, (n, x) -> n + x) END"
    ))


def _chosen(trusted: DataFrame, max_trusted: int) -> DataFrame:
    """``_trusted``: the ids that the target multinomial is fitted on."""
    return (
        trusted.select(F.col("doc_id").alias("_trusted")).dropna().distinct()
        .orderBy(F.xxhash64("_trusted"), "_trusted").limit(max_trusted)
    )


def _listed(df: DataFrame, chosen: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """One row: ``all``, the counts of every bucket in order, and the two totals."""
    # The same buckets as in the arrays of a row, by a row for each word: without lambdas, which
    # Spark does not compile.
    words = (
        df.select(F.col(id_col).alias("_id"), words_of(text_of(text_col)).alias("_words"))
        .join(F.broadcast(chosen), F.col("_id") == F.col("_trusted"), "left")
        # Outer, as a plain explode brings a filter that would repeat all of the above.
        .select(
            F.col("_trusted").isNotNull().alias("target"), "_words",
            F.posexplode_outer("_words").alias("_place", "_word"),
        )
        .filter("_word IS NOT NULL")
    )
    pair = "xxhash64(xxhash64(_word), xxhash64(_words[_place + 1]))"
    grams = words.select("target", F.explode(F.expr(
        f"array({_BUCKET.format('xxhash64(_word)')},"
        f" CASE WHEN _place + 1 < size(_words) THEN {_BUCKET.format(pair)} END)"
    )).alias("bucket")).filter("bucket IS NOT NULL")
    counts = grams.groupBy("bucket").agg(
        F.count("*").alias("raw"), F.count_if("target").alias("target")
    )
    every = counts.sparkSession.range(BUCKETS).select(F.col("id").cast("int").alias("bucket"))
    return every.join(counts, "bucket", "left").fillna(0).groupBy().agg(
        # The buckets are a fixed number, so one row of them is bounded.
        F.sort_array(F.collect_list(F.struct("bucket", "raw", "target"))).alias("all"),
        F.sum("raw").alias("raw_total"), F.sum("target").alias("target_total"),
    )


def bucket_weights(
    df: DataFrame, trusted: DataFrame, id_col: str = "doc_id", text_col: str = "text",
    max_trusted: int = MAX_TRUSTED,
) -> DataFrame:
    """One row, ``weights``: the fixed-point log ratio of every bucket.

    ``trusted`` has a column ``doc_id``.  The raw multinomial covers all rows of ``df``; the
    target one its rows with a trusted id.  Without any trusted row all weights are 0.
    """
    ratio = (
        f"ln((x.target + {SMOOTHING}D) / (target_total + {SMOOTHING * BUCKETS}D))"
        f" - ln((x.raw + {SMOOTHING}D) / (raw_total + {SMOOTHING * BUCKETS}D))"
    )
    return _listed(df, _chosen(trusted, max_trusted), id_col, text_col).select(F.expr(
        "transform(all, x -> CASE WHEN target_total = 0 THEN 0L"
        f" ELSE cast(round(({ratio}) * {UNIT}) AS bigint) END)"
    ).alias("weights"))


def _scored(counted: DataFrame, df: DataFrame, trusted: DataFrame, id_col: str, text_col: str, max_trusted: int) -> DataFrame:
    """Adds ``score`` by the bucket weights."""
    weights = bucket_weights(df, trusted, id_col, text_col, max_trusted).scalar()
    weighed = counted.withColumn("_weights", weights).withColumn("_sum", F.expr(
        "aggregate(_grams, 0L, (s, b) -> s + _weights[b])"
        " + aggregate(_pairs, 0L, (s, b) -> s + _weights[b])"
    ))
    n_grams = F.size("_grams") + F.size("_pairs")
    return weighed.withColumn(
        "score", F.when(n_grams > 0, F.col("_sum") / n_grams / UNIT).otherwise(F.lit(0.0))
    )


def _scored_held_out(counted: DataFrame, df: DataFrame, trusted: DataFrame, id_col: str, text_col: str, max_trusted: int) -> DataFrame:
    """Adds ``score`` by the counts of the other rows."""
    chosen = _chosen(trusted, max_trusted)
    listed = _listed(df, chosen, id_col, text_col)
    # Sorted, so that equal buckets are neighbours and sums have one order.
    placed = counted.join(F.broadcast(chosen), F.col(id_col) == F.col("_trusted"), "left").withColumns({
        "_totals": listed.select(F.struct("raw_total", "target_total")).scalar(),
        "_own": F.col("_trusted").isNotNull().cast("double"),
        "_all": F.sort_array(F.concat("_grams", "_pairs")),
    })
    # Most buckets occur once in a row; the others are neighbours of their like.
    again = placed.withColumn("_again", F.expr("filter(_all, (b, i) -> b <=> get(_all, i + 1))")).withColumn("_rate", F.expr(
        # Null where there is no n-gram, or no other row has one.
        "CASE WHEN size(_all) > 0 AND _totals.raw_total > size(_all) THEN"
        " cast(_totals.target_total - _own * size(_all) AS double) / (_totals.raw_total - size(_all)) END"
    ))
    # Arrays of numbers are subtracted in compiled code, so only few buckets are counted one by one.
    ends = again.withColumn("_once", F.array_except("_all", "_again")).withColumn("_ends", F.expr(
        "CASE WHEN size(_again) > 0 THEN"
        " filter(sequence(0, size(_again) - 1), i -> NOT (_again[i] <=> get(_again, i + 1))) END"
    ))
    runs = ends.withColumn("_runs", F.expr(
        "transform(_ends, (p, k) -> struct(_again[p] AS b, cast(p + 1 - coalesce(get(_ends, k - 1), -1) AS double) AS n))"
    ))
    # The tables of all buckets come last: a step that hands them on copies them for each row.
    # Spark adds such a step for a column that is read twice, so each is read once.
    raw = listed.select(F.expr("transform(all, x -> cast(x.raw AS double))"))
    target = listed.select(F.expr(f"transform(all, x -> x.target + {EXPECTED}D)"))
    tables = runs.withColumns({
        "_raw": raw.scalar(), "_target": target.scalar(),
        "_raw_once": raw.scalar(), "_target_once": target.scalar(),
    })
    return tables.withColumn("score", F.expr(
        "CASE WHEN _rate IS NULL THEN 0D ELSE ("
        "aggregate(_once, 0D, (s, b) -> s + ln("
        f"(_target_once[b] - _own) / ((_raw_once[b] - 1D) * _rate + {EXPECTED}D)))"
        " + aggregate(coalesce(_runs, array()), 0D, (s, x) -> s + x.n * ln("
        f"(_target[x.b] - _own * x.n) / ((_raw[x.b] - x.n) * _rate + {EXPECTED}D)))) / size(_all) END"
    ))


def judge(
    df: DataFrame,
    trusted: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    threshold: float = THRESHOLD,
    max_trusted: int = MAX_TRUSTED,
    held_out: bool = False,
) -> DataFrame:
    """``df`` with counts, score and verdict; one row per input row.

    Added, in place of columns of the same names: ``n_words``, ``word_chars``,
    ``n_symbols``, ``n_dup_lines``, ``n_repeat_words``, ``base_failed`` (fewer than 50 words
    or more than half of them in repeated windows), ``score`` (mean log ratio, 0 without
    words) and ``kept``: not failed and not below the threshold.  Null text has no words.

    With ``held_out`` each row is scored by the counts of the other rows, which keeps clean
    rows apart from junk at any size; without it by one table of weights, whose pseudo-counts
    ask for more text than their number.
    """
    added = [
        "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", "base_failed",
        "score", "kept",
    ]
    aside = Aside(df)
    own, row, text = aside.df, aside.name(id_col), aside.name(text_col)
    counted = _repeat_words(_measured(own, row, text))
    scored = (_scored_held_out if held_out else _scored)(counted, own, trusted, row, text, max_trusted)
    failed = (F.col("n_words") < MIN_WORDS) | (
        100 * F.col("n_repeat_words") > MAX_REPEATED_PERCENT * F.col("n_words")
    )
    verdict = scored.withColumn("base_failed", failed).withColumn(
        "kept", ~F.col("base_failed") & (F.col("score") >= threshold)
    )
    judged = verdict.select(*aside.own(verdict, added), *added)
    # A filter on the verdict stays above this node; below, it would repeat the work.
    return judged.observe(Observation(), F.count(F.lit(1)).alias("rows"))
