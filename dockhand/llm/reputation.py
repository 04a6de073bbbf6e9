"""URL filtering by rules and by the reputation of hosts.

Pages with a known outcome (good or not) are counted per host.  Counts are shrunk by
beta-binomial priors from host to registered domain to public suffix to all pages: the
prior of a level has the mean of the level above, and a weight, in pages, that the spread
of the level's own counts gives (method of moments).  A host goes when the upper bound of
its posterior share of good pages is below what is asked for.

Only host names and counts are shuffled, summed on the map side first; urls are shuffled
only where the table of hosts is too large to broadcast.
"""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from dockhand.errors import SpecError
from dockhand.functions.sql import sql_literal, sql_name
from dockhand.llm.common import LOWER, UPPER, lower_ascii, written

# Labels that make a public suffix together with a country's two letters.
SECOND_LEVELS = ("ac", "co", "com", "edu", "go", "gov", "ne", "net", "or", "org")

# Least good share asked for, and the deviations that its upper bound lies above the mean.
MIN_GOOD = 0.5
DEVIATIONS = 1.645
# A prior weighs at least and at most so many pages.
WEIGHTS = (1.0, 1000.0)

COLUMNS = ("host", "path", "rule", "verdict", "n_labelled", "n_good", "good_rate", "good_bound")

Rule = tuple[str, str, str]


def url_parts(url: Column) -> tuple[Column, Column]:
    """Host, A-Z lower-cased, and path of a url, both empty where it is null or has no ``://``."""
    pattern = r"(?s)^.*?://([^/?#]*)([^?#]*)"
    given = F.coalesce(url.cast("string"), F.lit(""))
    return lower_ascii(F.regexp_extract(given, pattern, 1)), F.regexp_extract(given, pattern, 2)


def _longest_first(rules: Iterable[Rule]) -> list[Rule]:
    return sorted(rules, key=lambda r: (-len(r[0] + r[1]), -len(r[0]), r))


def _by_rule(rules: Iterable[Rule], value: str) -> str:
    """SQL for the longest rule that fits ``host`` and ``path``, for Spark and DuckDB alike."""
    cases = " ".join(
        f"WHEN (host = {_quoted(host)} OR right(host, {len(host) + 1}) = {_quoted('.' + host)})"
        f" AND left(path, {len(path)}) = {_quoted(path)}"
        f" THEN {_quoted(host + path if value == 'rule' else verdict)}"
        for host, path, verdict in _longest_first(rules)
    )
    return f"CASE {cases} END" if cases else "nullif('', '')"


def _quoted(text: str) -> str:
    if "'" in text or "\\" in text:
        raise SpecError(f"a rule must not hold quotes or backslashes: {text!r}")
    return f"'{text}'"


def _places(hosts: DataFrame) -> DataFrame:
    """``domain`` and ``suffix`` of each ``host``, without account and port.

    An address of numbers is a domain of its own, under the empty suffix.
    """
    second = ", ".join(sql_literal(x) for x in SECOND_LEVELS)
    named = hosts.withColumn(
        "labels", F.split(F.regexp_replace(F.regexp_replace("host", "^.*@", ""), r"\.?(:[0-9]*)?$", ""), r"\.")
    )
    numbers = "array_join(labels, '') RLIKE '^([0-9]+|\\\\[.*)$'"
    of_suffix = (
        "CASE WHEN size(labels) > 2 AND length(element_at(labels, -1)) = 2"
        f" AND element_at(labels, -2) IN ({second}) THEN 2 ELSE 1 END"
    )
    last = "array_join(slice(labels, greatest(size(labels) - {n} + 1, 1), {n}), '.')"
    return named.withColumn("of_suffix", F.expr(of_suffix)).select(
        *hosts.columns,
        F.expr(f"CASE WHEN {numbers} THEN array_join(labels, '.') ELSE {last.format(n='(of_suffix + 1)')} END").alias("domain"),
        F.expr(f"CASE WHEN {numbers} THEN '' ELSE {last.format(n='of_suffix')} END").alias("suffix"),
    )


def _weight(level: DataFrame) -> float:
    """The weight of a level's prior, out of its counts ``n``, ``k`` and prior mean ``m``.

    The spread of counts beyond that of a binomial gives the correlation of pages that
    belong together.
    """
    spread = level.agg(
        F.sum(F.expr("(k - n * m) * (k - n * m) - n * m * (1 - m)")).alias("over"),
        F.sum(F.expr("n * (n - 1) * m * (1 - m)")).alias("pairs"),
    ).first()
    low, high = WEIGHTS
    over, pairs = spread["over"] or 0.0, spread["pairs"] or 0.0
    return high if over <= 0 else min(max(pairs / over - 1, low), high)


def _shrunk(level: DataFrame, weight: float) -> Column:
    w = F.lit(weight)
    return (F.col("k") + w * F.col("m")) / (F.col("n") + w)


def host_reputation(hosts: DataFrame) -> DataFrame:
    """``n``, ``k``, ``good_rate`` and ``good_bound`` of each ``host``.

    ``hosts`` has a row for each host, with the number ``n`` of pages with an outcome and
    ``k`` of good ones.  Without any outcome all is even.
    """
    sums = [F.sum("n").alias("n"), F.sum("k").alias("k")]
    placed = written(_places(hosts), "reputation_hosts")
    domains = written(placed.groupBy("domain", "suffix").agg(*sums), "reputation_domains")
    suffixes = written(domains.groupBy("suffix").agg(*sums), "reputation_suffixes")
    whole = suffixes.agg(*sums).first()
    m = ((whole["k"] or 0) + 1) / ((whole["n"] or 0) + 2)
    level = suffixes.withColumn("m", F.lit(m))
    means = level.select("suffix", _shrunk(level, _weight(level)).alias("m"))
    level = written(domains.join(means, "suffix"), "reputation_domains")
    means = level.select("domain", "suffix", _shrunk(level, _weight(level)).alias("m"))
    level = written(placed.join(means, ["domain", "suffix"]), "reputation_hosts")
    weight = F.lit(_weight(level))
    a = weight * F.col("m") + F.col("k")
    b = weight * (1 - F.col("m")) + F.col("n") - F.col("k")
    return level.select("host", "n", "k", a.alias("a"), b.alias("b")).select(
        "host", "n", "k", F.expr("a / (a + b)").alias("good_rate"),
        F.expr(f"least(a / (a + b) + {DEVIATIONS}D * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))), 1D)")
        .alias("good_bound"),
    )


def judge_urls(
    df: DataFrame,
    outcomes: DataFrame,
    rules: Iterable[Rule] = (),
    id_col: str = "page_id",
    url_col: str = "url",
    min_good: float = MIN_GOOD,
) -> DataFrame:
    """``df`` with host, path, rule and verdict of each url, one row per input row.

    ``outcomes`` has the id and a boolean ``good``; of several for one id all must be good,
    null ones do not count.  A rule (host, path, verdict) fits its host and all below it if the
    path begins with the rule's; the longest decides, and where none fits, the host's
    reputation: ``block`` if ``good_bound`` is below ``min_good``, else ``allow``.  Urls without
    host share the empty one.  Rows without an id have no outcome; rows that repeat one all
    count.  Added, in place of columns of the same names: :data:`COLUMNS`.
    """
    rules = list(rules)
    own = [c for c in df.columns if c not in COLUMNS]
    host, path = url_parts(F.col(sql_name(url_col)))
    pages = df.select(
        F.col(sql_name(id_col)).alias("page"), host.alias("host"), path.alias("path"),
        F.struct(F.lit(0).alias("_"), *[F.col(sql_name(c)).alias(c) for c in own]).alias("row"),
    )
    known = (
        outcomes.filter(f"{sql_name(id_col)} IS NOT NULL AND good IS NOT NULL")
        .groupBy(F.col(sql_name(id_col)).alias("page")).agg(F.min("good").alias("good"))
    )
    hosts = pages.select("page", "host").join(known, "page", "left").groupBy("host").agg(
        F.count("good").alias("n"), F.count_if("good").alias("k")
    )
    scores = written(host_reputation(hosts), "reputation").withColumnRenamed("host", "of")
    verdict = F.coalesce(
        F.expr(_by_rule(rules, "verdict")),
        F.when(F.col("good_bound") < min_good, "block").otherwise("allow"),
    )
    return pages.join(scores, F.col("host") == F.col("of")).select(
        *[F.col("row." + sql_name(c)) for c in own], "host", "path",
        F.expr(_by_rule(rules, "rule")).alias("rule"), verdict.alias("verdict"),
        F.col("n").alias("n_labelled"), F.col("k").alias("n_good"), "good_rate", "good_bound",
    )


def oracle_sql(rules: Iterable[Rule], min_good: float = MIN_GOOD) -> str:
    """DuckDB SQL over ``pages`` and ``labels`` with the rows of the query."""
    rules = list(rules)
    second = ", ".join(f"'{x}'" for x in SECOND_LEVELS)
    pattern = "(?s)^.*?://([^/?#]*)([^?#]*)"
    low, high = WEIGHTS

    def level(name: str, keys: str, table: str, on: str) -> str:
        """A level's shrunk means, below those of the table above."""
        return f"""
{name}_m AS (SELECT {keys}, sum(l.n) AS n, sum(l.k) AS k, any_value(p.m) AS m
  FROM hosts l JOIN {table} p ON {on} GROUP BY {keys}),
{name}_w AS (SELECT CASE WHEN coalesce(sum((k - n * m) * (k - n * m) - n * m * (1 - m)), 0) <= 0 THEN {high}
  ELSE least(greatest(sum(n * (n - 1) * m * (1 - m)) / sum((k - n * m) * (k - n * m) - n * m * (1 - m)) - 1,
    {low}), {high}) END AS w FROM {name}_m),
{name} AS (SELECT * EXCLUDE (m), m AS prior, (k + (SELECT w FROM {name}_w) * m) / (n + (SELECT w FROM {name}_w)) AS m
  FROM {name}_m)"""

    return f"""
WITH parsed AS (
  SELECT page_id, translate(regexp_extract(coalesce(url, ''), '{pattern}', 1), '{UPPER}', '{LOWER}') AS host,
    regexp_extract(coalesce(url, ''), '{pattern}', 2) AS path FROM pages),
known AS (
  SELECT doc_id, bool_and(quality = 1 AND toxic = 0) AS good FROM labels
  WHERE doc_id IS NOT NULL AND (quality = 1 AND toxic = 0) IS NOT NULL GROUP BY doc_id),
counted AS (
  SELECT host, count(good) AS n, count(*) FILTER (good) AS k FROM parsed LEFT JOIN known ON page_id = doc_id
  GROUP BY host),
labelled AS (
  SELECT *, string_split(regexp_replace(regexp_replace(host, '^.*@', ''), '\\.?(:[0-9]*)?$', ''), '.') AS labels
  FROM counted),
cut AS (
  SELECT *, CASE WHEN len(labels) > 2 AND length(labels[-1]) = 2 AND labels[-2] IN ({second}) THEN 2 ELSE 1 END AS o,
    regexp_matches(array_to_string(labels, ''), '^([0-9]+|\\[.*)$') AS numbers
  FROM labelled),
hosts AS (
  SELECT host, n, k,
    CASE WHEN numbers THEN array_to_string(labels, '.') ELSE array_to_string(labels[-(o + 1):], '.') END AS domain,
    CASE WHEN numbers THEN '' ELSE array_to_string(labels[-o:], '.') END AS suffix
  FROM cut),
everything AS (SELECT (coalesce(sum(k), 0) + 1) / (coalesce(sum(n), 0) + 2) AS m FROM hosts),
{level("suffixes", "l.suffix", "everything", "true")},
{level("domains", "l.domain, l.suffix", "suffixes", "l.suffix = p.suffix")},
{level("named", "l.host", "domains", "l.domain = p.domain AND l.suffix = p.suffix")},
beta AS (
  SELECT host, n, k, (SELECT w FROM named_w) * prior + k AS a, (SELECT w FROM named_w) * (1 - prior) + n - k AS b
  FROM named),
judged AS (
  SELECT host, n, k, a / (a + b) AS good_rate,
    least(a / (a + b) + {DEVIATIONS} * sqrt(a * b / ((a + b) * (a + b) * (a + b + 1))), 1) AS good_bound FROM beta)
SELECT page_id, host, path, {_by_rule(rules, "rule")} AS rule,
  coalesce({_by_rule(rules, "verdict")}, CASE WHEN good_bound < {min_good} THEN 'block' ELSE 'allow' END) AS verdict,
  CAST(n AS BIGINT) AS n_labelled, CAST(k AS BIGINT) AS n_good, round(good_rate, 6) AS good_rate,
  round(good_bound, 6) AS good_bound
FROM parsed JOIN judged USING (host)"""
