"""The registered queries of the operators, and the SQL of those that SQL can express."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from dockhand.llm.common import LOWER, UPPER, table
from dockhand.llm.conversations import as_turns, damaged, repair_report
from dockhand.llm.exact_dedup import exact_duplicates
from dockhand.llm.idfiles import through_id_files
from dockhand.llm.jaccard_join import jaccard_classes
from dockhand.llm.licences import oracle_sql as licences_sql
from dockhand.llm.licences import scan_licences
from dockhand.llm.line_dedup import drop_lines
from dockhand.llm.mixing import mix
from dockhand.llm.packing import pack
from dockhand.llm.phrases import collocations
from dockhand.llm.quality import judge
from dockhand.llm.reputation import judge_urls
from dockhand.llm.reputation import oracle_sql as reputation_sql
from dockhand.llm.suffix_tree import score
from dockhand.llm.warc import through_archives

# The ids that end a document.
PACKING_END_ID = 1
FILE_END_ID = 2

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def trusted_ids(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids that the labels call good and harmless."""
    return table(spark, sf_dir, "labels").filter("quality = 1 AND toxic = 0").select("doc_id")


@query
def op1_quality_rules(spark, sf_dir):
    """Every document's counts, log-likelihood ratio and verdict."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return judge(documents, trusted_ids(spark, sf_dir), held_out=True).drop("text")


@query
def op2_jaccard_join(spark, sf_dir):
    """Every document's number of shingles and its component of similar documents."""
    return jaccard_classes(table(spark, sf_dir, "documents"))


@query
def op3_warc(spark, sf_dir):
    """Every page's record, as read back from the archives."""
    records = through_archives(table(spark, sf_dir, "pages"))
    return records.select(
        F.col("page").cast("bigint").alias("page_id"), "payload_bytes", "payload_digest",
        "record_type", F.col("refers_to").cast("bigint").alias("refers_to"),
    )


ORACLES["op3_warc"] = """
SELECT page_id, payload_bytes, payload_digest,
  CASE WHEN page_id > first THEN 'revisit' ELSE 'response' END AS record_type,
  CASE WHEN page_id > first THEN first END AS refers_to
FROM (SELECT *, CASE WHEN payload_bytes >= 100 THEN min(page_id) OVER (PARTITION BY payload_digest) END AS first
      FROM (SELECT page_id, strlen(coalesce(html, '')) AS payload_bytes,
              sha256(coalesce(html, '')) AS payload_digest FROM pages))"""


def tokenizer_path(name: str) -> str:
    """Path of a vocabulary file of the public tokenizers."""
    import public_tokenizers

    return public_tokenizers.path(name)


@query
def op4_packing(spark, sf_dir):
    """Every piece of every document and its place in a sequence."""
    pieces = pack(
        table(spark, sf_dir, "documents"), tokenizer_path("word_bpe_49k.json"), PACKING_END_ID,
        special_tokens=True,
    )
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens",
        "sequence_id", "offset",
    )


@query
def op5_exact_dedup(spark, sf_dir):
    """Every document's group of equal texts."""
    return exact_duplicates(table(spark, sf_dir, "documents"))


ORACLES["op5_exact_dedup"] = f"""
SELECT doc_id, max(doc_id) OVER same AS keep_id, count(*) OVER same AS group_size,
  doc_id = max(doc_id) OVER same AS kept, text_sha256
FROM (SELECT doc_id, sha256(translate(coalesce(text, ''), '{UPPER}', '{LOWER}')) AS text_sha256
      FROM documents)
WINDOW same AS (PARTITION BY text_sha256)"""


@query
def op6_mixing(spark, sf_dir):
    """Every copy that the documents get, in the order of the global shuffle."""
    return mix(table(spark, sf_dir, "documents")).select(
        "doc_id", "source", F.round("rate", 6).alias("rate"), "n_copies", "copy", "shuffle_key",
        F.md5(F.coalesce("text", F.lit(""))).alias("text_md5"),
    )


ORACLES["op6_mixing"] = """
WITH sizes AS (
  SELECT source, CAST(sum(length(coalesce(text, ''))) AS DOUBLE) AS chars
  FROM documents GROUP BY source),
rates AS (
  SELECT source, CASE WHEN chars > 0 THEN
    sqrt(chars) / (SELECT sum(sqrt(chars)) FROM sizes) * (SELECT sum(chars) FROM sizes) / chars
    ELSE 1 END AS rate FROM sizes),
means AS (SELECT *, greatest(1, ceil(rate / 200))::INT AS draws, rate / greatest(1, ceil(rate / 200)) AS mean FROM rates),
terms AS (SELECT source, mean, unnest(range(0, ceil(mean + 12 * sqrt(mean) + 20)::INT + 1)) AS k FROM means),
cdf AS (
  SELECT source, sum(exp(k * ln(mean) - mean - lgamma(k + 1))) OVER (PARTITION BY source ORDER BY k) AS below
  FROM terms),
drawn AS (
  SELECT row, key, doc_id, source, text, rate,
    ('0x' || substr(md5(concat_ws(':', key, '0', j)), 1, 13))::BIGINT / 4503599627370496 AS u
  FROM (SELECT d.*, rate, unnest(range(1, draws + 1)) AS j FROM (
      SELECT row_number() OVER () AS row, coalesce(CAST(doc_id AS VARCHAR), md5(coalesce(text, ''))) AS key, * FROM documents) d
    JOIN means m ON d.source IS NOT DISTINCT FROM m.source)),
copies AS (
  SELECT any_value(doc_id) AS doc_id, any_value(source) AS source, any_value(text) AS text, any_value(key) AS key,
    any_value(rate) AS rate, CAST(sum((SELECT count(*) FROM cdf c
      WHERE c.source IS NOT DISTINCT FROM d.source AND c.below <= u)) AS INTEGER) AS n_copies
  FROM drawn d GROUP BY row)
SELECT doc_id, source, round(rate, 6) AS rate, n_copies, CAST(copy AS INTEGER) AS copy,
  md5(concat_ws(':', key, '0', 'copy', CAST(copy AS VARCHAR))) AS shuffle_key,
  md5(coalesce(text, '')) AS text_md5
FROM copies, LATERAL (SELECT unnest(range(1, n_copies + 1)) AS copy)"""


@query
def op7_line_dedup(spark, sf_dir):
    """Every document's lines before, the dropped ones, and a digest of what stays."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return drop_lines(documents).select(
        "doc_id", "n_lines", "n_dropped",
        F.sha2(F.encode("text", "UTF-8"), 256).alias("kept_sha256"),
    )


ORACLES["op7_line_dedup"] = f"""
WITH split AS (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS lines FROM documents),
lines AS (
  SELECT doc_id, unnest(lines) AS line, unnest(range(len(lines))) AS position FROM split),
keyed AS (
  SELECT *, translate(trim(line, chr(32) || chr(9) || chr(10) || chr(11) || chr(12) || chr(13)),
    '{UPPER}', '{LOWER}') AS key FROM lines),
shared AS (
  SELECT key FROM keyed WHERE key <> '' GROUP BY key HAVING count(DISTINCT doc_id) >= 10)
SELECT doc_id, count(*) AS n_lines, count(s.key) AS n_dropped,
  sha256(coalesce(string_agg(line, chr(10) ORDER BY position) FILTER (s.key IS NULL), '')) AS kept_sha256
FROM keyed k LEFT JOIN shared s ON k.key = s.key GROUP BY doc_id"""


@query
def op10_token_files(spark, sf_dir):
    """Every document's place and ids, as read back from the files."""
    documents = through_id_files(
        table(spark, sf_dir, "documents"), tokenizer_path("byte_bpe_50k.json"), FILE_END_ID,
        special_tokens=True,
    )
    return documents.select("doc_id", "start", "n_tokens", F.crc32("ids").alias("ids_crc32"))


@query
def op8_lm_scoring(spark, sf_dir):
    """Every document's log probability, by word counts and by the suffix tree."""
    return score(table(spark, sf_dir, "documents"), every_word=True)


@query
def op9_license_scans(spark, sf_dir):
    """Every document's licence sentences and the licences they make."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "text")
    return scan_licences(documents).drop("text")


ORACLES["op9_license_scans"] = licences_sql()


# What op11 allows and blocks whatever a host's reputation.
URL_RULES = [
    ("com", "/", "allow"), ("example.com", "/en/", "block"), ("www.example.com", "/en/", "allow"),
    ("net", "/es/", "block"), ("net", "/fr/", "block"),
]


@query
def op11_url_filters(spark, sf_dir):
    """Every page's host, path and verdict; a page's outcome is the label of its number."""
    outcomes = table(spark, sf_dir, "labels").selectExpr(
        "doc_id AS page_id", "quality = 1 AND toxic = 0 AS good"
    )
    pages = table(spark, sf_dir, "pages").select("page_id", "url")
    return judge_urls(pages, outcomes, URL_RULES).select(
        "page_id", "host", "path", "rule", "verdict", "n_labelled", "n_good",
        F.round("good_rate", 6).alias("good_rate"), F.round("good_bound", 6).alias("good_bound"),
    )


ORACLES["op11_url_filters"] = reputation_sql(URL_RULES)


@query
def op12_conversation_repair(spark, sf_dir):
    """Every conversation's faults after damage, the cheapest edits, and a digest of the result."""
    conversations = table(spark, sf_dir, "conversations")
    return repair_report(as_turns(conversations), damaged(conversations)).withColumnRenamed("conv", "conv_id")


@query
def op13_phrase_collocations(spark, sf_dir):
    """Every language's best phrases."""
    return collocations(table(spark, sf_dir, "documents"))


_FREQUENT = 100
ORACLES["op13_phrase_collocations"] = f"""
WITH pieces AS (
  SELECT coalesce(lang, 'und') AS lang, list_filter(regexp_split_to_array(unnest(regexp_split_to_array(
      translate(coalesce(text, ''), '{UPPER}', '{LOWER}'), '[.,;:!?\x0A-\x0D]')), '[ \t]+'), lambda x: x <> '') AS w
  FROM documents),
totals AS (SELECT lang, sum(len(w)) AS n FROM pieces GROUP BY lang),
windows AS (
  SELECT lang, size, unnest(list_transform(range(1, len(w) - size + 2), lambda i: array_to_string(w[i:i + size - 1], ' '))) AS phrase
  FROM pieces, range(1, 6) AS s(size) WHERE len(w) >= size),
f AS (
  SELECT lang, size, phrase, count(*) AS a, string_split(phrase, ' ') AS w FROM windows
  GROUP BY lang, size, phrase HAVING count(*) >= {_FREQUENT}),
cuts AS (
  SELECT lang, size, phrase, a, w, unnest(range(1, size)) AS k FROM f WHERE size > 1),
scored AS (
  SELECT c.lang, c.size, c.phrase, c.a, c.w, c.k, l.a AS l, r.a AS r, n,
    (1000::HUGEINT * c.a * n) // (l.a::HUGEINT * r.a) AS score
  FROM cuts c JOIN totals USING (lang)
    JOIN f l ON l.lang = c.lang AND l.phrase = array_to_string(c.w[1:c.k], ' ')
    JOIN f r ON r.lang = c.lang AND r.phrase = array_to_string(c.w[c.k + 1:], ' ')),
lowest AS (
  SELECT * FROM scored QUALIFY row_number() OVER (PARTITION BY lang, phrase ORDER BY score, k) = 1),
inner_ones AS (
  SELECT lang, phrase, max(a) AS longer FROM (
    SELECT lang, a, unnest(flatten(list_transform(range(2, size), lambda s: list_transform(range(1, size - s + 2),
      lambda i: array_to_string(w[i:i + s - 1], ' '))))) AS phrase FROM f WHERE size > 2)
  GROUP BY lang, phrase)
SELECT lang, rank, phrase, a, l, r, CAST(n AS BIGINT) AS n, CAST(score AS BIGINT) AS score FROM (
  SELECT x.*, row_number() OVER (PARTITION BY x.lang ORDER BY score DESC, a DESC, x.phrase) AS rank
  FROM lowest x LEFT JOIN inner_ones i ON i.lang = x.lang AND i.phrase = x.phrase
  WHERE coalesce(longer < a, true))
WHERE rank <= 2000"""
