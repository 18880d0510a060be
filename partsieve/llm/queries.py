"""The queries of the training-data operators over the driver's tables, and their DuckDB SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from partsieve.llm.alignment import align
from partsieve.llm.bpe import Bpe
from partsieve.llm.divergence import divergence
from partsieve.llm.exact_dedup import exact_groups
from partsieve.llm.line_dedup import line_dedup
from partsieve.llm.mixing import mix
from partsieve.llm.ngram_join import ngram_components
from partsieve.llm.packing import pack
from partsieve.llm.paragraph_dedup import paragraph_clusters
from partsieve.llm.quality_model import quality_scores
from partsieve.llm.repetition import quality_rules
from partsieve.llm.suffix_dedup import suffix_dedup
from partsieve.llm.url_rules import judge_urls


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def multilingual_bpe(spark: SparkSession) -> Bpe:
    """The BPE of the public multilingual ranks."""
    import public_tokenizers

    return Bpe(spark, public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN)


def op1_byte_bpe(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Ids of every document and the bytes they decode to, as digests."""
    both = multilingual_bpe(spark).round_trip(_table(spark, sf_dir, "documents"))
    return both.select(
        "doc_id",
        (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"),
        F.sha2("decoded", 256).alias("decoded_sha256"),
    )


def op2_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every document."""
    return quality_scores(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels"))


def op3_paragraph_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Clusters of near-equal paragraphs of all documents, lines and picked ones, and which of them go."""
    return paragraph_clusters(_table(spark, sf_dir, "documents"))


def url_rules(spark: SparkSession) -> DataFrame:
    """The rules that op4 applies: host, path, verdict."""
    rules = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("example.com", "/de/", "block"), ("org", "/fr/", "allow")]
    cells = [F.struct(*(F.lit(x).alias(n) for x, n in zip(rule, ("host", "path", "verdict"), strict=True))) for rule in rules]
    return spark.range(1).select(F.inline(F.array(*cells)))


def op4_url_filters(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rule and verdict of every page."""
    return judge_urls(_table(spark, sf_dir, "pages"), url_rules(spark))


def op5_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Counts, base rule and repetition verdict of every document."""
    return quality_rules(_table(spark, sf_dir, "documents"))


def op6_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Bytes that every document loses to repeated 200-byte strings, and what stays of it as a digest."""
    out = suffix_dedup(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_bytes", "n_removed", "n_spans", F.sha2("kept", 256).alias("kept_sha256"))


def op7_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words that a 5:2:1 mix of 150% takes from each document."""
    return mix(_table(spark, sf_dir, "documents"))


def op8_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups of equal documents and which of them stays."""
    digest = F.sha2("norm", 256).alias("text_sha256")
    return exact_groups(_table(spark, sf_dir, "documents"), carry=[digest])


def op9_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Lines that every document loses, and what stays of it as a digest."""
    out = line_dedup(_table(spark, sf_dir, "documents"))
    return out.select("doc_id", "n_lines", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


def op10_ngram_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Components of documents whose 4-word shingles reach a Jaccard similarity of 0.85."""
    return ngram_components(_table(spark, sf_dir, "documents"))


def op11_tokenizer_alignment(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Groups and links between the tokens of two tokenizers, the groups as digests."""
    import public_tokenizers

    digest = F.when(F.col("n_a") == 0, "").otherwise(F.sha2("groups", 256)).alias("groups_sha256")
    files = (public_tokenizers.path(name) for name in ("byte_bpe_50k.json", "piece_bpe_32k.model"))
    return align(_table(spark, sf_dir, "documents"), *files, carry=[digest])


def op12_divergence_audit(spark: SparkSession, sf_dir: str) -> DataFrame:
    """How far each source is from every other of its language, and the terms it has more of than its language."""
    return divergence(_table(spark, sf_dir, "documents"))


def op13_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Pieces of all documents in sequences of 1024 tokens, their ids as digests."""
    import public_tokenizers

    pieces = pack(_table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return pieces.select("doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset")


OP4_SQL = """
WITH u AS (
  SELECT page_id, CASE WHEN strpos(coalesce(url, ''), '://') > 0 THEN substr(url, strpos(url, '://') + 3) ELSE '' END AS rest FROM pages
), p AS (
  SELECT page_id,
         translate(regexp_extract(rest, '^([^/?#]*)', 1), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS host,
         regexp_extract(rest, '^[^/?#]*([^?#]*)', 1) AS path
  FROM u
), r(rhost, rpath, rverdict) AS (
  VALUES ('net', '/', 'block'), ('example.net', '/en/', 'allow'), ('example.com', '/de/', 'block'), ('org', '/fr/', 'allow')
), m AS (
  SELECT page_id, rhost || rpath AS rule, rverdict,
         row_number() OVER (PARTITION BY page_id ORDER BY length(rhost || rpath) DESC, length(rhost) DESC) AS n
  FROM p JOIN r ON (host = rhost OR ends_with(host, '.' || rhost)) AND starts_with(path, rpath)
)
SELECT p.page_id, host, path, rule, coalesce(rverdict, 'allow') AS verdict
FROM p LEFT JOIN m ON p.page_id = m.page_id AND m.n = 1
"""

OP8_SQL = """
WITH d AS (
  SELECT doc_id, translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm
  FROM documents
)
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY norm) AS keep_id,
       count(*) OVER (PARTITION BY norm) AS group_size,
       doc_id = max(doc_id) OVER (PARTITION BY norm) AS kept,
       sha256(norm) AS text_sha256
FROM d
"""

OP9_SQL = r"""
WITH l AS (
  SELECT doc_id, generate_subscripts(a, 1) - 1 AS i, unnest(a) AS line
  FROM (SELECT doc_id, string_split(coalesce(text, ''), chr(10)) AS a FROM documents)
), w AS (
  SELECT doc_id, i, line || chr(10) || lead(line, 1) OVER d || chr(10) || lead(line, 2) OVER d AS three
  FROM l WINDOW d AS (PARTITION BY doc_id ORDER BY i)
), later AS (
  SELECT doc_id, i FROM (
    SELECT doc_id, i, row_number() OVER (PARTITION BY three ORDER BY doc_id, i) AS n
    FROM w WHERE three IS NOT NULL AND regexp_matches(three, '[^\x20\x09-\x0D]'))
  WHERE n > 1
), gone AS (
  SELECT DISTINCT doc_id, i + k AS i FROM later, (VALUES (0), (1), (2)) AS t(k)
)
SELECT l.doc_id, count(*) AS n_lines, count(gone.i) AS n_removed,
       sha256(coalesce(string_agg(CASE WHEN gone.i IS NULL THEN l.line END, chr(10) ORDER BY l.i), '')) AS kept_sha256
FROM l LEFT JOIN gone ON l.doc_id = gone.doc_id AND l.i = gone.i
GROUP BY l.doc_id
"""

OP12_SQL = r"""
WITH d AS (
  SELECT coalesce(lang, '') AS lang, coalesce(source, '') AS source, row_number() OVER () AS r,
         translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS norm FROM documents
), w AS (
  SELECT lang, source, r, unnest(regexp_extract_all(norm, '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term FROM d
), c AS (
  SELECT lang, source, term, count(*) AS n, count(DISTINCT r) AS docs FROM w GROUP BY ALL
), k AS (
  SELECT lang, term, sum(n)::HUGEINT AS n FROM c GROUP BY ALL HAVING sum(docs) >= 10
), l AS (
  SELECT d.lang, count(k.term) AS v, coalesce(sum(k.n), 0)::HUGEINT AS total FROM (SELECT DISTINCT lang FROM d) d LEFT JOIN k ON k.lang = d.lang GROUP BY 1
), g AS (
  SELECT lang, source, coalesce(sum(n), 0)::HUGEINT AS total
  FROM (SELECT DISTINCT lang, source FROM d) LEFT JOIN (SELECT c.* FROM c SEMI JOIN k ON c.lang = k.lang AND c.term = k.term) c USING (lang, source) GROUP BY ALL
), p AS (
  SELECT g.lang, g.source, k.term, coalesce(c.n, 0) AS n,
         1 + (1000000000::HUGEINT * (coalesce(c.n, 0) + 2)) // (g.total + 2 * l.v) AS p,
         1 + (1000000000::HUGEINT * (k.n + 2)) // (l.total + 2 * l.v) AS q
  FROM g JOIN l ON g.lang = l.lang JOIN k ON k.lang = g.lang LEFT JOIN c ON c.lang = g.lang AND c.source = g.source AND c.term = k.term
), s AS (
  SELECT a.lang, a.source, b.source AS item, sum((a.p - b.p) * (a.p - b.p) // (a.p + b.p)) AS value
  FROM p a JOIN p b ON a.lang = b.lang AND a.term = b.term AND a.source <> b.source GROUP BY ALL
), o AS (
  SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(s.value, 0) AS value
  FROM g a JOIN g b ON a.lang = b.lang AND a.source <> b.source LEFT JOIN s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
  UNION ALL SELECT lang, source, 'term', term, (p - q) * (p - q) // (p + q) FROM p WHERE n > 0 AND p > q
), x AS (
  SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, item) AS place FROM o
)
SELECT lang, source, part, item, value::BIGINT AS value, place::INT AS rank FROM x WHERE part = 'pair' OR place <= 10
"""

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "op1_byte_bpe": op1_byte_bpe,
    "op2_quality_classifier": op2_quality_classifier,
    "op3_paragraph_dedup": op3_paragraph_dedup,
    "op4_url_filters": op4_url_filters,
    "op5_quality_rules": op5_quality_rules,
    "op6_suffix_dedup": op6_suffix_dedup,
    "op7_mixing": op7_mixing,
    "op8_exact_dedup": op8_exact_dedup,
    "op9_line_dedup": op9_line_dedup,
    "op10_ngram_join": op10_ngram_join,
    "op11_tokenizer_alignment": op11_tokenizer_alignment,
    "op12_divergence_audit": op12_divergence_audit,
    "op13_packing": op13_packing,
}

ORACLES: dict[str, str] = {
    "op4_url_filters": OP4_SQL,
    "op8_exact_dedup": OP8_SQL,
    "op9_line_dedup": OP9_SQL,
    "op12_divergence_audit": OP12_SQL,
}
