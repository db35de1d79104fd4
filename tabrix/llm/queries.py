"""Queries of the subpackage and their DuckDB twins (where SQL can express them)."""

from __future__ import annotations

from collections.abc import Callable

import corpus_pipeline
import public_tokenizers
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def _query(name: str, sql: str | None = None):
    def register(fn):
        QUERIES[name] = fn
        if sql:
            ORACLES[name] = sql
        return fn
    return register


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


@_query("op1_token_counts")
def op1(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Token counts of every whole text by word_bpe_49k.json."""
    from tabrix.llm.token_count import count_tokens
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return count_tokens(docs, public_tokenizers.path("word_bpe_49k.json")).drop("text")


@_query("op2_bpe_round_trip")
def op2(spark: SparkSession, sf_dir: str) -> DataFrame:
    """BPE ids and decoded text of every whole text by byte_bpe_50k.json, as digests."""
    from tabrix.llm.bpe import encode_documents
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text")
    return encode_documents(docs, public_tokenizers.path("byte_bpe_50k.json")).drop("text")


_OP3_SQL = """
WITH p AS (
  SELECT page_id, coalesce(html, '') AS html, strlen(coalesce(html, '')) AS payload_bytes,
         sha256(coalesce(html, '')) AS payload_digest
  FROM pages),
f AS (SELECT payload_digest, min(page_id) AS first_id FROM p
      WHERE payload_bytes >= 100 GROUP BY payload_digest)
SELECT p.page_id, p.payload_bytes, p.payload_digest,
       CASE WHEN f.first_id < p.page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN f.first_id < p.page_id THEN f.first_id END AS refers_to
FROM p LEFT JOIN f USING (payload_digest)
"""


@_query("op3_warc_round_trip", _OP3_SQL)
def op3(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page written to WARC archives and read back."""
    from tabrix.llm.warc import round_trip
    return round_trip(_table(spark, sf_dir, "pages"))


@_query("op8_simhash_components")
def op8(spark: SparkSession, sf_dir: str) -> DataFrame:
    """SimHash fingerprints (3-word shingles) linked at two or fewer bits."""
    from tabrix.llm.simhash import simhash_components
    return simhash_components(_table(spark, sf_dir, "documents"), shingle=3, max_bits=2)


@_query("op7_quality_scores")
def op7(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Quality score of every whole text; rows with crc32(doc_id) mod 3 = 1 are held out."""
    from tabrix.llm.quality_fm import classify, in_training
    docs = _table(spark, sf_dir, "documents").select("doc_id", "text", "n_chars")
    scored = classify(docs, _table(spark, sf_dir, "labels"))
    return scored.select("doc_id", F.coalesce(~in_training(), F.lit(False)).alias("held_out"),
                         "score", "predicted")


@_query("op9_personal_data")
def op9(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Personal data spans (base patterns and those the field adds) of every whole text."""
    from tabrix.llm.pii_semicrf import find_pii
    return find_pii(_table(spark, sf_dir, "documents").select("doc_id", "text")).drop("text")


@_query("op4_benchmark_leaks")
def op4(spark: SparkSession, sf_dir: str) -> DataFrame:
    """(document, benchmark item) pairs where a passage leaks the item."""
    from tabrix.llm.decontamination import leaks
    return leaks(_table(spark, sf_dir, "documents"), _table(spark, sf_dir, "benchmark"))


_OP10_SQL = """
WITH lines AS (
  SELECT doc_id, unnest(range(len(l))) AS line_no, unnest(l) AS line
  FROM (SELECT doc_id, string_split(text, chr(10)) AS l FROM documents WHERE text IS NOT NULL)),
s AS (
  SELECT doc_id, line_no, list_sort(list_distinct(list_filter(
           string_split_regex(line, '[\\x20\\x09-\\x0D]+'), lambda w: w <> ''))) AS ws
  FROM lines),
d AS (SELECT ws, len(ws) AS n, min((doc_id, line_no)) AS place, row_number() OVER () AS id
      FROM s WHERE len(ws) > 0 GROUP BY ws),
w AS (SELECT id, n, place, unnest(ws) AS word FROM d),
c AS (SELECT word, count(*) AS f FROM w GROUP BY word),
p AS (SELECT id, n, place, word, row_number() OVER (PARTITION BY id ORDER BY f, word) AS i
      FROM w JOIN c USING (word)),
q AS (SELECT * FROM p WHERE i <= n - CAST(ceil(0.8 * n - 1e-9) AS BIGINT) + 1),
pairs AS (SELECT DISTINCT a.id AS x, b.id AS y FROM q a JOIN q b USING (word)
          WHERE b.place < a.place AND least(a.n, b.n) >= 0.8 * greatest(a.n, b.n) - 1e-9),
gone AS (SELECT DISTINCT x FROM pairs JOIN d a ON a.id = x JOIN d b ON b.id = y
         WHERE len(list_intersect(a.ws, b.ws))
               >= 0.8 * (a.n + b.n - len(list_intersect(a.ws, b.ws))) - 1e-9)
SELECT s.doc_id, CAST(s.line_no AS INTEGER) AS line_no,
       len(s.ws) > 0 AND (gone.x IS NOT NULL OR d.place <> (s.doc_id, s.line_no)) AS removed
FROM s LEFT JOIN d USING (ws) LEFT JOIN gone ON gone.x = d.id
"""


@_query("op10_line_dedup", _OP10_SQL)
def op10(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Whether an earlier line with Jaccard similarity of 0.8 removes it, for every line."""
    from tabrix.llm.line_dedup import removed_lines
    return removed_lines(_table(spark, sf_dir, "documents"))


_query("pipeline", corpus_pipeline.ORACLE_SQL)(corpus_pipeline.run)


@_query("op6_substring_dedup")
def op6(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Words removed from every document by 20-word windows that start earlier elsewhere."""
    from tabrix.llm.substring_dedup import removed_words
    return removed_words(_table(spark, sf_dir, "documents"), window=20)


_OP5_SQL = """
WITH RECURSIVE v AS (
  SELECT vec_id, label, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
  WHERE label IS NOT NULL AND len(embedding) > 0
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
l AS (
  SELECT a.vec_id AS x, b.vec_id AS y FROM v a JOIN v b ON a.label = b.label
  WHERE a.vec_id <> b.vec_id AND len(a.e) = len(b.e) AND list_cosine_similarity(a.e, b.e) >= 0.93),
r(x, y) AS (SELECT vec_id, vec_id FROM embeddings UNION SELECT r.x, l.y FROM r JOIN l ON r.y = l.x),
c AS (SELECT x, min(y) AS component_id FROM r GROUP BY x),
n AS (SELECT x, count(*) AS n_links FROM l GROUP BY x)
SELECT vec_id, CAST(coalesce(n_links, 0) AS BIGINT) AS n_links, component_id,
       vec_id = component_id AS kept
FROM embeddings JOIN c ON c.x = vec_id LEFT JOIN n ON n.x = vec_id
"""


@_query("op5_lattice_near_dedup", _OP5_SQL)
def op5(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Links at cosine >= 0.93 within a label, their components and what is kept."""
    from tabrix.llm.lattice_dedup import near_duplicates
    return near_duplicates(_table(spark, sf_dir, "embeddings"), cosine=0.93)


_OP11_SQL = """
WITH v AS (
  SELECT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         list_transform(embedding, lambda x: floor(256 * CAST(x AS DOUBLE))) AS q
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (
  SELECT a.vec_id AS anchor_id, b.vec_id AS id, a.label = b.label AS alike,
         CAST(list_inner_product(a.q, b.q) AS BIGINT) AS score
  FROM v a JOIN v b ON a.vec_id <> b.vec_id AND len(a.q) = len(b.q)
  WHERE a.vec_id % 50 = 0),
p AS (
  SELECT anchor_id, id AS positive_id, score AS positive_score
  FROM (SELECT *, row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, id) AS i
        FROM s WHERE alike) WHERE i <= 5),
n AS (
  SELECT p.anchor_id, positive_id, positive_score, s.id AS negative_id, s.score AS negative_score,
         row_number() OVER (PARTITION BY p.anchor_id, positive_id ORDER BY s.score DESC, s.id) AS i
  FROM p JOIN s ON s.anchor_id = p.anchor_id AND NOT alike
    AND 50 * positive_score <= 100 * s.score AND 100 * s.score <= 95 * positive_score)
SELECT anchor_id, positive_id, CAST(i AS INTEGER) AS rank, negative_id, positive_score,
       negative_score
FROM n WHERE i <= 3
"""


@_query("op11_hard_negatives", _OP11_SQL)
def op11(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hard negatives of every 50th vector for each of its five nearest of the same label."""
    from tabrix.llm.hard_negatives import hard_negatives
    label = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives(_table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0,
                          label=label)


@_query("op12_spelling_variants")
def op12(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Spelling variants among all words of the texts: every 97th run (by its crc32 with the
    document's id) has lost a letter."""
    from tabrix.llm.spelling import spelling_forms, word_counts

    def variant(doc: Column, run: Column) -> Column:
        h = F.crc32(F.concat(doc.cast("string"), F.lit(":"), run))
        at = (h % F.length(run)).cast("int")
        short = F.concat(F.substring(run, F.lit(1), at), F.substring(run, at + 2, F.length(run)))
        return F.when(h % 97 == 0, short)

    return spelling_forms(word_counts(_table(spark, sf_dir, "documents"), variant=variant))


@_query("op13_main_text")
def op13(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Main text of every web page by two-pass block rules."""
    from tabrix.llm.html_extract import extract_pages
    return extract_pages(_table(spark, sf_dir, "pages"))
