"""The operators of this package as queries over the given tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from landfall.llm import (
    byte_pairs,
    conversations,
    cross_entropy,
    decontamination,
    hard_negatives,
    html_text,
    lattice,
    line_dedup,
    packing,
    passages,
    simhash,
    toxicity,
    url_filter,
)
from landfall.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(function: Query) -> Query:
    QUERIES[function.__name__] = function
    return function


LINE_DEDUP_SQL = f"""
WITH pages AS (
  SELECT row_number() OVER () AS r, doc_id, source, text,
         string_split(text, chr(10)) AS lines
  FROM documents),
keys AS (
  SELECT r, source, unnest(list_distinct(
           [trim(x, chr(32) || chr(9) || chr(13)) for x in lines])) AS line
  FROM pages),
totals AS (SELECT source, count(*) AS n_pages FROM pages GROUP BY source),
often AS (
  SELECT k.source, list(k.line) AS lines FROM (
    SELECT source, line, count(*) AS n FROM keys WHERE line <> '' GROUP BY source, line) k
  JOIN totals t ON k.source IS NOT DISTINCT FROM t.source
  WHERE n >= {line_dedup.LEAST_PAGES} AND n > {line_dedup.RATIO} * n_pages
  GROUP BY k.source),
kept AS (
  SELECT p.*, [x for x in p.lines
           if NOT list_contains(coalesce(o.lines, []), trim(x, chr(32) || chr(9) || chr(13)))] AS left_lines
  FROM pages p LEFT JOIN often o ON p.source IS NOT DISTINCT FROM o.source)
SELECT doc_id, source AS host, coalesce(len(lines), 0) AS n_lines,
       coalesce(len(lines), 0) - coalesce(len(left_lines), 0) AS n_dropped,
       array_to_string(left_lines, chr(10)) AS text
FROM kept
"""
ORACLES["op1_line_dedup"] = LINE_DEDUP_SQL


@query
def op1_line_dedup(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "source", "text")
    cleaned = line_dedup.drop_boilerplate(docs)
    return cleaned.select("doc_id", F.col("source").alias("host"), "n_lines", "n_dropped", "text")


@query
def op2_url_filter(spark: SparkSession, folder: str) -> DataFrame:
    return url_filter.judge(table(spark, folder, "pages", "page_id", "url"))


@query
def op3_substring_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return passages.shared_passages(table(spark, folder, "documents", "doc_id", "text"))


@query
def op4_lm_scoring(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    return cross_entropy.score(docs, table(spark, folder, "labels", "doc_id", "quality"))


@query
def op5_benchmark_decontamination(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    found = decontamination.find_items(docs, table(spark, folder, "benchmark", "item_id", "text"))
    found = found.withColumn("n_hit", decontamination.n_hit())
    return found.select(
        "doc_id",
        "n_words",
        "n_hit",
        F.size("items").cast("long").alias("n_items"),
        F.sha2(F.array_join("items", ","), 256).alias("items_sha256"),
        decontamination.is_contaminated(F.col("n_words"), F.col("n_hit")).alias("contaminated"),
    )


@query
def op6_embedding_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    return lattice.near_vectors(table(spark, folder, "embeddings", "vec_id", "embedding", "label"))


@query
def op7_html_extraction(spark: SparkSession, folder: str) -> DataFrame:
    found = html_text.extract(table(spark, folder, "pages", "page_id", "url", "html"))
    return found.withColumn("n_chars", F.length("text").cast("long"))


@query
def op8_simhash_near_dedup(spark: SparkSession, folder: str) -> DataFrame:
    found = simhash.near_duplicates(table(spark, folder, "documents", "doc_id", "text"))
    return found.select("doc_id", simhash.hex_print().alias("fingerprint"), "component_id")


@query
def op9_toxicity_chain(spark: SparkSession, folder: str) -> DataFrame:
    docs = table(spark, folder, "documents", "doc_id", "text")
    labels = table(spark, folder, "labels", "doc_id", "quality", "toxic")
    return toxicity.score(docs, toxicity.train(docs, labels))


@query
def op10_best_fit_packing(spark: SparkSession, folder: str) -> DataFrame:
    return packing.pack(table(spark, folder, "documents", "doc_id", "text"))


@query
def op11_byte_pair_encoding(spark: SparkSession, folder: str) -> DataFrame:
    return byte_pairs.round_trip(table(spark, folder, "documents", "doc_id", "text"))


@query
def op12_conversation_repair(spark: SparkSession, folder: str) -> DataFrame:
    rows = table(spark, folder, "conversations", "conv_id", "turn", "role", "text")
    return conversations.repair(conversations.damage(rows))


HARD_NEGATIVES_SQL = f"""
WITH whole AS (
  SELECT vec_id,
         CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
         [floor({hard_negatives.SCALE} * x::DOUBLE) FOR x IN embedding] AS vector
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len([1 FOR x IN embedding IF x IS NULL OR NOT isfinite(x)]) = 0),
scores AS (
  SELECT a.vec_id AS anchor_id, r.vec_id, a.label = r.label AS same,
         list_inner_product(a.vector, r.vector)::BIGINT AS score
  FROM whole a JOIN whole r ON a.vec_id <> r.vec_id
  WHERE a.vec_id % {hard_negatives.ANCHOR_EVERY} = 0),
positives AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score
  FROM scores WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id)
          <= {hard_negatives.POSITIVES})
SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score,
       s.score AS negative_score,
       row_number() OVER (
         PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INTEGER AS rank
FROM positives p JOIN scores s ON s.anchor_id = p.anchor_id AND NOT s.same
 AND {hard_negatives.LOWEST} * p.positive_score <= 100 * s.score
 AND 100 * s.score <= {hard_negatives.HIGHEST} * p.positive_score
QUALIFY rank <= {hard_negatives.NEGATIVES}
"""
ORACLES["op13_hard_negatives"] = HARD_NEGATIVES_SQL


@query
def op13_hard_negatives(spark: SparkSession, folder: str) -> DataFrame:
    return hard_negatives.hard_negatives(
        table(spark, folder, "embeddings", "vec_id", "embedding", "label")
    )


@query
def pipeline(spark: SparkSession, folder: str) -> DataFrame:
    import corpus_pipeline

    return corpus_pipeline.run(spark, folder)
