"""Registered queries of the training-data operators.

``QUERIES`` maps each name to a ``(spark, sf_dir) -> DataFrame`` callable
that applies one operator, with production parameters, to its whole table.
``ORACLE`` holds DuckDB SQL for those that SQL can express.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

import corpus_pipeline
from claimlens.llm import (
    conversations, conversations_sql, curriculum, curriculum_sql, decontaminate, decontaminate_sql, html_extract,
    merkle, merkle_sql, minhash, packing, quality, secrets, token_count, toxicity, vector_join, warc)

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLE: dict[str, str] = {}


def query(f):
    QUERIES[f.__name__] = f
    return f


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


@query
def op8_minhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One row per document id: its near-duplicate class (smallest id) and
    whether it is the one that stays."""
    docs = table(spark, sf_dir, "documents")
    return minhash.near_duplicate_classes(docs).withColumn(
        "kept", F.col("doc_id") == F.col("class_id"))


@query
def op9_quality_weak_labels(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's quality score and whether it is kept."""
    docs = table(spark, sf_dir, "documents")
    model = quality.fit_quality(docs)
    return docs.select("doc_id", model.score("text").alias("score")).withColumn(
        "kept", F.col("score") >= quality.KEEP_FROM)


@query
def op3_template_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the benchmark items found in it."""
    return decontaminate.report(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


ORACLE["op3_template_decontamination"] = decontaminate_sql.SQL


@query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's secret spans: base patterns and the network's."""
    docs = table(spark, sf_dir, "documents")
    scanner = secrets.fit_scanner(docs)
    return docs.select("doc_id", scanner.scan(F.coalesce(F.col("text"), F.lit(""))).alias("s")) \
        .select("doc_id", "s.*")


@query
def op5_spfhp_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every piece of every document and its place in a sequence."""
    return packing.packed(table(spark, sf_dir, "documents"))


@query
def op10_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's bytes and tokens."""
    return token_count.token_counts(table(spark, sf_dir, "documents"))


@query
def pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The corpus pipeline: pieces of the documents that all stages keep."""
    return corpus_pipeline.run(spark, sf_dir)


@query
def op2_toxicity_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's toxicity score, prediction and number of offending
    sentences."""
    return toxicity.score_documents(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))


@query
def op7_html_min_cut(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's main text."""
    return html_extract.extract_pages(table(spark, sf_dir, "pages"))


@query
def op6_epsilon_grid_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every vector's number of links at cosine 0.9 and its component."""
    return vector_join.linked_vectors(table(spark, sf_dir, "embeddings"))


ORACLE["op6_epsilon_grid_join"] = """
WITH RECURSIVE v AS (
    SELECT vec_id, CAST(embedding AS DOUBLE[]) AS e FROM embeddings
    WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
      AND len(list_filter(embedding, lambda x: x <> 0)) > 0),
link AS (
    SELECT a.vec_id AS x, b.vec_id AS y FROM v a, v b
    WHERE a.vec_id <> b.vec_id AND list_cosine_similarity(a.e, b.e) >= 0.9),
reach(x, y) AS (
    SELECT vec_id, vec_id FROM embeddings
    UNION SELECT r.x, l.y FROM reach r JOIN link l ON r.y = l.x),
part AS (SELECT x AS vec_id, min(y) AS component_id FROM reach GROUP BY x),
degree AS (SELECT x AS vec_id, count(*) AS n FROM link GROUP BY x)
SELECT vec_id, coalesce(n, 0) AS n_links, component_id, vec_id = component_id AS kept
FROM part LEFT JOIN degree USING (vec_id)
"""


@query
def op1_warc_boundary_chain(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every page's record, read back from the archives written of all pages."""
    return warc.archived_pages(table(spark, sf_dir, "pages")).drop("url")


ORACLE["op1_warc_boundary_chain"] = """
WITH p AS (
    SELECT page_id, coalesce(html, '') AS body, strlen(coalesce(html, '')) AS payload_bytes,
           sha256(coalesce(html, '')) AS payload_digest FROM pages),
g AS (SELECT payload_digest, min(page_id) AS first_page FROM p WHERE payload_bytes >= 100
      GROUP BY payload_digest)
SELECT page_id, payload_bytes, payload_digest,
       CASE WHEN first_page <> page_id THEN 'revisit' ELSE 'response' END AS record_type,
       CASE WHEN first_page <> page_id THEN first_page END AS refers_to
FROM p LEFT JOIN g USING (payload_digest)
"""


@query
def op11_curriculum_mix(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's words in the mix and the progress at which it is first
    taken."""
    return curriculum.report(table(spark, sf_dir, "documents"))


ORACLE["op11_curriculum_mix"] = curriculum_sql.SQL


@query
def op13_merkle_manifest(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's leaf, proof and the root folded from it."""
    return merkle.report(table(spark, sf_dir, "documents"))


ORACLE["op13_merkle_manifest"] = merkle_sql.SQL


@query
def op12_conversation_repair(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every conversation's faults after damage and its cheapest repair."""
    return conversations.report(table(spark, sf_dir, "conversations"))


ORACLE["op12_conversation_repair"] = conversations_sql.SQL
