"""Corpus pipeline: quality, near duplicates, decontamination, secrets, packing.

``STAGES`` lists (name, function); each function takes (spark, docs, sf_dir)
and returns a DataFrame. All stages but the last return the columns of
``documents`` for the rows they keep; every stage works on all rows that its
predecessor kept.

* ``quality``   - documents the weak-label classifier rejects go.
* ``dedup``     - one document of each near-duplicate class stays.
* ``decontaminate`` - documents that hold a benchmark item go.
* ``secrets``   - findings are replaced by ``[SECRET]`` in the text, and
  ``n_chars`` is counted again; no document goes.
* ``packing``   - the pieces of the remaining texts and their sequences.

Rows with a null or empty text are rejected by the first stage. Columns that
``documents`` has besides id and text pass through unchanged.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.llm import decontaminate, minhash, packing, quality, secrets
from claimlens.session import scratch_path, scratch_scope


def keep_good(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return docs.where(quality.fit_quality(docs).score("text") >= quality.KEEP_FROM)


def drop_near_duplicates(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.keep_one(docs, minhash.near_duplicate_classes(docs))


def drop_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return decontaminate.drop_contaminated(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    scanner = secrets.fit_scanner(docs)
    out = docs.withColumn("text", scanner.redact(F.col("text")))
    if "n_chars" in docs.columns:
        kind = docs.schema["n_chars"].dataType
        out = out.withColumn("n_chars", F.length("text").cast(kind))
    return out


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.packed(docs)


STAGES = [("quality", keep_good), ("dedup", drop_near_duplicates),
          ("decontaminate", drop_benchmark), ("secrets", redact_secrets), ("packing", pack)]

#: The classifier, the signatures and the tokenizer cannot be stated in SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each result but the last is written to
    the shared folder and read back. The tables a stage wrote for itself are deleted
    once its result is there (the last stage's are read with the result)."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES[:-1]:
        path = scratch_path(spark, f"llm-stage-{name}")
        with scratch_scope(spark):
            stage(spark, docs, sf_dir).write.mode("error").parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
