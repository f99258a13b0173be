"""Incremental ingest of the raw feeds with Structured Streaming.

The source system has no streaming: its prep step reads whole directories.
Here the same readers run on ``readStream`` so new feed files are parsed as
they land. The parse step is the batch code (``sources.parse_*``), the sink
is Parquet, and the checkpoint lives with the table, so a restarted or
failed query resumes exactly where it stopped (each file ingested once).
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from claimlens import schemas, sources


def stream_claims(spark: SparkSession, path: str, max_files_per_trigger: int | None = None,
                  record_sep: str = sources.RECORD_SEPARATOR,
                  field_sep: str = sources.FIELD_SEPARATOR) -> DataFrame:
    """A1 + A2 as a stream over new files in ``path``."""
    reader = spark.readStream.option("lineSep", record_sep)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return sources.parse_control_delimited(reader.text(path), schemas.PATIENT_CLAIM, field_sep)


def stream_patients(spark: SparkSession, path: str,
                    max_files_per_trigger: int | None = None) -> DataFrame:
    """A3 + A4 as a stream over new XML files in ``path``."""
    reader = spark.readStream.option("lineSep", sources.PATIENT_BLOCK_START)
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    blocks = sources.blocks_of(reader.text(path))
    return blocks.select(*sources.parse_named_fields("block"))


def ingest(stream: DataFrame, out_path: str, checkpoint: str | None = None,
           available_now: bool = True) -> StreamingQuery:
    """Append a parsed stream to a Parquet table.

    ``available_now`` processes every file present and stops (a scheduled
    batch that only reads new files); otherwise the query keeps running. The
    checkpoint belongs to the table: unless given, it is a fixed folder inside
    ``out_path`` that table readers skip, so a later call resumes.
    """
    checkpoint = checkpoint or f"{out_path.rstrip('/')}/_ingest_checkpoint"
    writer = (stream.writeStream.format("parquet").outputMode("append")
              .option("checkpointLocation", checkpoint))
    writer = writer.trigger(availableNow=True) if available_now \
        else writer.trigger(processingTime="1 minute")
    return writer.start(out_path)


def stream_quoted_csv(spark: SparkSession, path: str, schema, header: bool = True,
                      max_files_per_trigger: int | None = None) -> DataFrame:
    """A5 as a stream: new quoted CSV files (multi-line fields, gzip)."""
    reader = (spark.readStream.schema(schema).option("header", header)
              .option("multiLine", True).option("quote", '"').option("escape", '"'))
    if max_files_per_trigger:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    return reader.csv(path)


def stream_charges(spark: SparkSession, inpatient_path: str, outpatient_path: str,
                   max_files_per_trigger: int | None = None) -> DataFrame:
    """The typed charge table over newly landed inpatient/outpatient files:
    the batch ``charge_table`` applied to the union of two file streams."""
    from claimlens.operators.charges import charge_table
    return charge_table(
        stream_quoted_csv(spark, inpatient_path, schemas.INPATIENT,
                          max_files_per_trigger=max_files_per_trigger),
        stream_quoted_csv(spark, outpatient_path, schemas.OUTPATIENT,
                          max_files_per_trigger=max_files_per_trigger))
