"""Registered source/sink queries: each writes a stand-in feed in its raw
format under the shared folder, reads it back with the library's reader,
and must equal the table that was written (A1-A10, B1, B5)."""

from __future__ import annotations

from pyspark.sql import functions as F

from claimlens import schemas, sinks, sources, streaming
from claimlens.operators import charges as ch
from claimlens.operators import classify as cl
from claimlens.plans import standins as si
from claimlens.plans.questions import COLUMNS, run_questions
from claimlens.plans.registry import CH, ORACLE, W, charges_of, register, rounded
from claimlens.plans.run import FeedPaths, prepare_tables
from claimlens.session import scratch_path


@register("claims_roundtrip", W(si.CLAIM_SQL) + "\nSELECT date, patient_id, claim_id FROM patientclaim")
def q_claims_roundtrip(spark, sf_dir):
    """A1 A2 A10: claims written with RS/US separators (several part files),
    read back from the directory."""
    path = scratch_path(spark, "claims-rsus")
    sinks.write_control_delimited(si.claim_feed(spark, sf_dir), path)
    return sources.read_claims(spark, path)


@register("patients_roundtrip", W(si.PATIENT_SQL) + "\nSELECT id, age, gender, income FROM patient")
def q_patients_roundtrip(spark, sf_dir):
    """A3 A4: patients written as ``<rows>`` blocks of named fields, parsed back."""
    path = scratch_path(spark, "patients-xml")
    sinks.write_tagged_xml(si.patient_feed(spark, sf_dir), path)
    return sources.read_patients(spark, path)


@register("charges_csv_roundtrip", W(CH) + """
SELECT type, procedure_id, provider_id, provider_city, provider_state, provider_zipcode,
       referral_region, round(total_charges, 6) AS total_charges,
       round(avg_charged_amount, 6) AS avg_charged_amount,
       round(avg_total_payment, 6) AS avg_total_payment
FROM charges""")
def q_charges_csv_roundtrip(spark, sf_dir):
    """Both charge feeds as quoted, gzip-compressed CSV with a
    header, read back and turned into the typed charge table."""
    ip, op = scratch_path(spark, "inpatient-csv"), scratch_path(spark, "outpatient-csv")
    sinks.write_quoted_csv(si.inpatient_feed(spark, sf_dir), ip)
    sinks.write_quoted_csv(si.outpatient_feed(spark, sf_dir), op)
    return rounded(ch.charge_table(sources.read_inpatient(spark, ip),
                                   sources.read_outpatient(spark, op)))


@register("inpatient_csv_split", W(CH) + """
SELECT procedure_id AS drg, provider_id, provider_city || chr(10) || '"' || provider_state || '", ' || k AS address,
       round(avg_charged_amount, 6) AS charge
FROM charge_rows WHERE k < 100""")
def q_inpatient_csv_split(spark, sf_dir):
    """The inpatient feed as plain CSV with line breaks, quotes and commas
    inside its addresses, read back in splits of its files."""
    path = scratch_path(spark, "inpatient-plain")
    feed = si.inpatient_feed(spark, sf_dir).withColumn("provider_address", F.concat(
        "provider_city", F.lit('\n"'), "provider_state", F.lit('", '), F.substring("drg", 1, 4).cast("int").cast("string")))
    sinks.write_quoted_csv(feed, path, compression=None)
    return rounded(sources.read_inpatient(spark, path).select(
        "drg", "provider_id", F.col("provider_address").alias("address"),
        F.col("average_covered_charges").cast("double").alias("charge")))


@register("review_list_roundtrip", W(si.REVIEW_SQL) + "\nSELECT patient_id FROM review")
def q_review_list_roundtrip(spark, sf_dir):
    """The flagged-patient list as text lines (with a trailing extra
    field), read back as its first comma field."""
    path = scratch_path(spark, "review-list")
    df = si.review_feed(spark, sf_dir).select(
        F.concat("patient_id", F.lit(",flagged")).alias("patient_id"))
    sinks.write_id_list(df, path)
    return sources.read_id_list(spark, path)


@register("stored_table_roundtrip", W(CH) + """,
  top AS (SELECT provider_id, count(*) AS cnt FROM charges GROUP BY provider_id)
SELECT provider_id, cnt FROM top""")
def q_stored_table_roundtrip(spark, sf_dir):
    """B1/B2 + A11: a typed table written as Parquet and scanned back with
    its schema; B3: it replaces an older table (the inpatient rows alone) at
    the same path."""
    path = scratch_path(spark, "charges-table")
    charges = ch.charge_table(si.inpatient_feed(spark, sf_dir), si.outpatient_feed(spark, sf_dir))
    sinks.write_table(charges.where(F.col("type") == "I"), path)
    sinks.write_table(charges, path)
    stored = sources.read_table(spark, path, schemas.CHARGES)
    return stored.groupBy("provider_id").agg(F.count(F.lit(1)).alias("cnt"))


@register("replaced_table", W(CH) + """
SELECT provider_id, type, count(*) AS n, round(max(avg_charged_amount), 6) AS most
FROM charges WHERE type = 'I' GROUP BY provider_id, type""")
def q_replaced_table(spark, sf_dir):
    """B3 in place: the stored charge table is replaced twice by queries that read
    it (the inpatient rows, then a summary per provider) and read back."""
    path = scratch_path(spark, "replaced")
    sinks.write_table(charges_of(spark, sf_dir), path)
    charges = sources.read_table(spark, path, schemas.CHARGES)
    sinks.write_table(charges.where(F.col("type") == "I"), path)
    kept = sources.read_table(spark, path, schemas.CHARGES)
    sinks.write_table(kept.groupBy("provider_id", "type").agg(
        F.count(F.lit(1)).alias("n"), F.max("avg_charged_amount").alias("most")), path)
    return rounded(sources.read_table(spark, path))


def _lines(spark, path: str):
    """A result file's lines with their line numbers (one part file)."""
    return spark.read.text(path).select(
        (F.monotonically_increasing_id() + 1).cast("int").alias("line"), F.col("value"))


@register("ranked_list_roundtrip", W(CH) + """,
  top AS (SELECT provider_id, count(*) AS cnt FROM charges GROUP BY provider_id)
SELECT CAST(row_number() OVER (ORDER BY cnt DESC, provider_id) AS INTEGER) AS line, provider_id AS value
FROM top QUALIFY line <= 20""")
def q_ranked_list_roundtrip(spark, sf_dir):
    """A ranked list (from rows dealt out over tasks) written as one
    header-less file and read back in line order."""
    charges = ch.charge_table(si.inpatient_feed(spark, sf_dir), si.outpatient_feed(spark, sf_dir))
    counts = charges.groupBy("provider_id").agg(F.count(F.lit(1)).alias("cnt"))
    path = scratch_path(spark, "ranked-list")
    sinks.write_ranked_list(cl.top_by_abs(counts, "cnt", "provider_id", 20).repartition(4), path, "provider_id")
    return _lines(spark, path)


@register("question_files", "\nUNION ALL ".join(
    f"SELECT '{name}' AS file, rank AS line, CAST({column} AS VARCHAR) AS value FROM ({ORACLE[name]}) AS {name}"
    for name, column in COLUMNS.items()))
def q_question_files(spark, sf_dir):
    """``run_questions``: the six result files, read back line by line."""
    out = scratch_path(spark, "results")
    run_questions(charges_of(spark, sf_dir), out)
    files = [_lines(spark, f"{out}/{name}").select(F.lit(name).alias("file"), "line", "value") for name in COLUMNS]
    every = files[0]
    for f in files[1:]:
        every = every.unionByName(f)
    return every


@register("top_by_abs", """
SELECT CAST(row_number() OVER (ORDER BY abs(c_acctbal) DESC NULLS LAST,
                                        c_custkey ASC NULLS LAST) AS INTEGER) AS rank,
       c_custkey, round(c_acctbal, 6) AS c_acctbal
FROM customer
QUALIFY rank <= 10""")
def q_top_by_abs(spark, sf_dir):
    """G5 on a numeric column: the 10 largest |c_acctbal|."""
    c = si.table(spark, sf_dir, "customer").select("c_custkey", "c_acctbal")
    return rounded(cl.top_by_abs(c, "c_acctbal", "c_custkey", 10)
                   .select("rank", "c_custkey", "c_acctbal"))


@register("claims_stream_ingest",
          W(si.CLAIM_SQL) + "\nSELECT date, patient_id, claim_id FROM patientclaim")
def q_claims_stream_ingest(spark, sf_dir):
    """A1 A2 via Structured Streaming: claim files ingested incrementally
    (available-now trigger, checkpointed) into a Parquet table."""
    src = scratch_path(spark, "claims-landing")
    sinks.write_control_delimited(si.claim_feed(spark, sf_dir), src)
    out = scratch_path(spark, "claims-ingested")
    streaming.ingest(streaming.stream_claims(spark, src), out).awaitTermination()
    return spark.read.parquet(out)


@register("prep_in_out_patient", W(CH) + """
SELECT type, procedure_id, provider_id, provider_city, provider_state, provider_zipcode,
       referral_region, round(total_charges, 6) AS total_charges,
       round(avg_charged_amount, 6) AS avg_charged_amount,
       round(avg_total_payment, 6) AS avg_total_payment
FROM charges""")
def q_prep_in_out_patient(spark, sf_dir):
    """The prep job: all four feeds (and the review list) written in their
    raw formats, parsed into typed tables, and the charge table built from
    the stored inpatient/outpatient tables."""
    feeds = FeedPaths(*(scratch_path(spark, n) for n in
                        ("in-csv", "out-csv", "patients-xml", "claims-rsus", "review-txt")))
    sinks.write_quoted_csv(si.inpatient_feed(spark, sf_dir), feeds.inpatient)
    sinks.write_quoted_csv(si.outpatient_feed(spark, sf_dir), feeds.outpatient)
    sinks.write_tagged_xml(si.patient_feed(spark, sf_dir), feeds.patients)
    sinks.write_control_delimited(si.claim_feed(spark, sf_dir), feeds.claims)
    sinks.write_id_list(si.review_feed(spark, sf_dir), feeds.review)
    tables = prepare_tables(spark, feeds, scratch_path(spark, "prep"))
    return rounded(tables["in_out_patient"])
