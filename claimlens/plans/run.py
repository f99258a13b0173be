"""The whole batch flow as functions: raw feeds -> typed tables -> Parts 1-2
answers -> Part 3 suspicious patients. Paths in, tables and result files out.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession

from claimlens import schemas, sources
from claimlens.operators import charges as ch
from claimlens.plans.part3 import Part3Config, Part3Result, run_part3
from claimlens.plans.questions import run_questions
from claimlens.sinks import write_ranked_list, write_table


@dataclass
class FeedPaths:
    inpatient: str       # quoted CSV (gzip allowed), header line
    outpatient: str      # quoted CSV (gzip allowed), header line
    patients: str        # <rows> blocks of <field name=..> items
    claims: str          # RS/US records; a directory of monthly files
    review: str          # flagged patient ids, first comma field per line


def prepare_tables(spark: SparkSession, feeds: FeedPaths, out_dir: str) -> dict[str, DataFrame]:
    """Prep: parse the four feeds into typed tables (B1), then build the
    union charge table (C1 C2 C6 C7 H1). Returns the stored tables."""
    out = out_dir.rstrip("/")
    parsed = {
        "inpatientdata": sources.read_inpatient(spark, feeds.inpatient),
        "outpatientdata": sources.read_outpatient(spark, feeds.outpatient),
        "patient": sources.read_patients(spark, feeds.patients),
        "patientclaim": sources.read_claims(spark, feeds.claims),
        "review": sources.read_id_list(spark, feeds.review),
    }
    for name, df in parsed.items():
        write_table(df, f"{out}/{name}")
    tables = {name: sources.read_table(spark, f"{out}/{name}") for name in parsed}
    write_table(ch.charge_table(tables["inpatientdata"], tables["outpatientdata"]),
                f"{out}/in_out_patient")
    tables["in_out_patient"] = sources.read_table(spark, f"{out}/in_out_patient", schemas.CHARGES)
    return tables


def run_all(spark: SparkSession, feeds: FeedPaths, out_dir: str,
            cfg: Part3Config | None = None) -> tuple[dict[str, DataFrame], Part3Result]:
    """Prep, the six questions (``<out>/results/part*``), and Part 3
    (``<out>/results/suspicious``: the top patient ids in rank order)."""
    out = out_dir.rstrip("/")
    tables = prepare_tables(spark, feeds, f"{out}/tables")
    charges = tables["in_out_patient"]
    run_questions(charges, f"{out}/results", keep_table=False)
    result = run_part3(tables["patient"], tables["patientclaim"], charges, tables["review"], cfg)
    write_ranked_list(result.suspicious, f"{out}/results/suspicious", "patient_id")
    return tables, result
