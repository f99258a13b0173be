"""Stand-in raw feeds built from the driver's TPC-H-like tables.

The driver data holds no health-insurance tables, so every registered query
runs on stand-ins with the schemas of the real feeds. These builders only
shape rows into those schemas (all strings, as the feeds are); they do none
of the analytics. Each has a DuckDB twin (``*_SQL``) used by the oracle.

Mapping (fixed values of this stand-in, applied to every row):
    procedure code  = l_partkey % 130, four digits; codes 0-99 inpatient (DRG),
                      100-129 outpatient (APC); name "<code> - PROCEDURE <k>"
    provider        = l_suppkey, six digits;  city = nation name;
    state           = first two letters of the region, upper case;
    zipcode         = supplier nation key, five digits;
    referral region = "<state> - <city>"
    charges         = l_quantity (count), l_extendedprice (charged),
                      l_extendedprice * (1 - l_discount) (paid), as text
    patient         = customer: age band c_custkey % 7, gender F/M by parity
                      of c_custkey, income = market segment
    claim           = one per line item: order date (yyyyMMdd), o_custkey,
                      procedure code of the line's part
    review list     = customers with a negative account balance
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

N_CODES = 130
N_INPATIENT_CODES = 100


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    """One of the driver's Parquet tables."""
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


MAX_BROADCAST_ROWS = 2_000_000


def padded(value: Column, width: int) -> Column:
    """``format_string("%0<width>d")`` without a formatter call for each row."""
    return F.when(value.between(0, 10 ** width - 1), F.lpad(value.cast("string"), width, "0")) \
        .otherwise(F.format_string(f"%0{width}d", value))


def code_texts(k: Column, texts: list[str], otherwise: Column) -> Column:
    """``texts[k]``, one array literal looked into instead of a text built for each row;
    ``otherwise`` where ``k`` is no place of it."""
    every = F.split(F.lit("\n".join(texts)), "\n")
    return F.when(k.between(0, len(texts) - 1), F.get(every, k.cast("int"))).otherwise(otherwise)


def _small(spark: SparkSession, sf_dir: str, name: str) -> bool:
    """Whether a driver table has at most MAX_BROADCAST_ROWS rows."""
    return table(spark, sf_dir, name).count() <= MAX_BROADCAST_ROWS


def _charge_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    li = table(spark, sf_dir, "lineitem").select(
        "l_partkey", "l_suppkey", "l_quantity", "l_extendedprice", "l_discount")
    sup = table(spark, sf_dir, "supplier").select("s_suppkey", "s_name", "s_nationkey")
    nat = table(spark, sf_dir, "nation").select("n_nationkey", "n_name", "n_regionkey")
    reg = table(spark, sf_dir, "region").select("r_regionkey", "r_name")
    # nation and region have a fixed size (25 and 5 rows): safe to broadcast.
    # supplier grows with the data: its dimension is broadcast only when the
    # supplier row count (which bounds this inner join) is within the bound.
    dims = sup.join(F.broadcast(nat), sup.s_nationkey == nat.n_nationkey) \
              .join(F.broadcast(reg), nat.n_regionkey == reg.r_regionkey)
    if _small(spark, sf_dir, "supplier"):
        dims = F.broadcast(dims)
    rows = li.join(dims, li.l_suppkey == dims.s_suppkey)
    k = F.col("l_partkey") % N_CODES
    state = F.upper(F.substring("r_name", 1, 2))
    return rows.select(
        k.alias("k"),
        code_texts(k, [f"{c:04d} - PROCEDURE {c}" for c in range(N_CODES)],
                   F.concat(padded(k, 4), F.lit(" - PROCEDURE "), k.cast("string"))).alias("procedure"),
        padded(F.col("l_suppkey"), 6).alias("provider_id"),
        F.col("s_name").alias("provider_name"),
        F.col("n_name").alias("provider_address"),
        F.col("n_name").alias("provider_city"),
        state.alias("provider_state"),
        padded(F.col("s_nationkey"), 5).alias("provider_zipcode"),
        F.concat(state, F.lit(" - "), F.col("n_name")).alias("referral_region"),
        F.col("l_quantity").cast("string").alias("n_text"),
        F.col("l_extendedprice").cast("string").alias("charged_text"),
        (F.col("l_extendedprice") * (1 - F.col("l_discount"))).cast("string").alias("paid_text"),
    )


_PROVIDER = ["provider_id", "provider_name", "provider_address", "provider_city",
             "provider_state", "provider_zipcode", "referral_region"]


def inpatient_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the inpatient feed (schemas.INPATIENT)."""
    r = _charge_rows(spark, sf_dir).where(F.col("k") < N_INPATIENT_CODES)
    return r.select(F.col("procedure").alias("drg"), *_PROVIDER,
                    F.col("n_text").alias("total_discharges"),
                    F.col("charged_text").alias("average_covered_charges"),
                    F.col("paid_text").alias("average_total_payments"))


def outpatient_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the outpatient feed (schemas.OUTPATIENT)."""
    r = _charge_rows(spark, sf_dir).where(F.col("k") >= N_INPATIENT_CODES)
    return r.select(F.col("procedure").alias("apc"), *_PROVIDER,
                    F.col("n_text").alias("outpatient_services"),
                    F.col("charged_text").alias("average_est_submitted_charges"),
                    F.col("paid_text").alias("average_total_payments"))


def patient_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the patient feed (schemas.PATIENT)."""
    c = table(spark, sf_dir, "customer")
    return c.select(
        F.col("c_custkey").cast("string").alias("id"),
        (F.col("c_custkey") % 7).cast("string").alias("age"),
        F.when(F.col("c_custkey") % 2 == 0, F.lit("F")).otherwise(F.lit("M")).alias("gender"),
        F.col("c_mktsegment").alias("income"))


def claim_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the claims feed (schemas.PATIENT_CLAIM), one per line item."""
    o = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    li = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey")
    j = li.join(o, li.l_orderkey == o.o_orderkey)
    code = F.col("l_partkey") % N_CODES
    return j.select(
        F.date_format("o_orderdate", "yyyyMMdd").alias("date"),
        F.col("o_custkey").cast("string").alias("patient_id"),
        code_texts(code, [f"{c:04d}" for c in range(N_CODES)], padded(code, 4)).alias("claim_id"))


def review_feed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of the flagged-patient list (schemas.REVIEW)."""
    c = table(spark, sf_dir, "customer")
    return c.where(F.col("c_acctbal") < 0).select(
        F.col("c_custkey").cast("string").alias("patient_id"))


# ---- DuckDB twins (views of the same stand-ins) ---------------------------

CHARGE_ROWS_SQL = f"""
  charge_rows AS (
    SELECT
      l.l_partkey % {N_CODES} AS k,
      printf('%04d', l.l_partkey % {N_CODES}) || ' - PROCEDURE '
        || CAST(l.l_partkey % {N_CODES} AS VARCHAR) AS procedure_id,
      printf('%06d', l.l_suppkey) AS provider_id,
      n.n_name AS provider_city,
      upper(substr(r.r_name, 1, 2)) AS provider_state,
      printf('%05d', s.s_nationkey) AS provider_zipcode,
      upper(substr(r.r_name, 1, 2)) || ' - ' || n.n_name AS referral_region,
      l.l_quantity AS total_charges,
      l.l_extendedprice AS avg_charged_amount,
      l.l_extendedprice * (1 - l.l_discount) AS avg_total_payment
    FROM lineitem l
    JOIN supplier s ON l.l_suppkey = s.s_suppkey
    JOIN nation n ON s.s_nationkey = n.n_nationkey
    JOIN region r ON n.n_regionkey = r.r_regionkey
  ),
  charges AS (
    SELECT CASE WHEN k < {N_INPATIENT_CODES} THEN 'I' ELSE 'O' END AS type,
           procedure_id, provider_id, provider_city, provider_state, provider_zipcode,
           referral_region, total_charges, avg_charged_amount, avg_total_payment
    FROM charge_rows
  )"""

PATIENT_SQL = """
  patient AS (
    SELECT CAST(c_custkey AS VARCHAR) AS id,
           CAST(c_custkey % 7 AS VARCHAR) AS age,
           CASE WHEN c_custkey % 2 = 0 THEN 'F' ELSE 'M' END AS gender,
           c_mktsegment AS income
    FROM customer
  )"""

CLAIM_SQL = f"""
  patientclaim AS (
    SELECT strftime(o.o_orderdate, '%Y%m%d') AS date,
           CAST(o.o_custkey AS VARCHAR) AS patient_id,
           printf('%04d', l.l_partkey % {N_CODES}) AS claim_id
    FROM lineitem l JOIN orders o ON l.l_orderkey = o.o_orderkey
  )"""

REVIEW_SQL = """
  review AS (
    SELECT CAST(c_custkey AS VARCHAR) AS patient_id FROM customer WHERE c_acctbal < 0
  )"""


def with_sql(*ctes: str) -> str:
    """``WITH`` clause joining the given CTE bodies."""
    return "WITH " + ",".join(ctes)
