"""Registered queries: name -> (Spark callable, DuckDB oracle SQL or None).

Every callable takes ``(spark, sf_dir)``, reads the driver's tables through
the stand-in feeds (``plans.standins``) and runs the library's operators on
the whole tables. Doubles are rounded to 6 places on both sides, every top-k
carries a ``rank`` so the order is part of the checked values, and every
column is aliased identically in Spark and SQL.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.operators import charges as ch
from claimlens.plans import standins as si

QueryFn = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, QueryFn] = {}
ORACLE: dict[str, str] = {}


def register(name: str, sql: str | None = None):
    """Register a query callable under ``name``, with its oracle SQL."""
    def deco(fn: QueryFn) -> QueryFn:
        QUERIES[name] = fn
        if sql is not None:
            ORACLE[name] = sql.strip()
        return fn
    return deco


def rounded(df: DataFrame, places: int = 6) -> DataFrame:
    """Round every double column (the oracle does the same); ``+ 0.0``
    turns a negative zero into a positive one, as on the oracle side."""
    return df.select(*[
        (F.round(F.col(f.name), places) + F.lit(0.0)).alias(f.name)
        if isinstance(f.dataType, (T.DoubleType, T.FloatType)) else F.col(f.name)
        for f in df.schema.fields])


def charges_of(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The typed charge table built from the stand-in feeds."""
    return ch.charge_table(si.inpatient_feed(spark, sf_dir), si.outpatient_feed(spark, sf_dir))


W = si.with_sql
CH = si.CHARGE_ROWS_SQL


def _rank_sql(order: str) -> str:
    return f"CAST(row_number() OVER (ORDER BY {order}) AS INTEGER)"


# ---------------------------------------------------------------- charges --

@register("charge_table", W(CH) + """
SELECT type, procedure_id, provider_id, provider_city, provider_state, provider_zipcode,
       referral_region, round(total_charges, 6) AS total_charges,
       round(avg_charged_amount, 6) AS avg_charged_amount,
       round(avg_total_payment, 6) AS avg_total_payment
FROM charges""")
def q_charge_table(spark, sf_dir):
    """The typed charge table from both feeds."""
    return rounded(charges_of(spark, sf_dir))


def _part1a_sql(stddev: str) -> str:
    return W(CH, f"""
  rv AS (SELECT procedure_id,
                power({stddev}(avg_charged_amount) / nullif(avg(avg_charged_amount), 0), 2) AS rv
         FROM charges GROUP BY procedure_id),
  ranked AS (SELECT procedure_id, rv,
                    {_rank_sql('rv DESC NULLS LAST, procedure_id ASC NULLS LAST')} AS rank
             FROM rv)""") + """
SELECT rank, regexp_replace(procedure_id, ' .*', '') AS procedure, round(rv, 6) AS rv
FROM ranked WHERE rank <= 3"""


@register("part1a", _part1a_sql("stddev_pop"))
def q_part1a(spark, sf_dir):
    """Part 1a: top 3 procedures by relative variance (population sd)."""
    return rounded(ch.relative_variance(charges_of(spark, sf_dir), 3, ddof=0))


@register("part1a_sample", _part1a_sql("stddev_samp"))
def q_part1a_sample(spark, sf_dir):
    """Part 1a, second implementation's form: sample sd."""
    return rounded(ch.relative_variance(charges_of(spark, sf_dir), 3, ddof=1))


def _provider_wins_sql(value: str) -> str:
    return f"""
  rows_ AS (SELECT procedure_id, TRY_CAST(trim(provider_id) AS BIGINT) AS provider_id,
                   {value} AS value FROM charges),
  best AS (SELECT procedure_id, provider_id,
                  row_number() OVER (PARTITION BY procedure_id
                                     ORDER BY value DESC NULLS LAST,
                                              provider_id ASC NULLS LAST) AS rn
           FROM rows_),
  wins AS (SELECT provider_id, count(*) AS cnt FROM best WHERE rn = 1 GROUP BY provider_id)"""


def _part1_provider_sql(value: str) -> str:
    return W(CH, _provider_wins_sql(value), f"""
  ranked AS (SELECT provider_id, cnt,
                    {_rank_sql('cnt DESC, provider_id ASC NULLS LAST')} AS rank FROM wins)""") + """
SELECT rank, provider_id, cnt FROM ranked WHERE rank <= 3"""


@register("part1b", _part1_provider_sql("avg_charged_amount"))
def q_part1b(spark, sf_dir):
    """Part 1b: providers most often charging the most for a procedure."""
    return ch.most_top_charges(charges_of(spark, sf_dir), 3)


@register("part1d", _part1_provider_sql("avg_charged_amount - avg_total_payment"))
def q_part1d(spark, sf_dir):
    """Part 1d: providers most often with the largest charge-payment gap."""
    return ch.most_top_gaps(charges_of(spark, sf_dir), 3)


_REGION_WINS_SQL = """
  wm AS (SELECT procedure_id, referral_region,
                sum(total_charges * avg_charged_amount) / nullif(sum(total_charges), 0) AS value
         FROM charges GROUP BY procedure_id, referral_region),
  best AS (SELECT procedure_id, referral_region,
                  row_number() OVER (PARTITION BY procedure_id
                                     ORDER BY value DESC NULLS LAST,
                                              referral_region ASC NULLS LAST) AS rn
           FROM wm),
  wins AS (SELECT referral_region, count(*) AS cnt FROM best WHERE rn = 1
           GROUP BY referral_region)"""


@register("part1c", W(CH, _REGION_WINS_SQL, f"""
  ranked AS (SELECT referral_region, cnt,
                    {_rank_sql('cnt DESC, referral_region ASC NULLS LAST')} AS rank FROM wins)""")
          + """
SELECT rank, regexp_replace(referral_region, '(..) - (.*)', '\\2,\\1') AS region, cnt
FROM ranked WHERE rank <= 3""")
def q_part1c(spark, sf_dir):
    """Part 1c: regions most often highest by weighted mean charge."""
    return ch.most_top_regions(charges_of(spark, sf_dir), 3)


def _z_sql(stddev: str) -> str:
    return f"""
  stats AS (SELECT procedure_id, avg(avg_charged_amount) AS m, {stddev}(avg_charged_amount) AS s
            FROM charges GROUP BY procedure_id),
  z AS (SELECT c.provider_id AS provider_text, c.referral_region, c.type,
               (c.avg_charged_amount - s.m) / nullif(s.s, 0) AS z
        FROM charges c JOIN stats s ON c.procedure_id = s.procedure_id)"""


@register("part2a", W(CH, _z_sql("stddev_pop"), f"""
  g AS (SELECT TRY_CAST(trim(provider_text) AS INTEGER) AS provider_id, type,
               stddev_pop(z) AS sd_z FROM z GROUP BY 1, 2),
  ranked AS (SELECT *, {_rank_sql('sd_z DESC NULLS LAST, provider_id ASC NULLS LAST, type')} AS rank
             FROM g)""") + """
SELECT rank, provider_id, type, round(sd_z, 6) AS sd_z FROM ranked WHERE rank <= 3""")
def q_part2a(spark, sf_dir):
    """Part 2a: (provider, type) with the widest spread of z-scores."""
    return rounded(ch.provider_dispersion(charges_of(spark, sf_dir), 3))


@register("part2b", W(CH, _z_sql("stddev_pop"), f"""
  g AS (SELECT referral_region, type, stddev_pop(z) AS sd_z FROM z GROUP BY 1, 2),
  ranked AS (SELECT *,
                    {_rank_sql('sd_z DESC NULLS LAST, referral_region ASC NULLS LAST, type')} AS rank
             FROM g)""") + """
SELECT rank, regexp_replace(referral_region, '^(..) - (.*)$', '\\2,\\1') AS region, type,
       round(sd_z, 6) AS sd_z
FROM ranked WHERE rank <= 3""")
def q_part2b(spark, sf_dir):
    """Part 2b: (region, type) with the widest spread of z-scores."""
    return rounded(ch.region_dispersion(charges_of(spark, sf_dir), 3))


@register("part2_provider_stats_sample", W(CH, _z_sql("stddev_samp")) + """
SELECT TRY_CAST(trim(provider_text) AS INTEGER) AS provider_id, type, count(*) AS count,
       round(stddev_samp(z), 6) AS sd_z, round(var_samp(z), 6) AS var_z
FROM z GROUP BY 1, 2""")
def q_part2_provider_stats_sample(spark, sf_dir):
    """Count, sample sd and variance of z for every (provider, type)."""
    return rounded(ch.dispersion_stats(charges_of(spark, sf_dir), ["provider_id", "type"], 1))


@register("part2_region_stats_sample", W(CH, _z_sql("stddev_samp")) + """
SELECT referral_region, type, count(*) AS count,
       round(stddev_samp(z), 6) AS sd_z, round(var_samp(z), 6) AS var_z
FROM z GROUP BY 1, 2""")
def q_part2_region_stats_sample(spark, sf_dir):
    """Count, sample sd and variance of z for every (region, type)."""
    return rounded(ch.dispersion_stats(charges_of(spark, sf_dir), ["referral_region", "type"], 1))


# ------------------------------------------------------------ ranked curves --

def _curve_sql(source: str, key: str, value: str, n_labels: int) -> str:
    return f"""
  curve AS (SELECT {key} AS key, {value} AS value,
                   row_number() OVER (ORDER BY {value} DESC NULLS LAST, {key} ASC NULLS LAST)
                     AS position
            FROM {source})
SELECT position, round(value, 6) AS value,
       CASE WHEN position <= {n_labels} THEN CAST(key AS VARCHAR) END AS label
FROM curve"""


@register("ranked_curve_procedures", W(CH, """
  rv AS (SELECT procedure_id,
                power(stddev_samp(avg_charged_amount) / nullif(avg(avg_charged_amount), 0), 2) AS rv
         FROM charges GROUP BY procedure_id)""", _curve_sql("rv", "procedure_id", "rv", 7)))
def q_ranked_curve_procedures(spark, sf_dir):
    """F5 over every procedure's relative variance (sample sd); 7 labels."""
    rv = ch.procedure_relative_variance(charges_of(spark, sf_dir), ddof=1)
    return rounded(ch.ranked_curve(rv, "procedure_id", "rv", 7))


@register("ranked_curve_providers", W(
    CH, _provider_wins_sql("avg_charged_amount"),
    _curve_sql("wins", "provider_id", "CAST(cnt AS DOUBLE)", 3)))
def q_ranked_curve_providers(spark, sf_dir):
    """F5 over every provider's 1b win count; 3 labels."""
    wins = ch.provider_win_counts(charges_of(spark, sf_dir), "charge") \
        .withColumn("cnt", F.col("cnt").cast("double"))
    return rounded(ch.ranked_curve(wins, "provider_id", "cnt", 3))


@register("ranked_curve_regions", W(
    CH, _REGION_WINS_SQL,
    _curve_sql("wins", "referral_region", "CAST(cnt AS DOUBLE)", 3)))
def q_ranked_curve_regions(spark, sf_dir):
    """F5 over every region's 1c win count; 3 labels."""
    wins = ch.region_win_counts(charges_of(spark, sf_dir)) \
        .withColumn("cnt", F.col("cnt").cast("double"))
    return rounded(ch.ranked_curve(wins, "referral_region", "cnt", 3))


@register("ranked_curve_provider_dispersion", W(CH, _z_sql("stddev_samp"), """
  g AS (SELECT TRY_CAST(trim(provider_text) AS INTEGER) AS provider_id, type,
               stddev_samp(z) AS sd_z FROM z GROUP BY 1, 2),
  curve AS (SELECT provider_id AS key, sd_z AS value,
                   row_number() OVER (ORDER BY sd_z DESC NULLS LAST, provider_id ASC NULLS LAST,
                                      type ASC NULLS LAST) AS position
            FROM g)""") + """
SELECT position, round(value, 6) AS value,
       CASE WHEN position <= 3 THEN CAST(key AS VARCHAR) END AS label
FROM curve""")
def q_ranked_curve_provider_dispersion(spark, sf_dir):
    """F5 over every (provider, type): sample sd of z-scores; 3 labels."""
    stats = ch.dispersion_stats(charges_of(spark, sf_dir), ["provider_id", "type"], 1)
    return rounded(ch.ranked_curve(stats, "provider_id", "sd_z", 3, ("type",)))


@register("ranked_curve_region_dispersion", W(CH, _z_sql("stddev_samp"), """
  g AS (SELECT referral_region, type, var_samp(z) AS var_z FROM z GROUP BY 1, 2),
  curve AS (SELECT referral_region AS key, var_z AS value,
                   row_number() OVER (ORDER BY var_z DESC NULLS LAST,
                                      referral_region ASC NULLS LAST, type ASC NULLS LAST)
                     AS position
            FROM g)""") + """
SELECT position, round(value, 6) AS value,
       CASE WHEN position <= 3 THEN CAST(key AS VARCHAR) END AS label
FROM curve""")
def q_ranked_curve_region_dispersion(spark, sf_dir):
    """F5 over every (region, type): sample variance of z-scores; 3 labels."""
    stats = ch.dispersion_stats(charges_of(spark, sf_dir), ["referral_region", "type"], 1)
    return rounded(ch.ranked_curve(stats, "referral_region", "var_z", 3, ("type",)))


@register("provider_winners", W(CH, """
  r AS (SELECT procedure_id, TRY_CAST(trim(provider_id) AS BIGINT) AS provider_id,
               avg_charged_amount AS charge, avg_charged_amount - avg_total_payment AS gap
        FROM charges),
  c AS (SELECT procedure_id, provider_id,
               row_number() OVER (PARTITION BY procedure_id
                                  ORDER BY charge DESC NULLS LAST, provider_id ASC NULLS LAST) AS rc,
               row_number() OVER (PARTITION BY procedure_id
                                  ORDER BY gap DESC NULLS LAST, provider_id ASC NULLS LAST) AS rg
        FROM r)""") + """
SELECT procedure_id, max(CASE WHEN rc = 1 THEN provider_id END) AS by_charge,
       max(CASE WHEN rg = 1 THEN provider_id END) AS by_gap
FROM c GROUP BY procedure_id""")
def q_provider_winners(spark, sf_dir):
    """F1 + F3 together: top provider per procedure by charge and by gap."""
    return ch.provider_winners(charges_of(spark, sf_dir))


# Query modules register themselves on import.
from claimlens.plans import q_io, q_part3  # noqa: E402,F401
