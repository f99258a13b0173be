"""Writers (B1-B7) and raw-format writers used for round trips.

Typed tables are Parquet; results destined for people are a header-less
one-column text file in rank order (bounded by the query's ``n``).
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens import schemas, tables
from claimlens.sources import (FIELD_SEPARATOR, PATIENT_BLOCK_END, PATIENT_BLOCK_START,
                               RECORD_SEPARATOR)


def write_table(df: DataFrame, path: str, mode: str = "overwrite") -> None:
    """A typed table, read with ``sources.read_table``.

    ``overwrite`` (create-as-select) replaces it in one step: the old table stays
    readable until the new one is whole, and may be what ``df`` reads. Other modes
    are those of the Parquet writer, on the current version.
    """
    if mode == "overwrite":
        tables.replace(df, path)
    else:
        df.write.mode(mode).parquet(tables.current(df.sparkSession, path))


def write_partitioned(df: DataFrame, path: str, cols: Sequence[str] = ("cluster", "label"),
                      mode: str = "overwrite") -> None:
    """One directory per value combination, ``cluster=<c>/label=<l>/``.

    The rows are rebalanced first: small combinations come together in one task and
    one file each, a combination that holds most rows is dealt out over as many
    tasks as it has parts of ``spark.sql.adaptive.advisoryPartitionSizeInBytes``.
    So the number of files goes with the bytes written, not with tasks times
    combinations. Empty combinations get no directory.
    """
    df.hint("rebalance", *cols).write.mode(mode).partitionBy(*cols).parquet(path)


def write_ranked_list(df: DataFrame, path: str, column: str, rank: str = "rank") -> None:
    """Header-less one-column text file (no quoting), rows in ``rank`` order.

    Meant for top-n results (the caller's ``n`` bounds the rows), so one
    sorted output file is written.
    """
    (df.select(rank, F.col(column).cast("string").alias("value")).coalesce(1)
       .sortWithinPartitions(rank).select("value").write.mode("overwrite").text(path))


def write_scores(df: DataFrame, path: str) -> None:
    """Scored rows: patient id, predicted class, score (and the class-1
    probability)."""
    df.select("patient_id", "review", "score", "p1").write.mode("overwrite").parquet(path)


def write_vectors(df: DataFrame, path: str) -> None:
    """Encoded vectors with their ids (and any label columns)."""
    df.write.mode("overwrite").parquet(path)


# ---- raw formats (the feeds' own encodings) -------------------------------

def write_control_delimited(df: DataFrame, path: str, columns: Sequence[str] | None = None,
                            record_sep: str = RECORD_SEPARATOR,
                            field_sep: str = FIELD_SEPARATOR) -> None:
    """Inverse of A1: fields joined by ``field_sep``, records end ``record_sep``."""
    columns = list(columns or df.columns)
    line = F.concat_ws(field_sep, *[F.coalesce(F.col(c), F.lit("")) for c in columns])
    df.select(line.alias("value")).write.mode("overwrite") \
        .option("lineSep", record_sep).text(path)


def patient_block(fields: dict[str, str] | None = None) -> Column:
    """Inverse of A4: one ``<rows>`` block of ``<field name=..>`` items."""
    fields = fields or schemas.PATIENT_XML_FIELDS
    items = [F.concat(F.lit(f'<field name="{item}">'), F.coalesce(F.col(col), F.lit("")),
                      F.lit("</field>"))
             for item, col in fields.items()]
    return F.concat(F.lit(PATIENT_BLOCK_START), *items, F.lit(PATIENT_BLOCK_END))


def write_tagged_xml(df: DataFrame, path: str, fields: dict[str, str] | None = None) -> None:
    """Inverse of A3 + A4: one block per row, one block per line."""
    df.select(patient_block(fields).alias("value")).write.mode("overwrite").text(path)


def write_quoted_csv(df: DataFrame, path: str, header: bool = True,
                     compression: str | None = "gzip") -> None:
    """Inverse of A5: every field quoted, doubled inner quotes, gzip parts."""
    w = (df.write.mode("overwrite").option("header", header).option("quote", '"')
         .option("escape", '"').option("quoteAll", True)
         # Spark's CSV writer trims values by default; keep them whole.
         .option("ignoreLeadingWhiteSpace", False).option("ignoreTrailingWhiteSpace", False))
    if compression:
        w = w.option("compression", compression)
    w.csv(path)


def write_id_list(df: DataFrame, path: str, column: str = "patient_id") -> None:
    """Inverse of A8: one id per line."""
    df.select(F.col(column).cast("string").alias("value")).write.mode("overwrite").text(path)
