"""Readers for the raw feeds and the stored tables.

All readers are plain ``spark.read`` scans followed by column expressions:
map-only, splittable where the format allows, whole-stage codegen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens import schemas, tables
from claimlens.sources.quoted import read_quoted_records

# Fixed values of the feed formats.
RECORD_SEPARATOR = "\x1e"   # ASCII RS ends a claims record
FIELD_SEPARATOR = "\x1f"    # ASCII US separates fields inside a record
PATIENT_BLOCK_START = "<rows>"
PATIENT_BLOCK_END = "</rows>"
PATIENT_FIELD_PATTERN = r'<field\s+name\s*=\s*"([^"]+)"\s*>([^<]*)</field>'


def _names(schema: T.StructType | list[str]) -> list[str]:
    return schema.fieldNames() if isinstance(schema, T.StructType) else list(schema)


# ---- A1 / A2: control-character delimited records --------------------------

def read_control_delimited(spark: SparkSession, path: str | list[str],
                           schema: T.StructType | list[str] = schemas.PATIENT_CLAIM,
                           record_sep: str = RECORD_SEPARATOR,
                           field_sep: str = FIELD_SEPARATOR,
                           malformed_col: str | None = None) -> DataFrame:
    """A1 + A2: records end in ``record_sep``; fields split by ``field_sep``.

    ``path`` may be a file, a directory or a glob (A10); files are split and
    read in parallel. Fields map to ``schema`` by position; empty fields are
    kept as ``''`` (also a trailing one); a short record gives NULLs, and
    ``malformed_col`` (if named) flags records whose field count differs.
    Records that are blank (e.g. a newline after the last separator) drop.
    """
    raw = spark.read.option("lineSep", record_sep).text(path)
    return parse_control_delimited(raw, schema, field_sep, malformed_col)


def parse_control_delimited(raw: DataFrame, schema: T.StructType | list[str] = schemas.PATIENT_CLAIM,
                            field_sep: str = FIELD_SEPARATOR,
                            malformed_col: str | None = None) -> DataFrame:
    """A2: records (``value`` column, batch or stream) -> named fields."""
    names = _names(schema)
    raw = raw.where(F.regexp_replace("value", r"[\r\n]", "") != "")
    parts = F.split(F.col("value"), _regex_literal(field_sep), -1)
    cols = [F.try_element_at(parts, F.lit(i + 1)).alias(n) for i, n in enumerate(names)]
    if malformed_col:
        cols.append((F.size(parts) != len(names)).alias(malformed_col))
    return raw.select(*cols)


def _regex_literal(s: str) -> str:
    return "".join("\\" + ch if ch in r".^$*+?()[]{}|\\" else ch for ch in s)


def read_claims(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The claims feed: date, patient_id, claim_id (schemas.PATIENT_CLAIM)."""
    return read_control_delimited(spark, path, schemas.PATIENT_CLAIM)


# ---- A3 / A4: tagged blocks with named fields ------------------------------

def read_tagged_blocks(spark: SparkSession, path: str | list[str],
                       start: str = PATIENT_BLOCK_START, end: str = PATIENT_BLOCK_END) -> DataFrame:
    """A3: every text block from ``start`` to ``end`` (both included).

    The file is cut at each ``start`` tag by the text reader (splittable, a
    split runs on to finish its last piece); a piece is a block only if its
    ``end`` tag is there, so a tail cut off in the middle of a block is
    dropped, and so is text before the first ``start`` tag and between blocks.
    (Text before a file's first ``start`` tag must not hold an ``end`` tag.)
    """
    return blocks_of(spark.read.option("lineSep", start).text(path), start, end)


def blocks_of(raw: DataFrame, start: str = PATIENT_BLOCK_START,
              end: str = PATIENT_BLOCK_END) -> DataFrame:
    """A3 on text cut at ``start`` tags (batch or stream): the blocks."""
    pos = F.instr(F.col("value"), end)
    return raw.where(pos > 0).select(
        F.concat(F.lit(start), F.expr(f"substr(value, 1, instr(value, {_sql_str(end)}) - 1)"), F.lit(end))
        .alias("block"))


def _sql_str(s: str) -> str:
    return "'" + s.replace("\\", "\\\\").replace("'", "\\'") + "'"


def parse_named_fields(block: Column | str, fields: dict[str, str] | None = None,
                       pattern: str = PATIENT_FIELD_PATTERN) -> list[Column]:
    """A4: columns from ``<field name="k">v</field>`` items of a block.

    Line breaks are removed first; ``fields`` maps item names to column
    names. A missing item gives ``''``, a repeated one its last value, and
    unknown names are ignored. Entities are not decoded.
    """
    fields = fields or schemas.PATIENT_XML_FIELDS
    text = F.regexp_replace(F.col(block) if isinstance(block, str) else block, "\n", "")
    keys = F.regexp_extract_all(text, F.lit(pattern), 1)
    vals = F.regexp_extract_all(text, F.lit(pattern), 2)
    pairs = F.zip_with(keys, vals, lambda k, v: F.struct(k.alias("k"), v.alias("v")))
    def named(item: str):
        return lambda p: p["k"] == F.lit(item)

    out = []
    for item, column in fields.items():
        last = F.try_element_at(F.filter(pairs, named(item)), F.lit(-1))
        out.append(F.coalesce(last["v"], F.lit("")).alias(column))
    return out


def read_patients(spark: SparkSession, path: str | list[str]) -> DataFrame:
    """The patient feed: id, age, gender, income (schemas.PATIENT)."""
    return read_tagged_blocks(spark, path).select(*parse_named_fields("block"))


# ---- A5 - A7, A9: quoted CSV (multi-line, gzip) ---------------------------

#: Files that Hadoop's codecs read whole, by extension.
COMPRESSED = (".gz", ".bz2", ".deflate", ".zst", ".snappy", ".lz4")


def read_quoted_csv(spark: SparkSession, path: str | list[str], schema: T.StructType,
                    header: bool = True, sep: str = ",", quote: str = '"',
                    repartition: int | None = None, empty_as_null: bool = False,
                    multi_line: bool = True, splits: bool | None = None, keep_cr: bool = False) -> DataFrame:
    """A5: quoted CSV whose fields may hold separators and line breaks.

    Doubled quotes inside a quoted field become one quote (RFC 4180). Plain
    files are read in splits also where records run over several lines
    (``quoted.read_quoted_records``). Compressed files (A9) cannot be split: if
    all are compressed, each is one task that the CSV scan reads exactly once, and
    ``repartition`` spreads rows after the read. ``splits`` chooses between the
    two; ``multi_line`` off is for feeds without line breaks inside quotes.
    A CRLF inside a field is read as LF unless ``keep_cr`` (in splits only).
    Every field of the feeds is text whose default is ``''``, so an empty
    field (or a missing one) reads as ``''`` unless ``empty_as_null``;
    numbers parsed later still turn it into NULL.
    """
    if splits is None:
        splits = multi_line and not all(f.endswith(COMPRESSED) for f in spark.read.text(path).inputFiles())
    options = {"sep": sep, "quote": quote, "escape": quote, "mode": "PERMISSIVE"}
    if splits:
        records = read_quoted_records(spark, path, quote)
        if header:
            records = records.where(~F.col("first"))
        text = F.col("record") if keep_cr else F.replace("record", F.lit("\r\n"), F.lit("\n"))
        ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        df = records.select(F.from_csv(text, ddl, options).alias("r")).select("r.*")
    else:
        df = spark.read.schema(schema).options(header=header, multiLine=multi_line, **options).csv(path)
    if not empty_as_null:
        df = df.select(*[F.coalesce(F.col(f.name), F.lit("")).alias(f.name)
                         if isinstance(f.dataType, T.StringType) else F.col(f.name)
                         for f in schema.fields])
    return df.repartition(repartition) if repartition else df


def read_inpatient(spark: SparkSession, path: str | list[str], **kw) -> DataFrame:
    """The inpatient feed with its 11 named columns."""
    return read_quoted_csv(spark, path, schemas.INPATIENT, **kw)


def read_outpatient(spark: SparkSession, path: str | list[str], **kw) -> DataFrame:
    """The outpatient feed with its 11 named columns."""
    return read_quoted_csv(spark, path, schemas.OUTPATIENT, **kw)


# ---- A8: id list -------------------------------------------------------------

def read_id_list(spark: SparkSession, path: str | list[str], column: str = "patient_id") -> DataFrame:
    """First comma-separated field of each line (blank lines drop)."""
    raw = spark.read.text(path)
    first = F.substring_index(F.regexp_replace("value", "\r$", ""), ",", 1)
    return raw.select(first.alias(column)).where(F.col(column) != "")


# ---- A11 - A13: stored tables ---------------------------------------------

def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None) -> DataFrame:
    """A stored Parquet table, typed by ``schema`` when given: the version
    that is current now if ``sinks.write_table`` wrote it."""
    reader = spark.read.schema(schema) if schema is not None else spark.read
    return reader.parquet(tables.current(spark, path))


def read_partition(spark: SparkSession, path: str, **equal: object) -> DataFrame:
    """Partition-pruned scan, e.g. ``cluster=1, label=0``.

    The predicate is on partition columns, so only matching directories are
    listed and read (``PartitionFilters`` in the plan).
    """
    df = spark.read.parquet(path)
    for k, v in equal.items():
        df = df.where(F.col(k) == F.lit(v))
    return df
