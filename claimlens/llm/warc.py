"""WARC archives with boundary-chain verification (operator 1).

*Writing.* One record a row, by Spark's text writer with a record's closing
line breaks as line separator. Of rows with equal payloads of at least
``REVISIT_BYTES`` that with the smallest id is a ``response``; the others are
``revisit`` records, which carry digest and reference but no block.

*Reading.* Files are read in splits, cut at every occurrence of the magic
``WARC/1.0``. Each cut is a candidate record:

1. Prefix sums of the pieces' bytes within splits and over the splits of a
   file give each candidate's offset; its header gives the offset of its
   successor, if it is a record at all.
2. Tasks jump pointers inside each split, which leaves for every candidate the
   first successor beyond the split. Between splits, pointer jumping from the
   start of the file (doubling joins over the few entry points of each split)
   finds the entry points that belong to the chain, and a last pass marks the
   records reachable from them. A magic inside a payload is on no chain and is
   rejected, whatever header follows it.
3. A record whose payload holds the magic is put together from its pieces.

A chain must end at the end of its file; ``verify_chains`` tells where one
breaks.
"""

from __future__ import annotations

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from claimlens.llm.common import small, stored
from claimlens.session import scratch_path

REVISIT_BYTES = 100
# Fixed values of the archive format.
MAGIC = "WARC/1.0\r\n"
GAP = "\r\n\r\n"
PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"


def _header_value(value: Column) -> Column:
    """Header values hold no control characters: those are percent-encoded."""
    value = F.regexp_replace(value.cast("string"), "%", "%25")
    for c in ("\r", "\n", "\t"):
        value = F.regexp_replace(value, c, f"%{ord(c):02X}")
    return F.regexp_replace(value, r"[\x00-\x1f\x7f]", "%00")


def with_revisits(pages: DataFrame, least: int = REVISIT_BYTES) -> DataFrame:
    """``pages`` (id, uri, payload) with digest, bytes and first (the id that a
    revisit refers to, null for responses).

    Only digests are shuffled: groups are combined map-side, and the groups of
    two rows or more are joined back (broadcast behind a size check).
    """
    rows = pages.withColumns({"digest": F.sha2("payload", 256),
                              "bytes": F.octet_length("payload").cast("bigint")})
    groups = rows.where(F.col("bytes") >= least).groupBy("digest").agg(
        F.min("id").alias("smallest"), F.count(F.lit(1)).alias("n")).where("n > 1")
    groups = small(stored(groups.select("digest", "smallest"), "payload-groups"), 80)
    other = F.col("id").isNull() | (F.col("id") != F.col("smallest"))
    return rows.join(groups, "digest", "left").withColumn(
        "first", F.when(F.col("smallest").isNotNull() & other, F.col("smallest"))).drop("smallest")


def write_archives(pages: DataFrame, path: str, id_col: str = "page_id", uri_col: str = "url",
                   payload_col: str = "html", least: int = REVISIT_BYTES) -> None:
    """Write one record a row under ``path``.

    A null payload is empty; a null id or URI leaves its field empty. Rows
    that repeat an id are records of their own: all rows with the smallest id
    of a payload are responses. Further columns are not read.
    """
    rows = with_revisits(pages.select(
        F.col(id_col).alias("id"), F.col(uri_col).alias("uri"),
        F.coalesce(F.col(payload_col), F.lit("")).alias("payload")), least)
    revisit = F.col("first").isNotNull()
    block = F.when(revisit, F.lit("")).otherwise(F.col("payload"))

    def name(c: Column) -> Column:
        return F.concat(F.lit("<urn:page:"), F.coalesce(_header_value(c), F.lit("")), F.lit(">"))

    record = F.concat(
        F.lit(MAGIC + "WARC-Type: "), F.when(revisit, F.lit("revisit")).otherwise(F.lit("response")),
        F.lit("\r\nWARC-Record-ID: "), name(F.col("id")),
        F.lit("\r\nWARC-Target-URI: "), F.coalesce(_header_value(F.col("uri")), F.lit("")),
        F.lit("\r\nWARC-Payload-Digest: sha256:"), F.col("digest"),
        F.when(revisit, F.concat(F.lit(f"\r\nWARC-Profile: {PROFILE}\r\nWARC-Refers-To: "),
                                 name(F.col("first")))).otherwise(F.lit("")),
        F.lit("\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(block).cast("string"), F.lit(GAP), block)
    rows.select(record.alias("value")).write.option("lineSep", GAP).text(path)


def _field(head: Column, name: str) -> Column:
    found = F.regexp_extract(head, f"(?:^|\\r\\n){name}: ([^\\r\\n]*)", 1)
    return F.when(head.rlike(f"(?:^|\\r\\n){name}: "), found)


def _pieces(spark: SparkSession, path: str) -> DataFrame:
    """The files cut at every magic: file, split, row order, text after it."""
    return spark.read.option("lineSep", MAGIC).text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("split"),
        F.col("_metadata.file_size").alias("file_size"), "value") \
        .withColumn("row", F.monotonically_increasing_id())


def candidates(spark: SparkSession, path: str) -> DataFrame:
    """Every candidate record: file, split, no (in its split), offset, next
    (null if no header follows the magic), file_size, its header fields, and
    bytes and digest of the payload if the candidate holds all of it."""
    head = F.when(F.instr("value", GAP) > 0, F.substring_index("value", GAP, 1))
    p = _pieces(spark, path).withColumn("head", head).withColumn("size", F.octet_length("value"))
    length = _field(F.col("head"), "Content-Length")
    p = p.withColumn("block", F.when(length.rlike(r"^[0-9]{1,18}$"), length.cast("bigint")))
    start = F.octet_length("head") + len(GAP)
    # the text reader takes the magic off the end of every piece but a file's last
    p = p.withColumn("record", F.lit(len(MAGIC)) + start + F.col("block") + len(GAP))
    whole = F.col("size") + len(MAGIC) == F.col("record")
    payload = F.substr(F.col("value").cast("binary"), (start + 1).cast("int"), F.col("block").cast("int"))
    p = stored(p.select(
        "file", "split", "row", "file_size", "size", "record", "block", whole.alias("whole"),
        F.when(whole, F.sha2(payload, 256)).alias("digest"),
        _field(F.col("head"), "WARC-Type").alias("type"),
        _field(F.col("head"), "WARC-Record-ID").alias("record_id"),
        _field(F.col("head"), "WARC-Target-URI").alias("uri"),
        _field(F.col("head"), "WARC-Payload-Digest").alias("declared"),
        _field(F.col("head"), "WARC-Refers-To").alias("refers_to")), "warc-pieces")
    # offsets: inside a split by a window bounded by the split, then by file
    in_split = Window.partitionBy("file", "split").orderBy("row")
    p = p.withColumn("before", F.sum(F.col("size") + len(MAGIC)).over(in_split) - F.col("size") - len(MAGIC)) \
        .withColumn("no", F.row_number().over(in_split))
    splits = p.groupBy("file", "split").agg(F.sum(F.col("size") + len(MAGIC)).alias("bytes"))
    base = splits.select("file", "split", (F.sum("bytes").over(
        Window.partitionBy("file").orderBy("split")) - F.col("bytes")).alias("base"))
    at = F.col("base") + F.col("before") - len(MAGIC)
    return stored(p.join(small(base, 200), ["file", "split"]).withColumn("offset", at)
                  .withColumn("next", F.col("offset") + F.col("record"))
                  .select("file", "split", "no", "offset", "next", "file_size", "size", "block", "whole", "digest",
                          "type", "record_id", "uri", "declared", "refers_to"), "warc-candidates")


def _exits(group: pd.DataFrame) -> pd.DataFrame:
    """Pointer jumping inside a split: the first successor beyond it."""
    group = group.sort_values("offset")
    off, nxt = group["offset"].to_numpy(), group["next"].fillna(-1).to_numpy().astype(np.int64)
    at = np.searchsorted(off, nxt)
    inside = (at < len(off)) & (off[np.minimum(at, len(off) - 1)] == nxt)
    hop = np.where(inside, at, np.arange(len(off)))
    while not (hop[hop] == hop).all():
        hop = hop[hop]
    return pd.DataFrame({"file": group["file"].to_numpy(), "offset": off, "exit": nxt[hop]})


def _reached(group: pd.DataFrame) -> pd.DataFrame:
    """Candidates of a split that are reachable from its entry points."""
    group = group.sort_values("offset")
    off, nxt = group["offset"].to_numpy(), group["next"].fillna(-1).to_numpy().astype(np.int64)
    at = np.searchsorted(off, nxt)
    on = group["entry"].to_numpy().copy()
    for i in range(len(off)):                   # successors always lie behind
        if on[i] and at[i] < len(off) and off[at[i]] == nxt[i]:
            on[at[i]] = True
    return pd.DataFrame({"file": group["file"].to_numpy()[on], "offset": off[on]})


def reachable(cand: DataFrame) -> DataFrame:
    """(file, offset) of the candidates on the chain from their file's start."""
    narrow = cand.where("offset >= 0").select("file", "split", "offset", "next")
    exits = stored(narrow.groupBy("file", "split").applyInPandas(
        _exits, "file string, offset bigint, exit bigint"), "warc-exits")
    # entry points: where some split's chains leave to, and the file's start
    starts = exits.where("offset = 0").select("file", "offset")
    entry = exits.select("file", F.col("exit").alias("offset")).union(starts).distinct()
    jump = stored(exits.join(entry, ["file", "offset"], "left_semi"), "warc-jump")
    found = stored(starts, "warc-reached")
    while True:
        more = stored(found.join(jump, ["file", "offset"]).select("file", F.col("exit").alias("offset"))
                      .join(jump, ["file", "offset"], "left_semi")
                      .join(found, ["file", "offset"], "left_anti").distinct(), "warc-more")
        if more.isEmpty():
            break
        found = stored(found.union(more), "warc-reached")
        twice = jump.select("file", F.col("offset").alias("exit"), F.col("exit").alias("beyond"))
        jump = stored(jump.join(twice, ["file", "exit"], "left").select(
            "file", "offset", F.coalesce("beyond", "exit").alias("exit")), "warc-jump")
    marked = narrow.join(small(found.withColumn("entry", F.lit(True)), 200), ["file", "offset"], "left") \
        .select("file", "split", "offset", "next", F.coalesce("entry", F.lit(False)).alias("entry"))
    return stored(marked.groupBy("file", "split").applyInPandas(_reached, "file string, offset bigint"),
                  "warc-chain")


def _assembled(spark: SparkSession, path: str, cand: DataFrame, parted: DataFrame) -> DataFrame:
    """(file, offset, payload_bytes, payload_digest) of the records whose
    payload holds the magic: the pieces up to the record's end, in order."""
    owner = Window.partitionBy("file").orderBy("offset")
    mark = parted.select("file", "offset", F.col("next").alias("own_next"), F.col("block").alias("own_block"))
    parts = cand.join(small(mark, 200), ["file", "offset"], "left") \
        .withColumn("own", F.when(F.col("own_next").isNotNull(), F.struct("offset", "own_next", "own_block"))) \
        .withColumn("own", F.last("own", ignorenulls=True).over(owner)) \
        .where(F.col("own").isNotNull() & (F.col("offset") < F.col("own.own_next"))) \
        .select("file", "split", "no", "offset", "own")
    parts = stored(parts, "warc-parts")
    needed = small(parts.select("file", "split").distinct(), 200)
    text = _pieces(spark, path).join(needed, ["file", "split"], "left_semi").withColumn(
        "no", F.row_number().over(Window.partitionBy("file", "split").orderBy("row")))
    joined = text.join(parts, ["file", "split", "no"]).groupBy("file", "own").agg(
        F.array_join(F.transform(F.sort_array(F.collect_list(F.struct("offset", "value"))),
                                 lambda x: x["value"]), MAGIC).alias("text"))
    start = F.octet_length(F.substring_index("text", GAP, 1)) + len(GAP) + 1
    payload = F.substr(F.col("text").cast("binary"), start.cast("int"), F.col("own.own_block").cast("int"))
    return joined.select("file", F.col("own.offset").alias("offset"), payload.alias("payload")).select(
        "file", "offset", F.octet_length("payload").cast("bigint").alias("assembled_bytes"),
        F.sha2("payload", 256).alias("assembled_digest"))


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Every record on a chain: file, offset, record_type, record_id, uri,
    payload_bytes, payload_digest, declared_digest, refers_to (a record id).

    Bytes and digest are those of the record's own block; a revisit record has
    none (0 bytes). No files, or empty ones, give no rows. A file whose chain does
    not end at its end is an error: records behind the break would be missing.
    """
    cand = candidates(spark, path)
    chain = reachable(cand)
    broken = verify_chains(cand, chain).orderBy("file").limit(5).collect()
    if broken:
        raise ValueError("broken record chains: " + ", ".join(
            f"{r['file']} ends at {r['end']} of {r['file_size']}" for r in broken))
    records = stored(cand.join(chain, ["file", "offset"], "left_semi"), "warc-records")
    parted = records.where("not whole")
    out = records.withColumns({"payload_bytes": F.when(F.col("whole"), F.col("block")),
                               "payload_digest": F.col("digest")})
    if not parted.isEmpty():
        fixed = small(stored(_assembled(spark, path, cand, parted), "warc-assembled"), 300)
        out = out.join(fixed, ["file", "offset"], "left").withColumns({
            "payload_bytes": F.coalesce("payload_bytes", "assembled_bytes"),
            "payload_digest": F.coalesce("payload_digest", "assembled_digest")})
    return out.select("file", "offset", F.col("type").alias("record_type"), "record_id", "uri", "payload_bytes",
                      "payload_digest", F.regexp_extract("declared", "^sha256:(.*)$", 1).alias("declared_digest"),
                      "refers_to")


def verify_chains(cand: DataFrame, chain: DataFrame) -> DataFrame:
    """(file, end, file_size) of the files whose chain does not end at their end."""
    ends = cand.join(chain, ["file", "offset"], "left_semi").groupBy("file").agg(F.max("next").alias("end"))
    sizes = cand.groupBy("file").agg(F.max("file_size").alias("file_size"))
    return sizes.join(ends, "file", "left").where(~F.col("end").eqNullSafe(F.col("file_size")))


def archived_pages(pages: DataFrame, id_col: str = "page_id", uri_col: str = "url",
                   payload_col: str = "html", least: int = REVISIT_BYTES) -> DataFrame:
    """Write all pages, read the archives back, resolve the revisits.

    One row per page: ``id_col``, payload_bytes, payload_digest, record_type,
    refers_to (id of the response), ``uri_col``. Bytes and digest of a revisit
    are those of the response it refers to (no bytes, and the digest the revisit
    declares, if that is missing). An empty table gives no rows.
    """
    spark = pages.sparkSession
    path = scratch_path(spark, "llm-warc")
    write_archives(pages, path, id_col, uri_col, payload_col, least)
    records = stored(read_archives(spark, path), "warc-read")
    kind = pages.schema[id_col].dataType

    def page(c: str) -> Column:
        name = F.regexp_extract(c, "^<urn:page:(.*)>$", 1)
        return F.when(name != "", name).cast(kind)

    revisits = records.where("record_type = 'revisit'").select("record_id", "uri", "refers_to", "declared_digest")
    both = ["refers_to", "declared_digest"]       # repeated ids may have other payloads
    targets = records.where("record_type = 'response'").select(
        F.col("record_id").alias("refers_to"), F.col("payload_digest").alias("declared_digest"),
        "payload_bytes", "payload_digest") \
        .join(revisits.select(both).distinct(), both, "left_semi").dropDuplicates(both)
    # a revisit whose response is missing stays, without bytes
    resolved = revisits.join(targets, both, "left").withColumn(
        "payload_digest", F.coalesce("payload_digest", "declared_digest"))
    cols = ["record_id", "uri", "payload_bytes", "payload_digest", "record_type", "refers_to"]
    out = records.where("record_type = 'response'").withColumn("refers_to", F.lit(None).cast("string")) \
        .select(cols).unionByName(resolved.withColumn("record_type", F.lit("revisit")).select(cols))
    return out.select(page("record_id").alias(id_col), "payload_bytes", "payload_digest", "record_type",
                      page("refers_to").alias("refers_to"), F.col("uri").alias(uri_col))
