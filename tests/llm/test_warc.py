"""Operator 1: exact round trip, forged records, splits inside payloads."""
import hashlib

import pytest

from claimlens.llm import warc
from claimlens.session import scratch_path

FORGED = ("WARC/1.0\r\nWARC-Type: response\r\nWARC-Record-ID: <urn:page:666>\r\n"
          "Content-Length: 5\r\n\r\nhello\r\n\r\n")
SCHEMA = "page_id bigint, url string, html string, offset int, file string, next int, _smallest string"


def table(spark, rows):
    return spark.createDataFrame([(*r, 1, "f", 2, "s") for r in rows], SCHEMA)


def expected(rows):
    first = {}
    for i, _, h in sorted(rows, key=lambda r: r[0]):
        b = (h or "").encode()
        if len(b) >= warc.REVISIT_BYTES:
            first.setdefault(b, i)
    out = []
    for i, _, h in rows:
        b = (h or "").encode()
        to = first.get(b)
        again = to is not None and to != i
        out.append((i, len(b), hashlib.sha256(b).hexdigest(), "revisit" if again else "response", to if again else None))
    return sorted(out)


@pytest.fixture
def tiny_splits(spark):
    old = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "9000")
    yield
    spark.conf.set("spark.sql.files.maxPartitionBytes", old)


def test_round_trip_with_magic_in_payloads(spark, tiny_splits):
    rows = []
    for i in range(90):
        t = f"<p>page {i}</p>" * (i % 40)
        if i % 7 == 0:
            t += "x" * 3000 + FORGED * (i % 5 + 1) + warc.MAGIC * (i % 4)
        if i % 11 == 0:
            t = "same payload " * 20
        if i % 13 == 0:
            t = None
        if i % 17 == 0:
            t = warc.MAGIC
        if i % 41 == 0:
            t = FORGED * 300
        if i % 23 == 0:
            t = "é\r\n\r\n" * 40
        rows.append((i, f"http://x/{i}\r\nContent-Length: 1\r\n\r\n" + warc.MAGIC + "%", t))
    got = warc.archived_pages(table(spark, rows).repartition(3))
    assert sorted((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to)
                  for r in got.collect()) == expected(rows)


def test_chains_end_at_the_end_of_the_file_and_cuts_are_told(spark):
    path = scratch_path(spark, "warc-test")
    warc.write_archives(table(spark, [(i, "u", f"body {i} " * 30) for i in range(5)]).coalesce(1), path)
    cand = warc.candidates(spark, path)
    assert warc.verify_chains(cand, warc.reachable(cand)).collect() == []
    text = "".join(r.value for r in spark.read.option("wholetext", True).text(path).collect())
    cut = scratch_path(spark, "warc-cut")
    spark.createDataFrame([(text[:-40],)], "value string").coalesce(1).write.option("lineSep", "\n").text(cut)
    cand = warc.candidates(spark, cut)
    assert warc.verify_chains(cand, warc.reachable(cand)).count() == 1


def test_null_ids_repeated_rows_and_empty_table(spark):
    big = "b" * 200
    rows = [(1, "u", big), (1, "u", big), (2, None, big), (None, "u", big), (3, "u", "s"), (4, "u", "s")]
    got = warc.archived_pages(table(spark, rows)).collect()
    assert sorted((r.page_id or -1, r.record_type, r.refers_to or -1, r.payload_bytes) for r in got) == [
        (-1, "revisit", 1, 200), (1, "response", -1, 200), (1, "response", -1, 200), (2, "revisit", 1, 200),
        (3, "response", -1, 1), (4, "response", -1, 1)]
    assert warc.archived_pages(table(spark, [])).collect() == []
