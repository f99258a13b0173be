"""Quoted CSV records of one file read by many tasks (A5).

Whether a line break ends a record depends on the quotes before it, back to the
start of the file: an odd number of them means the break is inside a field. A
doubled quote counts twice, so parity alone decides. It is found without reading
a file in order:

1. every split is read on its own and tags its lines with the number of
   odd-quoted lines before them *in the split*, which holds whatever the split's
   own start state is;
2. the splits' totals (one row a split) are added up along each file: the state in
   which every split starts;
3. a line with an even count before it and even quotes of its own is a record; the
   lines from an odd-quoted one to the next odd-quoted one are one record, also
   across splits. Only these are brought together, by the number of their pair.

The tagged lines are written once, so steps 2 and 3 see the same splits.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimlens.operators.common import broadcast_checked, materialize

_TAGGED = "file string, start bigint, line bigint, pairs bigint, odd boolean, value string"


def _tag(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(file, start, odd, value) in file order -> with each line's number in its
    split and the number of odd lines before it there."""
    last, lines, odds = None, 0, 0
    for batch in batches:
        n = batch.num_rows
        if n == 0:
            continue
        file, start, odd, value = batch.columns
        starts = start.to_numpy(zero_copy_only=False)
        files = pc.fill_null(file, "").dictionary_encode().indices.to_numpy(zero_copy_only=False)
        cuts = np.flatnonzero((starts[1:] != starts[:-1]) | (files[1:] != files[:-1])) + 1
        runs = np.concatenate(([0], cuts))
        sizes = np.diff(np.append(runs, n))
        flags = odd.to_numpy(zero_copy_only=False).astype(np.int64)
        before = np.cumsum(flags) - flags
        number = np.arange(n) - np.repeat(runs, sizes)
        pairs = before - np.repeat(before[runs], sizes)
        if (file[0].as_py(), int(starts[0])) == last:   # the split goes on from the last batch
            number[:sizes[0]] += lines
            pairs[:sizes[0]] += odds
        last = (file[n - 1].as_py(), int(starts[-1]))
        lines, odds = int(number[-1]) + 1, int(pairs[-1] + flags[-1])
        yield pa.RecordBatch.from_arrays(
            [file, start, pa.array(number), pa.array(pairs), odd, value],
            names=["file", "start", "line", "pairs", "odd", "value"])


def read_quoted_records(spark: SparkSession, path: str | list[str], quote: str = '"') -> DataFrame:
    """The records of quoted CSV files: ``record`` (line breaks inside fields
    kept, the one at the end and a CR before it gone) and ``first``, whether it is
    its file's first. Blank lines between records drop. An unclosed quote runs to
    the end of its file, and a quote inside an unquoted field counts like any
    other, as in the feeds' own reader."""
    lines = spark.read.option("lineSep", "\n").text(path).select(
        F.col("_metadata.file_path").alias("file"), F.col("_metadata.file_block_start").alias("start"),
        ((F.length("value") - F.length(F.replace("value", F.lit(quote), F.lit("")))) % 2 == 1).alias("odd"),
        "value")
    tagged = materialize(lines.mapInArrow(_tag, _TAGGED), "csv-lines")
    earlier = Window.partitionBy("file").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    splits = tagged.groupBy("file", "start").agg(F.count_if("odd").alias("n")) \
        .select("file", "start", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("before"),
                F.dense_rank().over(Window.orderBy("file")).alias("number"))
    # one row a split: bounded by the bytes read over the bytes of a split
    placed = tagged.join(broadcast_checked(splits), ["file", "start"]) \
        .withColumn("pairs", F.col("before") + F.col("pairs")) \
        .withColumn("first", (F.col("start") == 0) & (F.col("line") == 0))
    alone = (F.col("pairs") % 2 == 0) & ~F.col("odd")
    whole = placed.where(alone).select(F.col("value").alias("record"), "first")
    several = placed.where(~alone) \
        .groupBy("number", F.shiftright("pairs", 1).alias("pair")) \
        .agg(F.sort_array(F.collect_list(F.struct("start", "line", "value"))).alias("lines"),
             F.max("first").alias("first"))
    joined = F.array_join(F.transform("lines", lambda x: x["value"]), "\n")
    records = whole.unionByName(several.select(joined.alias("record"), "first"))
    return records.select(F.regexp_replace("record", "\r$", "").alias("record"), "first") \
        .where(F.col("record") != "")
