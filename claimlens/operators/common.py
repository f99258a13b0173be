"""Plan-shape helpers shared by the operators.

* ``ranked_top``   - top ``n`` with a rank column (``TakeOrderedAndProject``:
  each partition keeps its own top ``n`` before one small merge);
  ``ranked_top_large`` first cuts the input at a score threshold.
* ``iteration_input`` - persisted, sized input for iterative MLlib fits.
* ``materialize``  - write a DataFrame as Parquet in the shared checkpoint
  folder and read it back: lineage cut, durable if executors are lost.
* ``join_small``   - broadcast a side only after its rows and bytes are checked;
  above the bound it is a plain (shuffled, AQE-managed) join.
* ``store_bucketed`` - tables that join by their key without a shuffle.
* ``global_rank``  - 1..N positions in a total order without moving every
  row into one task (range partitioning + per-partition offsets).
"""

from __future__ import annotations

import uuid
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Row, SparkSession, Window
from pyspark.sql import functions as F

from claimlens.session import scratch_path


#: Accuracy of the quantile sketch: rank error at most rows / accuracy.
SKETCH_ACCURACY = 50_000


def ranked_top(df: DataFrame, n: int, order: Sequence[Column]) -> DataFrame:
    """The first ``n`` rows in ``order`` (a total order), with ``rank`` 1..n.

    ``orderBy().limit(n)`` plans as ``TakeOrderedAndProject``: each input
    partition keeps its own top ``n`` and only those reach the final merge;
    the rank is then numbered over the ``n`` survivors. (A ``row_number()
    <= n`` filter would get no per-partition limit for ``n`` above the
    optimizer's window-group-limit threshold.)
    """
    top = df.orderBy(*order).limit(n)
    return top.withColumn("rank", F.row_number().over(Window.orderBy(*order)))


def ranked_top_large(df: DataFrame, n: int, value: str, tiebreak: str,
                     direction: str = "desc") -> DataFrame:
    """``ranked_top`` for a large ``n`` over a numeric ``value``.

    A plain top-n sends ``n`` rows per input partition to one final task.
    Here one pass counts the rows and takes a mergeable quantile sketch of
    ``value`` at a fixed ladder of levels; the count then picks the level that is
    sure to hold ``n`` rows (the sketch's rank error is bounded), and a second pass
    writes only the rows beyond it, which enter the exact top-n. Two evaluations
    of the input; exact; order ``value`` (``direction``, NULLs last) then
    ``tiebreak`` ascending.
    """
    desc = direction == "desc"
    v = F.col(value)
    order = [v.desc_nulls_last() if desc else v.asc_nulls_last(), F.col(tiebreak).asc_nulls_last()]
    ladder = [2.0 ** (-k / 2) for k in range(41)]       # shares of the rows, down to one in a million
    sketch = F.percentile_approx(v, [1.0 - x if desc else x for x in ladder], SKETCH_ACCURACY)
    stats = df.agg(F.count(v).alias("total"), sketch.alias("cuts")).first()
    total = stats["total"]
    if total <= 4 * n:
        return ranked_top(df, n, order)
    # a cut may lie off its rank by total / accuracy rows, and one for rounding
    sure = [c for x, c in zip(ladder, stats["cuts"]) if x * total - total / SKETCH_ACCURACY - 1 >= n]
    beyond = (v >= F.lit(sure[-1])) if desc else (v <= F.lit(sure[-1]))
    return ranked_top(materialize(df.where(beyond), "top-candidates"), n, order)


def materialize(df: DataFrame, name: str, spark: SparkSession | None = None) -> DataFrame:
    """Write ``df`` as Parquet under the shared folder and read it back."""
    spark = spark or df.sparkSession
    path = scratch_path(spark, name)
    df.write.mode("overwrite").parquet(path)
    return spark.read.parquet(path)


#: A side is broadcast only if its measured size is within this bound, too.
MAX_BROADCAST_BYTES = 256 << 20
_FIELD_BYTES = {"boolean": 1, "int": 4, "bigint": 8, "double": 8}


def row_bytes(df: DataFrame) -> Column:
    """Bytes of a row: texts and binaries by their own length, nested values by
    that of their JSON form, other types by their fixed size; 8 a field besides."""
    total = F.lit(8 * len(df.columns))
    for name, kind in df.dtypes:
        c = F.col(f"`{name}`")
        if kind in ("string", "binary"):
            total = total + F.coalesce(F.octet_length(c), F.lit(0))
        elif "<" in kind:
            total = total + F.coalesce(F.octet_length(F.to_json(F.struct(c))), F.lit(0))
        else:
            total = total + F.lit(_FIELD_BYTES.get(kind, 16))
    return total


def measured(df: DataFrame) -> Row:
    """How many ``rows`` and ``bytes`` ``df`` has."""
    return df.agg(F.count(F.lit(1)).alias("rows"), F.sum(row_bytes(df).cast("bigint")).alias("bytes")).first()


def within(size: Row, max_rows: int) -> bool:
    """Whether rows and bytes, both counted, are within the bounds of a broadcast."""
    return size["rows"] <= max_rows and (size["bytes"] or 0) <= MAX_BROADCAST_BYTES


def _fits(df: DataFrame, max_rows: int) -> bool:
    return within(measured(df), max_rows)


def join_small(big: DataFrame, small: DataFrame, on, how: str = "inner",
               max_broadcast_rows: int = 2_000_000, name: str = "small-side") -> DataFrame:
    """Join ``big`` with a side that is expected to be small.

    The small side is materialized once (one pass over its input) and its
    rows and bytes are counted; only when the count is within
    ``max_broadcast_rows`` and the bytes within ``MAX_BROADCAST_BYTES`` is it broadcast.
    Beyond that the join is left to the planner (sort-merge with AQE skew
    splitting), so a mis-sized input degrades, not fails.
    """
    small = materialize(small, name)
    return big.join(F.broadcast(small) if _fits(small, max_broadcast_rows) else small, on, how)


def broadcast_checked(df: DataFrame, max_rows: int = 2_000_000) -> DataFrame:
    """``broadcast(df)`` if ``df`` has at most ``max_rows`` rows and their bytes
    are within ``MAX_BROADCAST_BYTES``, else ``df``.

    For sides that are cheap to count (small scans, dimension joins): the
    count is one short job, and the hint is only given under the bound.
    """
    return F.broadcast(df) if _fits(df, max_rows) else df


def store_bucketed(df: DataFrame, key: str, buckets: int, name: str,
                   partition_by: Sequence[str] = ()) -> DataFrame:
    """Write ``df`` to the shared folder in ``buckets`` hash buckets of ``key``, one
    sorted file each, and read it back as a table of the session's catalog.

    Tables stored with the same number of buckets join, and group, by the key
    without a shuffle of either: the way to join sides that are both too large to
    broadcast. With ``partition_by`` each value combination is a directory.
    """
    spark = df.sparkSession
    table = f"{name}_{uuid.uuid4().hex[:12]}".replace("-", "_")
    writer = df.repartition(buckets, key).write.format("parquet").option("path", scratch_path(spark, name))
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.bucketBy(buckets, key).sortBy(key).saveAsTable(table)
    return spark.table(table)


def iteration_input(df: DataFrame, rows_per_partition: int = 100_000,
                    order_col: str | None = None) -> DataFrame:
    """Prepare the input of an iterative fit: persisted, in partitions of
    about ``rows_per_partition`` rows.

    Each iteration is one distributed pass; a small input should not pay
    many tiny tasks per pass, a large one keeps its parallelism. With
    ``order_col`` the layout depends on the data only (hash partitions by
    that column, sorted inside), so a seeded fit that samples partitions
    repeats on any cluster size; without it the input is coalesced.
    Persisted blocks lost with an executor are recomputed from lineage.
    The caller unpersists after the fit.
    """
    rows = df.count()
    parts = max(1, -(-rows // rows_per_partition))
    if order_col is not None:
        laid = df.repartition(parts, order_col).sortWithinPartitions(order_col)
    else:
        laid = df.coalesce(parts)   # never increases the partition count
    return laid.persist()


def global_rank(df: DataFrame, order: Sequence[Column], name: str = "position",
                partitions: int | None = None) -> DataFrame:
    """Add ``name`` = 1..N in ``order`` (which must be a total order).

    Rows are range-partitioned by the order and sorted inside each range;
    each row's number inside its range comes from the same stage
    (``monotonically_increasing_id`` holds the row's index in its partition
    in the low 33 bits), and is shifted by the row count of all earlier
    ranges. One shuffle; only one count per range (bounded by the
    partition count) is broadcast.
    """
    spark = df.sparkSession
    if partitions is None:
        partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    low_bits = (1 << 33) - 1
    ranged = (df.repartitionByRange(partitions, *order).sortWithinPartitions(*order)
              .withColumn("_part", F.spark_partition_id())
              .withColumn("_local", (F.monotonically_increasing_id()
                                     .bitwiseAND(F.lit(low_bits)) + 1)))
    ranged = materialize(ranged, "ranked")
    sizes = ranged.groupBy("_part").agg(F.count(F.lit(1)).alias("_size"))
    offsets = sizes.select(
        "_part",
        (F.sum("_size").over(Window.orderBy("_part")) - F.col("_size")).alias("_offset"))
    return ranged.join(F.broadcast(offsets), "_part") \
        .withColumn(name, F.col("_offset") + F.col("_local")) \
        .drop("_part", "_local", "_offset")
