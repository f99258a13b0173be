"""Helpers shared by the training-data operators.

* ``stored``       - write a table to the shared folder and read it back.
* ``small``        - broadcast hint behind a byte check.
* ``arrow_map``    - ``mapInArrow`` over named columns.
* ``freed``        - returns a finished task's memory to the system.
* ``mix64``        - 64-bit finalizer used to derive hash streams in numpy.
* ``WordIds``      - bounded word -> 64-bit id cache for one Python worker.
"""

from __future__ import annotations

import ctypes
import gc
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.session import scratch_path

#: A side is broadcast up to this many bytes (rows x a stated row width).
BROADCAST_BYTES = 64 << 20
#: Rows of an Arrow batch that a task turns into Python objects at once.
SLICE_ROWS = 1_000


def stored(df: DataFrame, name: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back."""
    spark = df.sparkSession
    path = scratch_path(spark, f"llm-{name}")
    df.write.mode("error").parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def small(df: DataFrame, row_bytes: int, max_bytes: int = BROADCAST_BYTES) -> DataFrame:
    """``df`` with a broadcast hint if ``count x row_bytes`` is within the bound.

    Beyond it the plain DataFrame is returned and the join shuffles, with
    skewed partitions split at run time.
    """
    return F.broadcast(df) if df.count() * row_bytes <= max_bytes else df


def arrow_map(df: DataFrame, fn: Callable[[dict], dict], schema: str) -> DataFrame:
    """Map Arrow batches: ``fn`` gets {column: Arrow array} and returns
    {column: list, numpy or Arrow array}. Batches are bounded by Spark in
    rows and bytes and handed on in slices of ``SLICE_ROWS`` rows, so memory
    does not grow with the partition."""
    arrow_schema = _arrow_schema(df, schema)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in (b.slice(i, SLICE_ROWS) for b in batches for i in range(0, b.num_rows, SLICE_ROWS)):
            out = fn({n: batch.column(i) for i, n in enumerate(batch.schema.names)})
            yield pa.RecordBatch.from_arrays(
                [_as_arrow(out[f.name], f.type) for f in arrow_schema], schema=arrow_schema)
            out = None
        batch = None
        freed()

    return df.mapInArrow(run, schema)


def freed() -> None:
    """Give a finished task's memory back to the system: a worker stays alive for
    later tasks, also for those of other stages that need its executor's memory. What the
    caller still names (its last batch) stays: it lets go of that before."""
    gc.collect()
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)     # glibc only
    if trim is not None:
        trim(0)


def _arrow_schema(df: DataFrame, schema: str) -> pa.Schema:
    from pyspark.sql.pandas.types import to_arrow_schema
    from pyspark.sql.types import StructType
    return to_arrow_schema(StructType.fromDDL(schema))


def _as_arrow(values, kind: pa.DataType) -> pa.Array:
    if isinstance(values, pa.Array):
        return values if values.type == kind else values.cast(kind)
    return pa.array(values, type=kind)


def lists(values: np.ndarray, lengths, kind: pa.DataType) -> pa.Array:
    """A list column from its flat values and the length of each list."""
    offsets = np.zeros(len(lengths) + 1, np.int32)
    np.cumsum(lengths, out=offsets[1:])
    return pa.ListArray.from_arrays(pa.array(offsets), pa.array(values, type=kind))


def mix64(x: np.ndarray) -> np.ndarray:
    """Finalizer of the splitmix generator on uint64 (wraps around)."""
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


class WordIds(dict):
    """word -> xxhash64 of its UTF-8 form; cleared when it holds ``limit``
    words (the ids do not depend on the cache)."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: str) -> int:
        if len(self) >= self.limit:
            self.clear()
        h = xxhash.xxh64_intdigest(word.encode("utf-8", "surrogatepass"))
        self[word] = h
        return h

    def ids(self, words: list[str]) -> np.ndarray:
        return np.fromiter(map(self.__getitem__, words), np.uint64, len(words))


def shingle_hashes(ids: np.ndarray, n: int = 5) -> np.ndarray:
    """64-bit hashes of the ``n``-word shingles of a word-id sequence; a
    shorter text is one shingle, a text without words has none."""
    if len(ids) == 0:
        return ids
    k = min(n, len(ids))
    h = ids[: len(ids) - k + 1] + np.uint64(k)
    for j in range(1, k):
        h = h * np.uint64(0x9E3779B97F4A7C15) + ids[j: len(ids) - k + 1 + j]
    return mix64(h)
