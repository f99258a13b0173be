"""Similarity self-join of embeddings by epsilon grid order (operator 6).

On unit vectors, cosine >= t is distance <= eps = sqrt(2 - 2t).

1. *Classes.* Equal vectors form one class with a count; only one of each goes
   on, so a vector held by very many rows costs one.
2. *Grid order.* The leading principal dimensions are fitted on a bounded
   sample. Vectors are sorted by their cells of width eps on these dimensions
   and cut, in that order, into blocks of about ``BLOCK``.
3. *Recursive join.* Pairs of intervals of the sequence, starting with the
   whole sequence and itself, are split fan-out by fan-out into pairs of
   shorter intervals. A pair is dropped when its bounding boxes on the
   principal dimensions (and the norms of what they leave out) prove that all
   distances exceed eps.
4. *Comparison.* The stored blocks are read in files against files: a task
   takes a run of blocks and a run of blocks straight from the shared folder,
   so vectors are neither shuffled nor written for a pair of blocks. Of a pair
   that remains, distant sub-blocks are skipped; the others are multiplied on
   ``lead`` principal dimensions and the norm of the rest, which bounds every
   cosine from above, and on all dimensions only where that bound allows a
   link. Cosines are exact in doubles.
5. *Results.* A task returns one row for each vector with a link: how many
   vectors it links, and the smallest id of its connected group within what
   the task has compared. So rows grow with the vectors, not with the linked
   pairs, nor with the pairs of blocks.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import FloatType
from pyspark.sql.window import Window

from claimlens.llm.common import freed, small, stored
from claimlens.llm.components import connected_components

THRESHOLD = 0.9
SAMPLE_VECTORS = 4_096
LEADING = 8
BLOCK, SUB_BLOCK = 4_096, 256
#: Bytes of a block's vectors, for long vectors.
BLOCK_BYTES = 4 << 20
FAN_OUT = 4
#: Numbers of leading dimensions for the bound; the share of unlinked pairs it may let pass.
LEADS, LEAD_PASS = (8, 16, 24, 32, 48, 64), 2e-4
#: Prepared blocks a task keeps for the next pairs.
HELD_BLOCKS = 24


def _usable(v: Column) -> Column:
    """Not null or empty, all components finite, not all zero."""
    d = v.cast("array<double>")
    return F.coalesce(
        (F.size(d) > 0) & F.forall(d, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists(d, lambda x: x != 0), F.lit(False))


def unit(x: np.ndarray) -> np.ndarray:
    """Rows scaled to length 1 in doubles (first by the largest component, so
    that very large or small ones neither overflow nor vanish)."""
    x = np.asarray(x, np.float64)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.sqrt((x * x).sum(axis=1, keepdims=True))


def principal_axes(x: np.ndarray, leading: int) -> np.ndarray:
    """(leading, d) orthonormal axes of largest variance of unit vectors."""
    c = x - x.mean(axis=0)
    _, axes = np.linalg.eigh(c.T @ c)
    return axes[:, ::-1][:, :leading].T


def coordinates(x: np.ndarray, axes: np.ndarray) -> np.ndarray:
    """Leading coordinates, then the norm of the rest; distances between
    these never exceed those between the vectors."""
    p = x @ axes.T
    rest = np.sqrt(np.maximum(0.0, 1.0 - (p * p).sum(axis=1)))
    return np.column_stack([p, rest])


def lead_dimensions(x: np.ndarray, axes: np.ndarray, threshold: float) -> int:
    """The least number of ``LEADS`` whose bound stops nearly all unlinked
    pairs of the sample; 0 if none does. Any number gives the same links."""
    half = min(len(x) // 2, 1_024)
    if half < 64:
        return 0
    a, b = x[:half], x[half:2 * half]
    linked = (a @ b.T >= threshold).mean()
    for n in LEADS:
        if 2 * n > x.shape[1] or n > len(axes):
            break
        if (coordinates(a, axes[:n]) @ coordinates(b, axes[:n]).T >= threshold).mean() - linked <= LEAD_PASS:
            return n
    return 0


def _matrix(values: pa.ListArray) -> np.ndarray:
    return values.flatten().to_numpy(zero_copy_only=False).reshape(len(values), -1)


def _cells_fn(axes: np.ndarray, eps: float):
    """Adds each vector's cell: two bytes a dimension, which sort as the
    numbers do."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            if b.num_rows:
                u = unit(_matrix(b.column("v")))
                cell = np.clip(np.floor(coordinates(u, axes)[:, :-1] / eps), -32768, 32767) + 32768
                flat = pa.py_buffer(np.ascontiguousarray(cell, dtype=">u2"))
                yield pa.RecordBatch.from_arrays(
                    [b.column("rep"), b.column("size"), b.column("v"),
                     pa.Array.from_buffers(pa.binary(2 * cell.shape[1]), b.num_rows, [None, flat])
                     .cast(pa.binary())], ["rep", "size", "v", "cell"])
    return run


def _blocks_fn(axes: np.ndarray, block: int):
    """Rows of one range of the sequence, in order -> packed blocks of
    ``block`` vectors, the last one of up to half as many more."""
    def pack(k: int, ids, sizes, vectors) -> pa.RecordBatch:
        v = np.concatenate(vectors)
        c = coordinates(unit(v), axes)
        return pa.RecordBatch.from_arrays(
            [pa.array([k], pa.int32()), pa.array([np.concatenate(ids).tobytes()]),
             pa.array([np.concatenate(sizes).tobytes()]), pa.array([v.tobytes()]),
             pa.array([c.min(axis=0).tolist()]), pa.array([c.max(axis=0).tolist()])],
            ["k", "ids", "sizes", "vectors", "lo", "hi"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        k, held = 0, 0
        ids, sizes, vectors = [], [], []
        for b in batches:
            if not b.num_rows:
                continue
            ids.append(b.column("rep").to_numpy())
            sizes.append(b.column("size").to_numpy())
            vectors.append(_matrix(b.column("v")))
            held += b.num_rows
            if 2 * held >= 3 * block:
                ids, sizes, vectors = ([np.concatenate(x)] for x in (ids, sizes, vectors))
                at = 0
                while 2 * (held - at) >= 3 * block:
                    yield pack(k, *([x[0][at:at + block]] for x in (ids, sizes, vectors)))
                    k, at = k + 1, at + block
                ids, sizes, vectors = ([x[0][at:].copy()] for x in (ids, sizes, vectors))
                held -= at
        if held:
            yield pack(k, ids, sizes, vectors)
    return run


@dataclass
class Side:
    """A block's vectors, prepared for comparison."""
    raw: np.ndarray             # as stored
    full: np.ndarray            # unit vectors, single precision
    lead: np.ndarray            # leading coordinates and the norm of the rest, or ``full``
    lo: np.ndarray              # boxes of sub-blocks
    hi: np.ndarray


def side(raw: np.ndarray, axes: np.ndarray, lead: int) -> Side:
    u = unit(raw)
    full = u.astype(np.float32)
    c = coordinates(u, axes[:LEADING])
    at = np.arange(0, len(raw), SUB_BLOCK)
    return Side(raw, full, coordinates(u, axes[:lead]).astype(np.float32) if lead else full,
                np.minimum.reduceat(c, at), np.maximum.reduceat(c, at))


def _exact(a: Side, b: Side, p: np.ndarray, q: np.ndarray, threshold: float) -> np.ndarray:
    """Whether the pairs of rows link, in doubles."""
    step = max(1, (1 << 20) // a.raw.shape[1])
    return np.concatenate([np.zeros(0, bool)] + [
        np.einsum("ij,ij->i", unit(a.raw[p[k:k + step]]), unit(b.raw[q[k:k + step]])) >= threshold
        for k in range(0, len(p), step)])


def _positions(hit: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """As ``np.nonzero`` of a boolean matrix, quick where little is true:
    eight elements are looked at as one word."""
    flat = hit.reshape(-1)
    whole = len(flat) // 8 * 8
    at = (np.flatnonzero(flat[:whole].view(np.uint64))[:, None] * 8 + np.arange(8)).reshape(-1)
    at = np.concatenate([at[flat[at]], whole + np.flatnonzero(flat[whole:])])
    return at // hit.shape[1], at % hit.shape[1]


def link_strips(a: Side, b: Side, threshold: float, own: bool = False
                ) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]]:
    """The links, for the strips of ``a`` that have any: their rows, their
    columns and None, or where they are many a boolean matrix with its rows
    and columns. Single precision decides pairs clear of the threshold, doubles
    those near it and the few that pass the bound."""
    eps2 = 2 - 2 * threshold + 1e-9
    margin = max(1e-4, 4e-7 * a.raw.shape[1])
    for i in range(len(a.lo)):
        gap = np.maximum(0, np.maximum(a.lo[i] - b.hi, b.lo - a.hi[i]))
        near = (gap * gap).sum(axis=1) <= eps2
        if not near.any():
            continue
        rows = np.arange(i * SUB_BLOCK, min((i + 1) * SUB_BLOCK, len(a.raw)))
        every = near.all()
        cols = np.arange(len(b.raw)) if every else np.flatnonzero(np.repeat(near, SUB_BLOCK)[:len(b.raw)])
        r, c = slice(rows[0], rows[-1] + 1), slice(None) if every else cols
        s = a.lead[r] @ b.lead[c].T
        if s.max() < threshold - margin:
            continue
        part = s >= threshold - margin
        if 64 * np.count_nonzero(part) <= s.size:
            p, q = _positions(part)
            p, q = rows[p], cols[q]
            on = _exact(a, b, p, q, threshold)
            if own:
                on &= p != q
            if on.any():
                yield p[on], q[on], None
            continue
        if a.lead is not a.full:
            s = a.full[r] @ b.full[c].T
        part = s >= threshold
        p, q = _positions(np.abs(s - threshold) < margin)
        part[p, q] = _exact(a, b, rows[p], cols[q], threshold)
        if own:
            part &= rows[:, None] != cols
        if part.any():
            yield rows, cols, part


def links_between(a: np.ndarray, b: np.ndarray | None, axes: np.ndarray, threshold: float,
                  lead: int = 0) -> np.ndarray:
    """Boolean matrix of cosine >= threshold between vectors (b None: of ``a``
    with itself, without the diagonal)."""
    x = side(a, axes, lead)
    y = x if b is None else side(b, axes, lead)
    link = np.zeros((len(x.raw), len(y.raw)), bool)
    for p, q, part in link_strips(x, y, threshold, b is None):
        if part is None:
            link[p, q] = True
        else:
            link[np.ix_(p, q)] = part
    return link


def smallest_linked(p: np.ndarray, q: np.ndarray, left: np.ndarray, right: np.ndarray
                    ) -> tuple[np.ndarray, np.ndarray]:
    """Smallest label of each row's and column's group, for links (p, q)."""
    a, b = left.copy(), right.copy()
    while True:
        na, nb = a.copy(), b.copy()
        np.minimum.at(na, p, b[q])
        np.minimum.at(nb, q, na[p])
        if (na == a).all() and (nb == b).all():
            return a, b
        a, b = na, nb


def few_links(part: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of some links that connect what all links of a matrix
    connect: the first of each row and column, and more while any is left
    between groups."""
    n, m = part.shape
    first, top = part.argmax(axis=1), part.argmax(axis=0)
    on, up = np.flatnonzero(part[np.arange(n), first]), np.flatnonzero(part[top, np.arange(m)])
    p, q = np.concatenate([on, top[up]]), np.concatenate([first[on], up])
    while True:
        a, b = (x.astype(np.int32) for x in smallest_linked(p, q, np.arange(n), np.arange(n, n + m)))
        x, y = _positions(part & (a[:, None] != b))
        if not len(x):
            return p, q
        _, one = np.unique(a[x].astype(np.int64) * (n + m) + b[y], return_index=True)
        p, q = np.concatenate([p, x[one]]), np.concatenate([q, y[one]])


def _counted(part: np.ndarray, sizes: np.ndarray) -> np.ndarray:
    if (sizes == 1).all():
        return np.count_nonzero(part, axis=1)
    return (part.astype(np.float64) @ sizes.astype(np.float64)).astype(np.int64)


def _summed(strips: Iterator[tuple[np.ndarray, np.ndarray, np.ndarray | None]], left: np.ndarray,
            sizes: np.ndarray, right: np.ndarray, jsizes: np.ndarray) -> tuple[np.ndarray, ...] | None:
    """Of a pair of blocks: vectors linked by each row and each column, and the
    smallest labels of their groups; None without a link."""
    n, m = np.zeros(len(left), np.int64), np.zeros(len(right), np.int64)
    ps, qs = [], []
    for p, q, part in strips:
        if part is None:
            n += np.bincount(p, weights=jsizes[q], minlength=len(n)).astype(np.int64)
            m += np.bincount(q, weights=sizes[p], minlength=len(m)).astype(np.int64)
        else:
            n[p] += _counted(part, jsizes[q])
            m[q] += _counted(part.T, sizes[p])
            x, y = few_links(part)
            p, q = p[x], q[y]
        ps.append(p)
        qs.append(q)
    return (n, m, *smallest_linked(np.concatenate(ps), np.concatenate(qs), left, right)) if ps else None


@dataclass
class Found:
    """What a task has found for a block's vectors."""
    ids: np.ndarray
    sizes: np.ndarray
    n: np.ndarray
    label: np.ndarray           # smallest id of the group so far

    def lowered(self, label: np.ndarray) -> np.ndarray:
        """Takes new labels; the pairs (old, new) without which a vector that
        had the old one would lose its group."""
        moved = (label < self.label) & (self.label != self.ids)
        pairs = np.unique(np.stack([self.label[moved], label[moved]], axis=1), axis=0)
        self.label = label
        return pairs


def _pairs_fn(axes: np.ndarray, lead: int, dims: int, dtype: np.dtype, threshold: float):
    """Pairs of blocks -> (node, n, root): at the end of a task one row for each
    vector that it has linked, and before that (n = 0) the groups that met."""
    def out(node: np.ndarray, n: np.ndarray, root: np.ndarray) -> pa.RecordBatch:
        return pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in (node, n, root)], ["node", "n", "root"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, Side] = {}          # a task meets the same blocks again and again
        found: dict[int, Found] = {}

        def block(b: pa.RecordBatch, i: int, s: str) -> tuple[Found, Side]:
            no = b.column(s)[i].as_py()
            if no not in held:
                if len(held) >= HELD_BLOCKS:
                    held.pop(next(iter(held)))
                held[no] = side(np.frombuffer(b.column("vectors" + s)[i].as_py(), dtype).reshape(-1, dims), axes, lead)
            if no not in found:
                ids, sizes = (np.frombuffer(b.column(c + s)[i].as_py(), np.int64) for c in ("ids", "sizes"))
                found[no] = Found(ids, sizes, np.zeros(len(ids), np.int64), ids)
            return found[no], held[no]

        def compared(b: pa.RecordBatch, i: int) -> np.ndarray | None:
            (x, left), (y, right) = block(b, i, "a"), block(b, i, "b")
            got = _summed(link_strips(left, right, threshold, x is y), x.label, x.sizes, y.label, y.sizes)
            if got is None:
                return None
            n, m, ra, rb = got
            x.n += n
            if x is y:
                return x.lowered(np.minimum(ra, rb))
            y.n += m
            return np.concatenate([x.lowered(ra), y.lowered(rb)])

        for batch in batches:
            for i in range(batch.num_rows):
                met = compared(batch, i)
                if met is not None and len(met):
                    yield out(met[:, 0], np.zeros(len(met), np.int64), met[:, 1])
        batch = None
        held.clear()
        for x in found.values():
            on = x.n > 0
            yield out(x.ids[on], x.n[on], x.label[on])
        found.clear()
        x = None
        freed()
    return run


def _near(lo_a: str, hi_a: str, lo_b: str, hi_b: str, eps2: float) -> Column:
    gap = F.zip_with(
        F.zip_with(lo_a, hi_b, lambda x, y: x - y), F.zip_with(lo_b, hi_a, lambda x, y: x - y),
        lambda x, y: F.greatest(x, y, F.lit(0.0)))
    return F.aggregate(gap, F.lit(0.0), lambda s, g: s + g * g) <= eps2


def block_pairs(boxes: DataFrame, eps2: float) -> DataFrame:
    """(a, b), a <= b, of the blocks (no, lo, hi) whose boxes may hold a link,
    by recursive splitting of pairs of intervals of the sequence."""
    width = len(boxes.first()["lo"])
    n = boxes.count()
    levels = [boxes]
    size = n
    while size > 1:
        up = levels[-1].groupBy(F.floor(F.col("no") / FAN_OUT).cast("bigint").alias("no")).agg(
            F.array(*[F.min(F.col("lo")[i]) for i in range(width)]).alias("lo"),
            F.array(*[F.max(F.col("hi")[i]) for i in range(width)]).alias("hi"))
        levels.append(stored(up, "intervals"))
        size = -(-size // FAN_OUT)
    pairs = levels[-1].select(F.col("no").alias("a"), F.col("no").alias("b"))
    step = F.sequence(F.lit(0), F.lit(FAN_OUT - 1))
    for level in reversed(levels[:-1]):
        a = level.select(F.col("no").alias("a"), F.col("lo").alias("la"), F.col("hi").alias("ha"))
        b = level.select(F.col("no").alias("b"), F.col("lo").alias("lb"), F.col("hi").alias("hb"))
        split = pairs.withColumn("i", F.explode(step)).withColumn("j", F.explode(step)).select(
            (F.col("a") * FAN_OUT + F.col("i")).alias("a"),
            (F.col("b") * FAN_OUT + F.col("j")).alias("b")).where("a <= b")
        pairs = stored(split.join(a, "a").join(b, "b").where(_near("la", "ha", "lb", "hb", eps2))
                       .select("a", "b"), "interval-pairs")
    return pairs


def linked_vectors(vectors: DataFrame, id_col: str = "vec_id", vector_col: str = "embedding",
                   threshold: float = THRESHOLD) -> DataFrame:
    """``id_col``, n_links, component_id, kept: one row per row of ``vectors``.

    Vectors that are null, empty, zero or hold null or non-finite components,
    and rows without an id, link with nothing; so do vectors of different
    lengths. Equal vectors link. Rows that repeat an id count as vectors of
    their own. ``kept`` is true for rows without an id. Other columns are not
    read; an empty table gives no rows.
    """
    spark = vectors.sparkSession
    rows = vectors.select(F.col(id_col).alias("id"), F.col(vector_col).alias("v"))
    single = isinstance(getattr(rows.schema["v"].dataType, "elementType", None), FloatType)
    kind = "array<float>" if single else "array<double>"
    usable = rows.where(F.col("id").isNotNull() & _usable(F.col("v"))) \
        .select("id", F.col("v").cast(kind).alias("v"))
    classes = stored(usable.groupBy("v").agg(F.min("id").alias("rep"), F.count(F.lit(1)).alias("size"))
                     .select("rep", "size", "v"), "vector-classes")
    found = [spark.createDataFrame([], "node bigint, n bigint, root bigint")]
    for r in classes.select(F.size("v").alias("d")).distinct().collect():   # one in a sound table
        found.append(_same_length(classes.where(F.size("v") == r["d"]), r["d"], kind, threshold))
    links = found[0]
    for f in found[1:]:
        links = links.union(f)
    links = stored(links, "vector-links")
    comp = connected_components(links.select(F.col("node").alias("a"), F.col("root").alias("b")))
    degree = links.groupBy("node").agg(F.sum("n").alias("n"))
    # rows meet their class by a hash, and by the vector too where a hash is not of one class
    hashed = F.xxhash64("v").alias("hash")
    twice = classes.select(hashed).groupBy("hash").count().where("count > 1")
    key = ["hash"] if twice.isEmpty() else ["hash", "v"]
    of_class = classes.select("rep", "size", hashed, *key[1:]) \
        .join(degree, F.col("rep") == degree["node"], "left").drop("node") \
        .join(comp, F.col("rep") == comp["node"], "left").select(
            *key, (F.coalesce("n", F.lit(0)) + F.col("size") - 1).alias("n_links"),
            F.coalesce("component", "rep").alias("component_id"))
    good = usable.select("id", hashed, *key[1:]).join(of_class, key) \
        .select(F.col("id").alias(id_col), "n_links", "component_id")
    rest = rows.where(~(F.col("id").isNotNull() & _usable(F.col("v")))).select(
        F.col("id").alias(id_col), F.lit(0).cast("bigint").alias("n_links"),
        F.col("id").alias("component_id"))
    return good.union(rest).withColumn(
        "kept", F.coalesce(F.col(id_col) == F.col("component_id"), F.lit(True)))


def _same_length(classes: DataFrame, dims: int, kind: str, threshold: float) -> DataFrame:
    """(node, n, root) rows of the linked classes of one vector length."""
    total = classes.count()
    part = F.pmod(F.xxhash64("rep"), F.lit(1 << 20))
    sample = classes.where(part < (1 << 20) * min(1.0, 1.2 * SAMPLE_VECTORS / total) + 1) \
        .select("v").limit(SAMPLE_VECTORS).toArrow()
    x = unit(_matrix(sample["v"].combine_chunks())) if sample.num_rows else np.eye(dims)
    axes = principal_axes(x, min(max(LEADING, *LEADS), dims))
    lead = lead_dimensions(x, axes, threshold)
    leading = axes[:LEADING]
    dtype = np.dtype(np.float32 if kind == "array<float>" else np.float64)
    block = min(BLOCK, max(SUB_BLOCK, BLOCK_BYTES // (dims * dtype.itemsize)))
    eps2 = 2 - 2 * threshold
    cells = classes.mapInArrow(_cells_fn(leading, float(np.sqrt(eps2))),
                               f"rep bigint, size bigint, v {kind}, cell binary")
    parts = max(1, min(int(classes.sparkSession.conf.get("spark.sql.shuffle.partitions")),
                       -(-total // block)))
    ranged = cells.repartitionByRange(parts, "cell", "rep").sortWithinPartitions("cell", "rep")
    packed = ranged.mapInArrow(_blocks_fn(leading, block), "k int, ids binary, sizes binary, "
                               "vectors binary, lo array<double>, hi array<double>") \
        .withColumn("part", F.spark_partition_id())
    packed = stored(packed, "vector-blocks")
    # block numbers in grid order: one narrow row a block
    number = packed.select("part", "k", "lo", "hi").withColumn(
        "no", (F.row_number().over(Window.orderBy("part", "k")) - 1).cast("bigint"))
    number = stored(number, "vector-boxes")
    pairs = block_pairs(number.select("no", "lo", "hi"), eps2 + 1e-9)
    return _compared(packed, number, pairs).mapInArrow(
        _pairs_fn(axes, lead, dims, dtype, threshold), "node bigint, n bigint, root bigint")


def _compared(packed: DataFrame, number: DataFrame, pairs: DataFrame) -> DataFrame:
    """Both blocks of every pair. Files of blocks meet files of blocks, read
    where they are stored; a block's list of partners decides what is handed
    on. Each pair stands in the list of its first or second block, by turns,
    so that all tasks have their share."""
    blocks = packed.join(small(number.select("part", "k", "no"), 24), ["part", "k"]) \
        .select("no", "ids", "sizes", "vectors")

    def named(s: str) -> DataFrame:
        return blocks.select(F.col("no").alias(s), *[F.col(c).alias(c + s) for c in ("ids", "sizes", "vectors")])

    straight = (F.col("a") + F.col("b")) % 2 == 0
    partners = stored(pairs.select(F.when(straight, F.col("a")).otherwise(F.col("b")).alias("a"),
                                   F.when(straight, F.col("b")).otherwise(F.col("a")).cast("int").alias("b"))
                      .groupBy("a").agg(F.collect_list("b").alias("partners")), "block-partners")
    lists = small(partners, 32 + 4 * -(-pairs.count() // max(1, number.count())))
    return named("a").join(lists, "a").join(
        named("b").hint("shuffle_replicate_nl"),
        F.array_contains("partners", F.col("b").cast("int"))).drop("partners")
