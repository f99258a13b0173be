"""Merkle manifest of a dataset by time-forward processing.

Every row is a leaf; the leaves of a group (``lang``) in ``doc_id`` order form a
tree of fan-out 8, and the groups' subroots, in group order, form the tree above.

The nodes of a tree are labelled ``(last leaf beneath, level)``, an order in which
children precede their parent:

* forward sweep: nodes are taken in label order; a priority queue ordered by the
  label of the receiver holds the child digests, a node takes its children from
  the front, and sends its own digest to its parent;
* reversed sweep: nodes in the opposite order; a node takes the proof suffix sent
  to it (the siblings from its own level to the root) and sends each child that
  child's siblings followed by the suffix. A leaf hashes the suffix (its proof)
  and folds its digest through it.

The external queue is Spark's sorted shuffle: a task sweeps blocks of
``8 ** SPAN`` leaves in label order with a heap of some dozen messages, messages
between blocks are rows of a written table that the next round sorts by their
receiver. A group that holds most rows is spread over its blocks; a round shrinks
the rows by ``8 ** SPAN``. Only the root, the largest group's size and the number
of groups come to the driver.

Defined results: a null column is ``-`` in the leaf; null group first, a group of
its own; null ids first in their group; rows with one id in the order of their
digests; equal rows are leaves of their own; an empty table gives an empty result.
Other columns may have any name.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator, Sequence
from hashlib import sha256

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

from claimlens.llm.common import SLICE_ROWS, small, stored
from claimlens.operators.common import global_rank

#: Children of a node are so many bits of its index: runs of 8.
BITS = 3
#: Levels that a task folds at once: blocks of 512 leaves.
SPAN = 3
#: Columns of a leaf, in order.
COLUMNS = ("doc_id", "source", "lang", "n_chars", "text")
HEX = 64
_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def leaf_digest(*values: Column) -> Column:
    """SHA-256 of the values, each as byte count, ``:`` and text, or ``-``."""
    parts = []
    for value in values:
        text = value.cast("string")
        parts.append(F.coalesce(F.concat(F.octet_length(text).cast("string"), F.lit(":"), text), F.lit("-")))
    return F.sha2(F.concat(*parts), 256)


def _hash(text: str) -> str:
    return sha256(text.encode("ascii")).hexdigest()


# ---- sweeps inside a task ------------------------------------------------------

def _last(n: int, level: int, idx: int) -> int:
    """Last leaf beneath node ``idx`` of ``level`` in a tree of ``n`` leaves."""
    return min((idx + 1) << (BITS * level), n) - 1


def _count(n: int, level: int) -> int:
    """Nodes of a level."""
    return -(-n >> (BITS * level)) if level else n


def forward_sweep(rows: Iterator[tuple], span: int = SPAN) -> Iterator[tuple]:
    """(tree, n, idx, digest) in order of (tree, idx), whole blocks of
    ``8 ** span`` -> (tree, n, level, idx, children, digest, left): every node
    above, up to ``span`` levels; ``left`` counts the nodes of its level."""
    queue: list[tuple] = []
    for tree, n, idx, digest in rows:
        heapq.heappush(queue, (_last(n, 1, idx >> BITS), 1, idx, digest))
        while queue and queue[0][0] <= idx:  # its last leaf has been taken
            last, level = queue[0][:2]
            children = []
            while queue and queue[0][:2] == (last, level):
                children.append(heapq.heappop(queue)[3])
            children = "".join(children)
            own, node, left = _hash(children), idx >> (BITS * level), _count(n, level)
            yield tree, n, level, node, children, own, left
            if level < span and left > 1:
                heapq.heappush(queue, (_last(n, level + 1, node >> BITS), level + 1, node, own))


def reversed_sweep(rows: Iterator[tuple]) -> Iterator[tuple]:
    """(tree, block, last, level, idx, children, suffix, ...) in order of (tree,
    block) and descending label, the block's own message (a ``suffix``) first ->
    (row, suffix) for every leaf row (level 0)."""
    entered, queue = None, []
    for row in rows:
        tree, block, last, level, idx, children, suffix = row[:7]
        if suffix is not None:  # the message to the block's top node
            entered, queue = suffix, []
            continue
        if entered is not None:
            suffix, entered = entered, None
        else:
            label, suffix = heapq.heappop(queue)
            if label != (-last, -level):
                raise ValueError(f"tree {tree}, block {block}: a message for {label} met node {(last, level)}")
        if level == 0:
            yield row, suffix
            continue
        for i in range(len(children) // HEX):
            own = children[:i * HEX] + "|" + children[(i + 1) * HEX:]
            child = (idx << BITS) + i
            # the last child shares its parent's last leaf
            beneath = last if (i + 1) * HEX == len(children) else ((child + 1) << (BITS * (level - 1))) - 1
            heapq.heappush(queue, ((-beneath, 1 - level), own + ("," + suffix if suffix else "")))


def proof_text(suffix: str) -> str:
    """The siblings of a proof suffix, left to right, level by level."""
    return suffix.replace("|", "").replace(",", "")


def folded(digest: str, suffix: str) -> str:
    """The root that ``digest`` leads to through the siblings of ``suffix``."""
    for level in suffix.split(",") if suffix else ():
        before, after = level.split("|")
        digest = _hash(before + digest + after)
    return digest


def _swept(df: DataFrame, sweep: Callable[[Iterator[tuple]], Iterator[tuple]], schema: str) -> DataFrame:
    """Apply a sweep to the sorted rows of every partition."""
    arrow = to_arrow_schema(T.StructType.fromDDL(schema))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows = (row for b in batches for i in range(0, b.num_rows, SLICE_ROWS)
                for row in zip(*[c.to_pylist() for c in b.slice(i, SLICE_ROWS).columns]))
        out: list[tuple] = []
        for row in sweep(rows):
            out.append(row)
            if len(out) == SLICE_ROWS:
                yield _batch(out, arrow)
                out = []
        if out:
            yield _batch(out, arrow)

    return df.mapInArrow(run, schema)


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(zip(*rows), schema)], schema=schema)


# ---- rounds over blocks --------------------------------------------------------

_NODES = "tree bigint, n bigint, level int, idx bigint, children string, digest string, left bigint"
_ABOVE_ALL = 1 << 62


def fold_rounds(rows: DataFrame, largest: int, span: int = SPAN) -> list[DataFrame]:
    """Forward sweep over (tree, n, idx, digest), ``n`` rows a tree: the nodes made
    by each round, as written tables (levels and ``n`` count from the round's
    rows). Trees of one row need no round."""
    rounds = []
    while largest > 1:
        block = F.shiftright("idx", BITS * span)
        ordered = rows.where(F.col("n") > 1).select("tree", "n", "idx", "digest") \
            .repartition("tree", block).sortWithinPartitions("tree", "idx")
        made = stored(_swept(ordered, lambda r: forward_sweep(r, span), _NODES), "merkle-nodes")
        rounds.append(made)
        rows = _tops(made, span).withColumnRenamed("left", "n")
        largest = _count(largest, span)
    return rounds


def _tops(made: DataFrame, span: int) -> DataFrame:
    """The nodes of a round that the next one goes on with."""
    return made.where((F.col("level") == span) & (F.col("left") > 1)).select("tree", "left", "idx", "digest")


def roots_of(rows: DataFrame, rounds: list[DataFrame]) -> DataFrame:
    """(tree, digest) of every tree's root."""
    out = rows.where(F.col("n") == 1).select("tree", "digest")
    for made in rounds:
        out = out.unionByName(made.where(F.col("left") == 1).select("tree", "digest"))
    return out


def send_down(rounds: list[DataFrame], at_roots: DataFrame, rows: DataFrame,
              finish: Callable[[Iterator[tuple]], Iterator[tuple]], schema: str, span: int = SPAN) -> DataFrame:
    """Reversed sweep: ``at_roots`` (tree, n, suffix) is what the roots receive,
    ``rows`` (tree, idx, and a payload of further columns) the leaves. ``finish``
    maps (row, suffix) pairs, whose row has the payload from place 7 on, to rows
    of ``schema``."""
    messages = None
    for at in range(max(len(rounds), 1) - 1, -1, -1):
        lower = rows if at == 0 else _tops(rounds[at - 1], span).select("tree", "idx")
        most, least = 1 << (BITS * span * (at + 1)), (1 << (BITS * span * at)) if at else 0
        entering = at_roots.where((F.col("n") <= most) & (F.col("n") > least)) \
            .select("tree", F.lit(0).cast("bigint").alias("block"), "suffix")
        if messages is not None:
            entering = entering.unionByName(messages)
        queue = entering.select("tree", "block", F.lit(_ABOVE_ALL).alias("last"), F.lit(span + 1).alias("level"),
                                F.lit(0).cast("bigint").alias("idx"), F.lit("").alias("children"), "suffix")
        none = F.lit(None).cast("string")
        if rounds:
            beneath = F.expr(f"least(shiftleft(idx + 1, {BITS} * level), n) - 1")
            queue = queue.unionByName(rounds[at].select(
                "tree", F.expr(f"shiftright(idx, {BITS} * ({span} - level))").alias("block"),
                beneath.alias("last"), "level", "idx", "children", none.alias("suffix")))
        queue = queue.unionByName(lower.select(
            "tree", F.shiftright("idx", BITS * span).alias("block"), F.col("idx").alias("last"),
            F.lit(0).alias("level"), "idx", none.alias("children"), none.alias("suffix"),
            *[c for c in lower.columns if c not in ("tree", "idx")]), allowMissingColumns=True)
        ordered = queue.repartition("tree", "block").sortWithinPartitions(
            "tree", "block", F.col("last").desc(), F.col("level").desc())
        if at == 0:
            return _swept(ordered, lambda r: finish(reversed_sweep(r)), schema)
        messages = stored(_swept(ordered, _received, "tree bigint, block bigint, suffix string"), "merkle-messages")


def _received(rows: Iterator[tuple]) -> Iterator[tuple]:
    return ((row[0], row[4], suffix) for row, suffix in reversed_sweep(rows))


def _trees_received(pairs: Iterator[tuple]) -> Iterator[tuple]:
    return ((row[7], row[8], suffix) for row, suffix in pairs)


def _verified(pairs: Iterator[tuple]) -> Iterator[tuple]:
    for row, suffix in pairs:
        leaf, changed = row[8], row[9]
        yield row[0], row[7], leaf, _hash(proof_text(suffix)), folded(changed or leaf, suffix)


# ---- the manifest --------------------------------------------------------------

def manifest(docs: DataFrame, columns: Sequence[str] = COLUMNS, id_col: str = "doc_id", group_col: str = "lang",
             text_col: str = "text", tamper: Column | None = None, span: int = SPAN) -> DataFrame:
    """One row per row of ``docs``: ``id_col``, leaf, subroot, root, proof_sha256,
    folded_root, verified. Rows where ``tamper`` holds are folded from the leaf of
    their text with A-Z in lower case."""
    tamper = F.lit(False) if tamper is None else F.coalesce(tamper, F.lit(False))
    lowered = F.translate(F.col(text_col), _UPPER, _UPPER.lower())
    changed = leaf_digest(*[lowered if c == text_col else F.col(c) for c in columns])
    leaves = stored(docs.select(
        F.col(group_col).alias("group"), F.col(id_col).alias("id"),
        leaf_digest(*[F.col(c) for c in columns]).alias("digest"), F.when(tamper, changed).alias("changed")),
        "merkle-leaves")
    # a tree's number is the place of its first leaf: ascending in group order
    placed = global_rank(leaves, [F.col("group").asc_nulls_first(), F.col("id").asc_nulls_first(), "digest"], "place")
    placed = placed.withColumn("_g", F.coalesce(F.concat(F.lit(":"), F.col("group")), F.lit("")))
    trees = placed.groupBy("_g").agg((F.min("place") - 1).alias("tree"), F.count(F.lit(1)).alias("n"))
    trees = stored(trees, "merkle-trees")
    size = trees.agg(F.count(F.lit(1)).alias("trees"), F.max("n").alias("largest"),
                     F.max(F.octet_length("_g")).alias("width")).first()
    rows = placed.join(small(trees, 64 + (size["width"] or 0)), "_g").select(
        "tree", "n", (F.col("place") - 1 - F.col("tree")).alias("idx"), "digest", "id", "changed")
    rows = stored(rows, "merkle-rows")
    rounds = fold_rounds(rows, size["largest"] or 0, span)
    subroots = stored(roots_of(rows, rounds).withColumnRenamed("digest", "subroot"), "merkle-subroots")

    above = global_rank(subroots, [F.col("tree")], "place").select(
        F.lit(-1).cast("bigint").alias("tree"), F.lit(size["trees"]).cast("bigint").alias("n"),
        (F.col("place") - 1).alias("idx"), F.col("subroot").alias("digest"), F.col("tree").alias("of"))
    above = stored(above, "merkle-above")
    above_rounds = fold_rounds(above, size["trees"], span)
    root = roots_of(above, above_rounds).first()

    start = docs.sparkSession.createDataFrame([(-1, size["trees"], "")], "tree bigint, n bigint, suffix string")
    sent = send_down(above_rounds, start, above.select("tree", "idx", "of", "digest"), _trees_received,
                     "tree bigint, subroot string, suffix string", span)
    sent = stored(sent, "merkle-sent").join(trees.select("tree", "n"), "tree")
    kind = leaves.schema["id"].dataType.simpleString()
    out = send_down(rounds, sent.select("tree", "n", "suffix"), rows.select("tree", "idx", "id", "digest", "changed"),
                    _verified, f"tree bigint, `{id_col}` {kind}, leaf string, proof_sha256 string, folded_root string",
                    span)
    whole = F.lit(root["digest"] if root else None).cast("string")
    return out.join(small(subroots, 128), "tree").select(
        id_col, "leaf", "subroot", whole.alias("root"), "proof_sha256", "folded_root",
        (F.col("folded_root") == whole).alias("verified"))


def report(docs: DataFrame) -> DataFrame:
    """The manifest of ``documents``, where rows whose crc32 of the decimal
    ``doc_id`` 3 divides are tampered with."""
    return manifest(docs, tamper=F.crc32(F.col("doc_id").cast("string")) % 3 == 0)
