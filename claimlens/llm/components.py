"""Connected components by minimum hooking, pointer jumping and contraction.

Every step is a DataFrame join or aggregate over written tables; nothing
that grows with the graph reaches the driver or one task. A node with very
many edges is combined map-side (``min``) and its join partitions are
split by the skew-join rule.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import stored


def _compressed(parent: DataFrame) -> DataFrame:
    """Follow ``u -> p`` pointers until every pointer ends at a root."""
    while True:
        up = parent.select(F.col("u").alias("p"), F.col("p").alias("pp"))
        parent = stored(parent.select("u", "p").join(up, "p").select(
            "u", F.col("pp").alias("p"), (F.col("pp") != F.col("p")).alias("moved")), "jump")
        if parent.where("moved").isEmpty():
            return parent.select("u", "p")


def connected_components(edges: DataFrame) -> DataFrame:
    """``edges`` (a, b: bigint) -> (node, component) for every node with an
    edge to another node; ``component`` is the smallest node of its group.

    Each round hooks every node to its smallest neighbour (always smaller,
    so no cycle), jumps pointers to the roots and contracts the edges; at
    least half of the non-isolated nodes vanish a round. Null ends and loops
    are ignored, repeated edges are merged; no edges give no rows.
    """
    def clean(e: DataFrame) -> DataFrame:
        return e.where("a <> b").select(F.least("a", "b").alias("a"),
                                        F.greatest("a", "b").alias("b")).distinct()

    e = stored(clean(edges), "edges")
    labels = None
    while labels is None or not e.isEmpty():
        both = e.union(e.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hook = both.groupBy(F.col("a").alias("u")).agg(F.min("b").alias("m"))
        roots = _compressed(hook.select("u", F.least("u", "m").alias("p")))
        if labels is None:
            labels = roots.select(F.col("u").alias("node"), F.col("p").alias("component"))
        else:
            step = roots.select(F.col("u").alias("component"), "p")
            labels = stored(labels.join(step, "component", "left").select(
                "node", F.coalesce("p", "component").alias("component")), "labels")
        ra = roots.select(F.col("u").alias("a"), F.col("p").alias("pa"))
        rb = roots.select(F.col("u").alias("b"), F.col("p").alias("pb"))
        e = stored(clean(e.join(ra, "a").join(rb, "b").select(
            F.col("pa").alias("a"), F.col("pb").alias("b"))), "edges")
    return labels
