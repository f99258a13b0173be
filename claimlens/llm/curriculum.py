"""Time-varying curriculum: mixing sources to target weights.

Every source has a weight schedule over training progress 0..1 (piecewise
linear ``(progress, weight)`` knots, dealt to the sources in code-point order,
repeating). The integral of its schedule is the source's weight in the mix:

* targets: the mix holds ``share`` x all words; a source's target is its weight's
  part of them, at most ``max_repeats`` x its words, and what is above that is
  shared again by weight until no source is above;
* demand: by progress ``t`` the mix has asked a source for ``target`` x (integral
  of its schedule up to ``t``) / (whole integral) words;
* positions: a source supplies its documents in a seeded order, pass after pass.
  A document that starts ``w`` words into that supply gets the progress at which
  the demand reaches ``w``: the inverse of the integrated schedule, a quadratic
  per segment;
* training order: the placed documents sorted by range of position.

``mix`` gives every document its passes, ``training_order`` the sorted mix. The
last document of a source's supply is cut where the target is reached, so a
source's words are its target, rounded.

Scale: texts are read once; what follows is a narrow table. Words before a
document come from two levels, running totals inside about sqrt(n) hash buckets of
the source (one shuffle, buckets of about sqrt(n) rows) and running totals of the
buckets, so a source that holds most rows is still spread. Only totals of two
numbers come to the driver.

Defined results: a null text has no words; a document without words takes none
and has no position; a null source is a source of its own, ordered last; rows that
share an id are documents of their own; an empty table gives an empty result.
Only the id, text and source columns are read, so others may have any name.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.llm.common import BROADCAST_BYTES, stored
from claimlens.operators.common import global_rank

#: A word: a run without space, tab or line breaks.
WORD = r"[^\x20\x09-\x0D]+"
#: Weight schedules; their integrals over 0..1 are 5, 2 and 1.
SCHEDULES = (((0.0, 7.0), (0.5, 5.0), (1.0, 3.0)),
             ((0.0, 2.0), (1.0, 2.0)),
             ((0.0, 0.5), (1.0, 1.5)))
#: Words of the mix as a share of all words.
SHARE = 1.5
#: A document is taken at most so often.
MAX_REPEATS = 2
SEED = "curriculum"

Schedule = Sequence[tuple[float, float]]


def integral(schedule: Schedule) -> float:
    """The schedule's weight: its integral over progress 0..1."""
    return sum((b[0] - a[0]) * (a[1] + b[1]) / 2 for a, b in zip(schedule, schedule[1:]))


def progress_at(share: Column, schedule: Schedule) -> Column:
    """Progress at which ``share`` (0..1) of the schedule's integral is reached."""
    total, reached = integral(schedule), 0.0
    out = None
    for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
        part = (t1 - t0) * (w0 + w1) / 2
        rest = share * F.lit(total) - F.lit(reached)
        slope = (w1 - w0) / (t1 - t0)
        # the root of w0 x + slope x^2 / 2 = rest, in the form that needs no division by the slope
        root = F.sqrt(F.greatest(F.lit(0.0), F.lit(w0 * w0) + F.lit(2 * slope) * rest))
        at = F.when(rest <= 0, F.lit(t0)).otherwise(F.lit(t0) + F.lit(2.0) * rest / (F.lit(w0) + root))
        inside = share * F.lit(total) < F.lit(reached + part)
        out = F.when(inside, at) if out is None else out.when(inside, at)
        reached += part
    return F.least(F.lit(1.0), out.otherwise(F.lit(1.0)))


def _fits(df: DataFrame, key: str) -> bool:
    """Whether the rows of ``df``, whose only text is ``key`` twice, fit a broadcast."""
    n = df.agg(F.sum(F.octet_length(key) * 2 + 128).alias("n")).first()["n"]
    return (n or 0) <= BROADCAST_BYTES


def source_targets(sizes: DataFrame, schedules: Sequence[Schedule] = SCHEDULES, share: float = SHARE,
                   max_repeats: int = MAX_REPEATS) -> DataFrame:
    """Targets of the sources of ``sizes(_s, source, size)``: _s, source,
    source_size, n_docs, kind (number of its schedule), weight, target."""
    per = stored(sizes.groupBy("_s", "source").agg(F.sum("size").alias("source_size"),
                                                   F.count(F.lit(1)).alias("n_docs")), "mix-sources")
    weights = F.array(*[F.lit(integral(s)) for s in schedules])
    ranked = global_rank(per, [F.col("source").asc_nulls_last()], "_rank") \
        .withColumn("kind", ((F.col("_rank") - 1) % len(schedules)).cast("int")) \
        .withColumn("weight", F.element_at(weights, F.col("kind") + 1)) \
        .withColumn("_most", F.col("source_size") * max_repeats).drop("_rank")
    ranked = stored(ranked, "mix-weights")
    first = ranked.agg(F.sum("source_size").alias("size"), F.sum("weight").alias("weight")).first()
    words = share * (first["size"] or 0)
    level = words / first["weight"] if first["weight"] else 0.0
    while True:  # every turn puts at least one more source at its most
        above = F.lit(level) * F.col("weight") > F.col("_most")
        now = ranked.agg(F.sum(F.when(above, F.col("_most"))).alias("full"),
                         F.sum(F.when(~above, F.col("weight"))).alias("weight")).first()
        if not now["weight"]:
            break
        raised = (words - (now["full"] or 0)) / now["weight"]
        if raised <= level:
            break
        level = raised
    target = F.least(F.lit(level) * F.col("weight"), F.col("_most").cast("double"))
    return ranked.withColumn("target", target).drop("_most")


def mix(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", source_col: str = "source",
        schedules: Sequence[Schedule] = SCHEDULES, share: float = SHARE, max_repeats: int = MAX_REPEATS,
        seed: str = SEED) -> DataFrame:
    """One row per document: ``id_col``, source, size, source_size, target,
    kind and ``passes``, an array of (pass, words, position) of the times it is
    taken (empty if never). ``position`` is the progress, 0 to 1."""
    text = F.col(text_col)
    seeded = F.concat_ws(":", F.coalesce(F.col(id_col).cast("string"), F.lit("-")), F.lit(seed),
                         F.coalesce(text, F.lit("")))
    rows = stored(docs.select(
        F.col(id_col).alias("_id"), F.col(source_col).alias("source"),
        F.coalesce(F.concat(F.lit(":"), F.col(source_col)), F.lit("")).alias("_s"),
        F.coalesce(F.regexp_count(text, F.lit(WORD)), F.lit(0)).cast("bigint").alias("size"),
        F.md5(seeded).alias("_key")), "mix-rows")
    targets = source_targets(rows, schedules, share, max_repeats).drop("source")
    targets = stored(targets, "mix-targets")
    if _fits(targets, "_s"):
        targets = F.broadcast(targets)
    # the bucket follows the key, so buckets in order and keys in order inside are the order of keys
    top = F.conv(F.substring("_key", 1, 8), 16, 10).cast("bigint")
    n_buckets = F.ceil(F.sqrt(F.col("n_docs").cast("double")))
    placed = rows.join(targets, "_s").withColumn(
        "_bucket", F.shiftright(top * F.least(n_buckets, F.lit((1 << 30))), 32))
    totals = placed.groupBy("_s", "_bucket").agg(F.sum("size").alias("_words"))
    earlier = Window.partitionBy("_s").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = totals.select("_s", "_bucket", F.coalesce(F.sum("_words").over(earlier), F.lit(0)).alias("_start"))
    inside = Window.partitionBy("_s", "_bucket").orderBy("_key", "_id", "size") \
        .rowsBetween(Window.unboundedPreceding, -1)
    before = F.col("_start") + F.coalesce(F.sum("size").over(inside), F.lit(0))
    wanted = F.round(F.col("target")).cast("bigint")
    return placed.join(starts, ["_s", "_bucket"]).withColumn("_before", before).select(
        F.col("_id").alias(id_col), "source", "size", "source_size", "target", "kind",
        _passes(F.col("_before"), wanted, schedules, max_repeats).alias("passes"))


def _passes(before: Column, wanted: Column, schedules: Sequence[Schedule], max_repeats: int) -> Column:
    def one(number: int) -> Column:
        start = before + F.lit(number) * F.col("source_size")
        words = F.greatest(F.lit(0), F.least(F.col("size"), wanted - start)).cast("bigint")
        reached = F.try_divide(start, wanted)
        position = F.lit(None).cast("double")
        for kind, schedule in enumerate(schedules):
            position = F.when(F.col("kind") == kind, progress_at(reached, schedule)).otherwise(position)
        position = F.when(words > 0, position)
        return F.struct(F.lit(number).alias("pass"), words.alias("words"), position.alias("position"))

    return F.filter(F.array(*[one(i) for i in range(max_repeats)]), lambda p: p["words"] > 0)


def training_order(mixed: DataFrame, id_col: str = "doc_id") -> DataFrame:
    """The mix in training order: one row per pass of a document (``id_col``,
    source, pass, words, position), sorted by ranges of position."""
    return mixed.select(id_col, "source", F.explode("passes").alias("p")) \
        .select(id_col, "source", "p.*") \
        .orderBy("position", F.col("source").asc_nulls_last(), "pass", id_col)


def report(docs: DataFrame, **options) -> DataFrame:
    """``mix`` per document: doc_id, size, source_size, target, taken (words,
    repeats counted) and position of its first pass (nine digits), sorted by
    ranges of position; documents that are not taken come last."""
    mixed = stored(mix(docs, **options), "mix")
    taken = F.aggregate("passes", F.lit(0).cast("bigint"), lambda n, p: n + p["words"])
    first = F.round(F.try_element_at("passes", F.lit(1))["position"], 9)
    return mixed.select("doc_id", "size", "source_size", "target", taken.alias("taken"), first.alias("position")) \
        .orderBy(F.col("position").asc_nulls_last(), "doc_id")
