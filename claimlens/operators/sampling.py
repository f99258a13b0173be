"""Seeded sampling and the sample-shaped unions.

``seeded_sample(df, n)`` returns exactly the ``n`` rows with the smallest
``(md5(id:seed), id)``: repeatable, independent of partitioning, and the same
rows DuckDB picks with ``ORDER BY md5(..), id LIMIT n``.

The input is evaluated once. The keys are uniform, so the plan's own size estimate
gives a key below which about ``OVERDRAW`` times too many rows lie; rows below it
are written as candidates. The exact n-th key is then looked up among them (counts
by key range, one range looked into), and they are *filtered* on it, so the sample
keeps their partitions. Only if the estimate was far too high, and fewer than ``n``
candidates came, is the input evaluated again, with the share they tell. Nothing is
sorted whole or gathered in one task.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from claimlens.functions import seeded_key
from claimlens.operators.common import materialize, measured, within

#: Candidates aimed at, as a multiple of the sample.
OVERDRAW = 16
#: Bytes of a row assumed with the plan's size estimate.
ROW_BYTES = 128
#: Sizes from here on are the optimizer's stand-in for "not known".
_UNKNOWN = 1 << 62
_RANGES = 1 << 16
_DIGITS = 13    # hex digits of a key that fit a number: 52 bits


def first_share(df: DataFrame, n: int) -> float:
    """Share of the keys to keep at first, from the optimizer's size estimate; one
    in ``OVERDRAW`` where there is none."""
    try:
        size = int(df._jdf.queryExecution().optimizedPlan().stats().sizeInBytes())
    except Exception:  # no JVM plan, e.g. a Spark Connect session
        return 1 / OVERDRAW
    if size >= _UNKNOWN:
        return 1 / OVERDRAW
    return min(1.0, OVERDRAW * n * ROW_BYTES / max(1, size))


def _share_of(n: int, rows: float) -> float:
    """Share of the keys that holds ``n`` of ``rows`` rows, with room for chance."""
    return min(1.0, 1.5 * (n + 10 * math.sqrt(n)) / rows)


def _below(share: float) -> Column:
    """Whether the key lies in the first ``share`` of the key space."""
    return F.col("_key") < F.lit(f"{int(share * 16 ** _DIGITS):0{_DIGITS}x}")


def sample_with(df: DataFrame, n: int, seed: int | str = 0, id_col: str = "id",
                always: Column | None = None, pool: Column | None = None,
                pool_rows: int | None = None) -> DataFrame:
    """Every row where ``always`` holds, and the ``n`` rows first in
    ``(md5(id:seed), id)`` order among those where ``pool`` holds (default: all);
    all of them if fewer. Rows that share the n-th row's id are kept together.
    ``pool_rows``, about how many rows ``pool`` has, says better than the plan's size how
    many candidates to write; the sample does not depend on it."""
    always = F.lit(False) if always is None else F.coalesce(always, F.lit(False))
    pool = F.lit(True) if pool is None else F.coalesce(pool, F.lit(False))
    keyed = df.withColumns({"_key": seeded_key(id_col, seed), "_always": always, "_pool": pool & ~always})
    share = (_share_of(n, pool_rows) if pool_rows else first_share(df, n)) if n > 0 else 0.0
    in_pool = F.col("_pool") & F.col("_key").isNotNull()
    while True:
        drawn = F.lit(n > 0) if share >= 1 else _below(share)
        table = materialize(keyed.where(F.col("_always") | (F.col("_pool") & drawn)), "sample")
        found = table.where(in_pool).count() if n > 0 else 0
        if share >= 1 or found >= n:
            break
        # found / share tells about how many rows there are: draw again
        share = min(1.0, max(2.0 * share, _share_of(n, found / share))) if found else 1.0
    chosen = F.lit(n > 0) if found <= n else _up_to(table.where(in_pool), n, min(1.0, share), id_col)
    return table.where(F.col("_always") | (F.col("_pool") & chosen)).drop("_key", "_always", "_pool")


def _up_to(table: DataFrame, n: int, share: float, id_col: str) -> Column:
    """Condition that holds for the first ``n`` rows (and those of the n-th's id)."""
    number = F.conv(F.substring("_key", 1, _DIGITS), 16, 10).cast("double")
    at = F.least(F.lit(_RANGES - 1), F.floor(number * (_RANGES / (share * 16.0 ** _DIGITS))))
    counts = sorted((r["at"], r["n"]) for r in
                    table.groupBy(at.alias("at")).agg(F.count(F.lit(1)).alias("n")).collect())
    before, i = 0, 0
    while before + counts[i][1] < n:
        before, i = before + counts[i][1], i + 1
    # the n-th row lies in this range, about one in 65,536 of the candidates
    last = table.where(at == counts[i][0]).select("_key", id_col).orderBy("_key", id_col) \
        .limit(n - before).orderBy(F.col("_key").desc(), F.col(id_col).desc()).first()
    return (F.col("_key") < last["_key"]) | ((F.col("_key") == last["_key"]) & (F.col(id_col) <= F.lit(last[id_col])))


def seeded_sample(df: DataFrame, n: int, seed: int | str = 0, id_col: str = "id") -> DataFrame:
    """The ``n`` rows first in ``(md5(id:seed), id)`` order (all if fewer).

    Rows that share the n-th row's id are kept together with it.
    """
    return sample_with(df, n, seed, id_col)


def seed_points(df: DataFrame, k: int, seed: int | str = 0, id_col: str = "id") -> DataFrame:
    """``k`` seeded starting points, numbered 0..k-1 as ``cluster``."""
    picked = seeded_sample(df.select(id_col).distinct(), k, seed, id_col)
    return picked.withColumn(
        "cluster",
        (F.row_number().over(Window.orderBy(seeded_key(id_col, seed), id_col)) - 1).cast("int"))


def cap_rows(df: DataFrame, max_rows: int | None, seed: int | str = 0,
             id_col: str = "id") -> DataFrame:
    """At most ``max_rows`` rows, chosen as a fair seeded sample."""
    return df if max_rows is None else seeded_sample(df, max_rows, seed, id_col)


def positives_plus_sample(df: DataFrame, n: int, seed: int | str = 0, flag: str = "review",
                          id_col: str = "id") -> DataFrame:
    """H2: every flagged row plus ``n`` seeded unflagged rows."""
    return sample_with(df, n, seed, id_col, F.col(flag) == 1, F.col(flag) == 0)


def clustering_sample(features: DataFrame, n: int, seed: int | str = 0) -> DataFrame:
    """A sampled clustering input: all flagged patients + ``n`` unflagged ones."""
    return positives_plus_sample(features, n, seed)


def _negative_ids(clustered: DataFrame, negative: int | list[int] | DataFrame,
                  max_broadcast_rows: int) -> tuple[DataFrame, int | None]:
    """Ids of unflagged points in the negative cluster(s) (C3, A13 shape), and how many
    (None where they were not counted, with a bound of 0).

    ``negative`` is a cluster number, a list of them, or a DataFrame with a
    ``negative_cluster`` column (then a semi-join).
    """
    neg = clustered.where(F.col("label") == 0)
    if isinstance(negative, DataFrame):
        neg = neg.join(negative.select(F.col("negative_cluster").alias("cluster")),
                       "cluster", "left_semi")
    elif isinstance(negative, (list, tuple)):
        neg = neg.where(F.col("cluster").isin(list(negative)))
    else:
        neg = neg.where(F.col("cluster") == F.lit(negative))
    # Broadcast after a check, so the feature table is not shuffled for this;
    # above the bound, neither is a table in buckets of the same number.
    ids = neg.select(F.col("patient_id").alias("id")).distinct()
    if max_broadcast_rows <= 0:
        return ids, None
    size = measured(ids)
    return (F.broadcast(ids) if within(size, max_broadcast_rows) else ids), size["rows"]


def training_set(features: DataFrame, clustered: DataFrame,
                 negative: int | list[int] | DataFrame,
                 n: int = 50_000, seed: int | str = 0, max_broadcast_rows: int = 2_000_000) -> DataFrame:
    """All flagged + ``n`` sampled unflagged of the negative cluster.

    The restriction to the cluster (D4) is a join that marks the candidates, so the
    features are read once for both halves.
    """
    marks, rows = _negative_ids(clustered, negative, max_broadcast_rows)
    marked = features.join(marks.withColumn("_candidate", F.lit(True)), "id", "left")
    return sample_with(marked, n, seed, "id", F.col("review") == 1,
                       (F.col("review") == 0) & F.col("_candidate"), rows).drop("_candidate")


def scoring_set(features: DataFrame, clustered: DataFrame,
                negative: int | list[int] | DataFrame, max_broadcast_rows: int = 2_000_000) -> DataFrame:
    """Unflagged patients not among the negative cluster's points
    (including those never sampled for clustering): an anti-join."""
    return features.where(F.col("review") == 0) \
        .join(_negative_ids(clustered, negative, max_broadcast_rows)[0], "id", "left_anti")
