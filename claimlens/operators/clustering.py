"""Cosine k-means over sparse points.

Points are rows that hold their vector (feature rows, dense arrays, vectors):
norm, distances and assignment come from a fold inside the row, and a centroid
update adds whole vectors up, one partial sum a task and cluster. Centroids are at
most ``k x n_features`` values (a bound fixed by the parameters, not by the data).
``cosine_assign`` and ``cosine_update`` do the same for long-form points ``(id,
idx, value)``. The fit itself is MLlib's distributed ``KMeans`` with the cosine
measure.
"""

from __future__ import annotations

import math
from collections.abc import Callable

from pyspark.ml.clustering import KMeans, KMeansModel
from pyspark.ml.feature import Normalizer
from pyspark.ml.functions import vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from claimlens.functions import double_array, safe_div
from claimlens.operators import features as fe
from claimlens.operators.common import iteration_input


def embedding_long(df: DataFrame, id_col: str = "vec_id", vec_col: str = "embedding") -> DataFrame:
    """Dense array column -> long form (id, idx, value as double)."""
    return df.select(F.col(id_col).alias("id"), F.posexplode(vec_col).alias("idx", "v")) \
        .select("id", F.col("idx").cast("int").alias("idx"), F.col("v").cast("double").alias("value"))


def norms(points: DataFrame, key: str = "id") -> DataFrame:
    """Euclidean norm per ``key`` of long-form (key, idx, value) vectors."""
    return points.groupBy(key).agg(F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("norm"))


def cosine_assign(points: DataFrame, centroids: DataFrame, k: int) -> DataFrame:
    """Nearest centroid of every point by cosine distance, and the distance.

    ``points``: (id, idx, value); ``centroids``: (cluster, idx, value) with
    clusters 0..k-1. distance = 1 - dot / (|p| |c|), clamped to [0, 2]
    against rounding; a zero vector has
    distance NULL to everything and takes cluster 0. Ties go to the lower
    cluster number. Output: id, cluster, distance.

    Plan: the centroids are pivoted to one row per slot with k value
    columns (at most n_features rows: broadcast); each point's norm and its
    k dot products come from one aggregate by ``id``.
    """
    cols = [f"c{c}" for c in range(k)]
    wide = centroids.groupBy("idx").pivot("cluster", list(range(k))).agg(F.sum("value"))
    wide = wide.select("idx", *[F.col(str(c)).alias(name) for c, name in zip(range(k), cols)])
    # The k centroid norms: k numbers, computed once on the driver.
    cn = {r.cluster: r.norm for r in norms(centroids, "cluster").collect()}
    per_point = points.join(F.broadcast(wide), "idx", "left").groupBy("id").agg(
        F.sqrt(F.sum(F.col("value") * F.col("value"))).alias("norm"),
        *[F.sum(F.col("value") * F.coalesce(F.col(name), F.lit(0.0))).alias(f"dot{c}")
          for c, name in enumerate(cols)])
    candidates = [_candidate(F.col(f"dot{c}"), F.col("norm"), cn.get(c), c) for c in range(k)]
    best = F.array_min(F.array(*candidates))
    return per_point.select("id", best["cluster"].alias("cluster"),
                            best["distance"].alias("distance"))


def assign_features(features: DataFrame, centroids: DataFrame, k: int, n_features: int,
                    keep: tuple[str, ...] = ("id", "review"), vector: str | None = None, **probes) -> DataFrame:
    """J5 for feature rows, inside the row: ``keep`` columns, cluster,
    distance and norm, and the hashed vector (J2) as ``vector`` if named. Same
    distances and ties as ``cosine_assign``; one result per feature row, no shuffle.
    The centroids (k x n_features values, a bound fixed by the parameters) travel
    with the function.
    """
    return _assign_rows(features, lambda dense: fe.row_folds(n_features, dense, vector is not None, **probes),
                        centroids, k, n_features, keep, vector)


def assign_arrays(df: DataFrame, vec_col: str, centroids: DataFrame, k: int, n_features: int,
                  keep: tuple[str, ...] = ("id",)) -> DataFrame:
    """J5 for dense array columns, inside the row: ``keep`` columns, cluster,
    distance and norm. Null components count as 0; null arrays drop."""
    pairs = F.transform(vec_col, lambda v, i: F.struct(
        i.alias("idx"), F.coalesce(v.cast("double"), F.lit(0.0)).alias("value")))
    return _assign_rows(df.where(F.col(vec_col).isNotNull()),
                        lambda dense: fe.norm_and_dots(pairs, [double_array(d) for d in dense]),
                        centroids, k, n_features, keep)


def _assign_rows(df: DataFrame, fold: Callable[[list[list[float]]], Column], centroids: DataFrame, k: int,
                 n_features: int, keep: tuple[str, ...], vector: str | None = None) -> DataFrame:
    dense = {c: [0.0] * n_features for c in range(k)}
    for r in centroids.collect():
        dense[r.cluster][r.idx] += r.value
    rows = df.withColumn("_fold", fold([dense[c] for c in range(k)]))
    norm = F.col("_fold.norm")
    candidates = [_candidate(F.col("_fold.dots")[c], norm, math.sqrt(sum(v * v for v in dense[c])), c)
                  for c in range(k)]
    best = F.array_min(F.array(*candidates))
    return rows.select(*keep, best["cluster"].alias("cluster"), best["distance"].alias("distance"), norm.alias("norm"),
                       *([F.col("_fold.vector").alias(vector)] if vector else []))


def _candidate(dot, norm, size: float | None, c: int):
    # 1 - cos, clamped to [0, 2]: rounding can push cos a hair past +-1
    d = F.least(F.lit(2.0), F.greatest(F.lit(0.0), F.lit(1.0) - safe_div(dot, norm * F.lit(size)))) \
        if size else F.lit(None).cast("double")
    return F.struct(d.isNull().alias("missing"), d.alias("distance"), F.lit(c).alias("cluster"))


def cosine_update(points: DataFrame, assignment: DataFrame) -> DataFrame:
    """One centroid update: per cluster, the mean of its members' unit
    vectors (the direction is what cosine distance sees).

    Output: cluster, idx, value. Zero vectors are left out.
    """
    pn = norms(points).where(F.col("norm") > 0)
    members = assignment.select("id", "cluster").join(pn, "id")
    sizes = members.groupBy("cluster").agg(F.count(F.lit(1)).alias("size"))
    sums = points.join(members, "id") \
        .groupBy("cluster", "idx").agg(F.sum(F.col("value") / F.col("norm")).alias("s"))
    return sums.join(F.broadcast(sizes), "cluster") \
        .select("cluster", "idx", (F.col("s") / F.col("size")).alias("value"))


def vector_update(assigned: DataFrame, features_col: str = "features", sparse: bool = True) -> DataFrame:
    """One centroid update from rows that hold their vector: the mean of each
    cluster's unit vectors. ``assigned``: cluster, norm and ``features_col``.

    Every task adds its rows to one dense vector a cluster, so what is exchanged
    is at most k vectors a task, whatever the number of terms. Zero vectors are
    left out. Output: cluster, idx, value (without zeros if ``sparse``).
    """
    unit = Normalizer(p=2.0, inputCol=features_col, outputCol="_unit").transform(
        assigned.where(F.col("norm") > 0).select("cluster", features_col))
    means = unit.groupBy("cluster").agg(Summarizer.mean(F.col("_unit")).alias("_mean"))
    out = means.select("cluster", F.posexplode(vector_to_array("_mean")).alias("idx", "value"))
    return out.where(F.col("value") != 0) if sparse else out


def seed_centroids(points: DataFrame, seeds: DataFrame) -> DataFrame:
    """Centroids from chosen seed points ``seeds(id, cluster)``."""
    return points.join(F.broadcast(seeds.select("id", "cluster")), "id") \
        .select("cluster", "idx", "value")


def fit_cosine_kmeans(vectors: DataFrame, k: int = 2, max_iter: int = 10, tol: float = 1e-3,
                      seed: int = 42, features_col: str = "features", id_col: str = "id",
                      rows_per_partition: int = 100_000) -> KMeansModel:
    """MLlib k-means with cosine distance, random seeded start.

    The start is drawn from the input's partitions, so the input is laid
    out by ``id_col`` first: same data and seed, same model, whatever the
    cluster's parallelism.
    """
    km = KMeans(k=k, maxIter=max_iter, tol=tol, seed=seed, initMode="random",
                distanceMeasure="cosine", featuresCol=features_col, predictionCol="cluster")
    data = iteration_input(vectors.select(id_col, features_col), rows_per_partition, id_col)
    try:
        return km.fit(data)
    finally:
        data.unpersist()


def centroids_long(model: KMeansModel, spark: SparkSession) -> DataFrame:
    """The model's centers as (cluster, idx, value), non-zero entries only.

    Bounded by k x n_features: built on the driver from the model.
    """
    rows = []
    for c, center in enumerate(model.clusterCenters()):
        rows.extend((c, int(i), float(v)) for i, v in enumerate(center) if v != 0.0)
    return spark.createDataFrame(rows, "cluster int, idx int, value double")


def crosstab(clustered: DataFrame, k: int, labels: tuple[int, ...] | None = (0, 1)) -> DataFrame:
    """Points per (cluster, label), with % of the cluster and % of the
    label. Empty cells are kept with count 0; 0/0 shares are NULL.

    The grid is every cluster 0..k-1 for each label in ``labels`` (or each
    label seen, when ``labels`` is None), generated per label by exploding
    a sequence (no cross join).
    """
    spark = clustered.sparkSession
    counts = clustered.groupBy("cluster", "label").agg(F.count(F.lit(1)).alias("n"))
    if labels is None:
        label_rows = counts.select("label").distinct()
    else:
        label_rows = spark.range(1).select(F.explode(F.array(*[F.lit(int(x)) for x in labels])).alias("label"))
    grid = label_rows.withColumn("cluster", F.explode(F.sequence(F.lit(0), F.lit(k - 1))))
    cells = grid.join(counts, ["cluster", "label"], "left") \
        .withColumn("n", F.coalesce("n", F.lit(0)).cast("bigint"))
    by_cluster = Window.partitionBy("cluster")
    by_label = Window.partitionBy("label")
    return cells.select(
        "cluster", "label", "n",
        (F.lit(100.0) * safe_div(F.col("n"), F.sum("n").over(by_cluster))).alias("pct_of_cluster"),
        (F.lit(100.0) * safe_div(F.col("n"), F.sum("n").over(by_label))).alias("pct_of_label"))


def negative_clusters(table: DataFrame, positive_label: int = 1) -> DataFrame:
    """Every cluster but the one with most ``positive_label`` points.

    ``table`` is ``crosstab``'s output (k rows per label). Ties on the count
    go to the higher cluster number. For k = 2 this is one row: the other
    cluster. Output: negative_cluster (int).
    """
    ones = table.where(F.col("label") == positive_label).select("cluster", "n")
    first = Window.orderBy(F.col("n").desc(), F.col("cluster").desc())
    return ones.withColumn("_r", F.row_number().over(first)).where(F.col("_r") > 1) \
        .select(F.col("cluster").alias("negative_cluster"))


def label_points(assignment: DataFrame, labels: DataFrame, id_col: str = "id",
                 label_col: str = "label") -> DataFrame:
    """Attach each point's label (by id) to its cluster assignment."""
    return assignment.join(labels.select(F.col(id_col).alias("id"),
                                         F.col(label_col).alias("label")), "id")
