"""Cosine assignment, cross-tab and cluster choice."""

import numpy as np
from pyspark.sql import functions as F

from claimlens.operators import clustering as ck


def test_cosine_assign_matches_numpy(spark):
    rng = np.random.default_rng(0)
    pts = rng.normal(size=(60, 5))
    cents = rng.normal(size=(3, 5))
    long = [(int(i), int(j), float(pts[i, j])) for i in range(60) for j in range(5)]
    clong = [(int(c), int(j), float(cents[c, j])) for c in range(3) for j in range(5)]
    p = spark.createDataFrame(long, "id long, idx int, value double")
    c = spark.createDataFrame(clong, "cluster int, idx int, value double")
    got = {r.id: (r.cluster, r.distance) for r in ck.cosine_assign(p, c, 3).collect()}
    sim = (pts @ cents.T) / np.outer(np.linalg.norm(pts, axis=1), np.linalg.norm(cents, axis=1))
    dist = 1 - sim
    for i in range(60):
        assert got[i][0] == int(np.argmin(dist[i]))
        assert abs(got[i][1] - dist[i].min()) < 1e-12


def test_crosstab_keeps_empty_cells(spark):
    clustered = spark.createDataFrame([(0, 0), (0, 0), (1, 0)], "cluster int, label int")
    t = {(r.cluster, r.label): r for r in ck.crosstab(clustered, 3).collect()}
    assert len(t) == 6
    assert t[(0, 1)].n == 0 and t[(0, 0)].pct_of_cluster == 100.0
    assert t[(2, 0)].n == 0 and t[(2, 0)].pct_of_cluster is None  # empty cluster
    assert t[(0, 1)].pct_of_label is None                          # no label-1 points


def test_negative_cluster_tie_goes_to_higher_positive(spark):
    clustered = spark.createDataFrame([(0, 1), (1, 1), (0, 0)], "cluster int, label int")
    neg = [r.negative_cluster for r in ck.negative_clusters(ck.crosstab(clustered, 2)).collect()]
    assert neg == [0]  # tie on label-1 counts: cluster 1 is positive


def test_update_is_mean_unit_vector(spark):
    p = spark.createDataFrame([(1, 0, 3.0), (1, 1, 4.0), (2, 0, 2.0)], "id long, idx int, value double")
    a = spark.createDataFrame([(1, 0), (2, 0)], "id long, cluster int")
    got = {(r.cluster, r.idx): r.value for r in ck.cosine_update(p, a).collect()}
    assert abs(got[(0, 0)] - (0.6 + 1.0) / 2) < 1e-12 and abs(got[(0, 1)] - 0.4) < 1e-12


def test_mllib_cosine_kmeans_recovers_directions(spark):
    """J4 on a small fixture: two groups of vectors pointing in clearly
    different directions (lengths vary, which cosine ignores)."""
    from pyspark.ml.linalg import SparseVector
    rng = np.random.default_rng(3)
    rows = []
    for i in range(40):
        base = [1.0, 0.05, 0.0] if i % 2 == 0 else [0.0, 0.05, 1.0]
        v = (np.array(base) + rng.normal(0, 0.05, 3)).clip(0) * rng.uniform(0.5, 20)
        rows.append((str(i), SparseVector(3, [0, 1, 2], v.tolist())))
    df = spark.createDataFrame(rows, ["id", "features"])
    model = ck.fit_cosine_kmeans(df, k=2, max_iter=10, seed=1)
    pred = {r.id: r.cluster for r in model.transform(df).collect()}
    even = {pred[str(i)] for i in range(0, 40, 2)}
    odd = {pred[str(i)] for i in range(1, 40, 2)}
    assert len(even) == 1 and len(odd) == 1 and even != odd
    # the long-form assignment against the model's centers agrees with MLlib
    long = spark.createDataFrame(
        [(r[0], int(j), float(x)) for r in rows for j, x in zip(r[1].indices, r[1].values)],
        "id string, idx int, value double")
    mine = {r.id: r.cluster for r in ck.cosine_assign(long, ck.centroids_long(model, spark), 2).collect()}
    assert mine == pred


def test_negative_clusters_for_k3(spark):
    clustered = spark.createDataFrame(
        [(0, 1), (1, 1), (1, 1), (2, 0), (2, 1)], "cluster int, label int")
    neg = sorted(r.negative_cluster for r in ck.negative_clusters(ck.crosstab(clustered, 3)).collect())
    assert neg == [0, 2]  # cluster 1 has most label-1 points


def test_vector_update_equals_the_long_form(spark):
    """Row-local assignment and whole-vector update against the long form."""
    from pyspark.ml.functions import array_to_vector
    rng = np.random.default_rng(1)
    pts = [rng.normal(size=6).tolist() for _ in range(50)] + [[0.0] * 6, [None, 1.0, 0.0, 0.0, 0.0, 2.0], None]
    df = spark.createDataFrame([(i, p) for i, p in enumerate(pts)], "vec_id long, embedding array<double>").repartition(3)
    cents = spark.createDataFrame([(c, j, float(rng.normal())) for c in range(3) for j in range(6)],
                                  "cluster int, idx int, value double")
    long = ck.embedding_long(df).where("value is not null")
    old = ck.cosine_assign(long, cents, 3)
    vectors = df.withColumn("features", array_to_vector(F.transform("embedding", lambda v: F.coalesce(v, F.lit(0.0)))))
    new = ck.assign_arrays(vectors, "embedding", cents, 3, 6, ("vec_id", "features"))
    want = {r.id: (r.cluster, r.distance) for r in old.collect()}
    got = {r.vec_id: (r.cluster, r.distance) for r in new.collect()}
    assert set(want) == set(got) == set(range(52))
    for i, (c, d) in want.items():
        assert got[i][0] == c and (d is None) == (got[i][1] is None) and (d is None or abs(d - got[i][1]) < 1e-12)
    a = {(r.cluster, r.idx): r.value for r in ck.cosine_update(long, old).collect()}
    b = {(r.cluster, r.idx): r.value for r in ck.vector_update(new, sparse=False).collect()}
    assert set(a) == set(b) and max(abs(a[k] - b[k]) for k in a) < 1e-12


def test_vector_update_ships_vectors_only(spark):
    """Below the exchange there is a partial sum per cluster and no exploded term."""
    df = spark.createDataFrame([(0, 1.0, [1.0, 2.0])], "cluster int, norm double, embedding array<double>")
    from pyspark.ml.functions import array_to_vector
    plan = ck.vector_update(df.withColumn("features", array_to_vector("embedding")))._jdf.queryExecution() \
        .executedPlan().toString()
    below = plan[plan.index("Exchange"):]
    assert plan.count("Exchange hashpartitioning(cluster") == 1
    assert "partial_" in below and "Generate" not in below
