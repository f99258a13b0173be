"""Part 3 end to end: features -> clustering -> training/scoring -> top n.

One Spark application replaces the source's chain of jobs and shell steps.
Intermediate tables are written as Parquet under the shared checkpoint
folder (lineage cut, durable if executors are lost). Only the centroids,
the coefficients (both bounded by k x slots) and the negative cluster
numbers (at most k) reach the driver.
"""

from __future__ import annotations

from dataclasses import dataclass, field

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from claimlens.operators import classify as cl
from claimlens.operators import clustering as ck
from claimlens.operators import features as fe
from claimlens.operators import sampling as sa
from claimlens.operators.common import materialize, store_bucketed
from claimlens.session import scratch_path
from claimlens.sinks import write_partitioned, write_scores, write_vectors


@dataclass
class Part3Config:
    cluster_sample: int | None = None  # unflagged patients sampled for clustering (None: all)
    training_sample: int = 50_000     # unflagged negatives sampled for training
    k: int = 2
    max_iter: int = 10
    tol: float = 1e-3
    n_features: int = fe.N_FEATURES
    claim_probes: int = fe.CLAIM_PROBES
    word_probes: int = fe.WORD_PROBES
    reg: float = cl.L1_REG
    top_n: int = 10_000
    seed: int = 42
    dedupe: bool = False
    #: Hash buckets by patient id of the stored features and clusters, so that their
    #: joins shuffle neither also where the ids are too many to broadcast.
    buckets: int | None = None


@dataclass
class Part3Result:
    features: DataFrame
    clustered: DataFrame
    crosstab: DataFrame
    negative: list[int]
    training: DataFrame
    scoring: DataFrame
    scored: DataFrame
    suspicious: DataFrame
    coefficients: DataFrame
    quality: DataFrame
    extra: dict = field(default_factory=dict)


def _hash_kw(cfg: Part3Config) -> dict:
    return {"n_features": cfg.n_features, "claim_probes": cfg.claim_probes,
            "word_probes": cfg.word_probes}


def cluster_patients(sample: DataFrame, cfg: Part3Config) -> tuple[DataFrame, object]:
    """Fit cosine k-means on the sample; every sampled patient's
    cluster, label (review flag) and distance. Output: patient_id, cluster,
    label, distance."""
    spark = sample.sparkSession
    path = scratch_path(spark, "clustering-vectors")
    write_vectors(fe.hash_features(sample, **_hash_kw(cfg)), path)          # B7
    vectors = spark.read.parquet(path)
    model = ck.fit_cosine_kmeans(vectors, cfg.k, cfg.max_iter, cfg.tol, cfg.seed)
    clustered = ck.assign_features(sample, ck.centroids_long(model, spark), cfg.k, **_hash_kw(cfg)) \
        .select(F.col("id").alias("patient_id"), "cluster", F.col("review").alias("label"), "distance")
    return clustered, model


def run_part3(patient: DataFrame, claims: DataFrame, charges: DataFrame, review: DataFrame,
              cfg: Part3Config | None = None) -> Part3Result:
    """Part 3: features (J1) -> every patient, or a sample (H2) -> cosine k-means and
    assignment (J4 J5) written by cluster/label (B4) -> negative cluster
    (E11 E14) -> training and scoring sets (J7 J8) -> L1 logistic fit and
    scores (J9 J10 B6) -> top ``cfg.top_n`` suspicious patients (J12), with
    the coefficient report (J11) and training-set quality (E15)."""
    cfg = cfg or Part3Config()
    spark = patient.sparkSession
    procedure = fe.procedure_dim(charges)
    features = fe.patient_features(patient, claims, procedure, review, dedupe=cfg.dedupe)
    features = store_bucketed(features, "id", cfg.buckets, "patientfeatures") if cfg.buckets \
        else materialize(features, "patientfeatures")

    sample = features if cfg.cluster_sample is None else materialize(
        sa.clustering_sample(features, cfg.cluster_sample, cfg.seed), "patientclustering")
    clustered, _ = cluster_patients(sample, cfg)
    if cfg.buckets:
        clustered = store_bucketed(clustered, "patient_id", cfg.buckets, "clusteredclaims", ("cluster", "label"))
    else:
        path = scratch_path(spark, "clusteredclaims")
        write_partitioned(clustered, path, ("cluster", "label"))
        clustered = spark.read.parquet(path)

    table = ck.crosstab(clustered, cfg.k)
    negative = sorted(r.negative_cluster for r in ck.negative_clusters(table).collect())

    training = materialize(
        sa.training_set(features, _pruned(clustered, negative), negative, cfg.training_sample, cfg.seed),
        "patienttraining")
    scoring = sa.scoring_set(features, _pruned(clustered, negative), negative)

    scored, model = classify(training, scoring, cfg)
    coef = cl.coefficients(model, spark)
    dictionary = fe.feature_dictionary(training, **_hash_kw(cfg))
    return Part3Result(
        features=features, clustered=clustered, crosstab=table, negative=negative,
        training=training, scoring=scoring, scored=scored,
        suspicious=cl.suspicious_patients(scored, cfg.top_n),
        coefficients=cl.coefficient_report(coef, dictionary),
        quality=cl.model_quality(coef, training, **_hash_kw(cfg)),
        extra={"model": model})


def classify(training: DataFrame, scoring: DataFrame, cfg: Part3Config | None = None):
    """Hash the training set into vectors, fit the L1
    logistic model, score the scoring set and store the scores.

    The scoring set (every unflagged patient outside the negative cluster,
    the largest input of Part 3) is scored from its hashed terms and the
    broadcast coefficients, JVM-side, without building vector objects.
    Returns (scored DataFrame: patient_id, review, score, p1; the model).
    """
    cfg = cfg or Part3Config()
    spark = training.sparkSession
    model = cl.fit_l1_logistic(fe.hash_features(training, **_hash_kw(cfg)), cfg.reg)
    path = scratch_path(spark, "classifiedclaims")
    coef = cl.coefficients(model, spark)
    write_scores(cl.score_features(coef, scoring, **_hash_kw(cfg)), path)  # B6
    return spark.read.parquet(path), model


def _pruned(clustered: DataFrame, negative: list[int]) -> DataFrame:
    """Only the ``label=0`` directories of the negative clusters."""
    return clustered.where((F.col("label") == 0) & F.col("cluster").isin(negative))
