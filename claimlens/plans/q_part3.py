"""Registered Part 3 queries: features, hashing, sampling, clustering steps,
training/scoring sets, scoring and reports, and certificates of the fits.

The oracle-checked clustering uses a fixed rule instead of MLlib's fit: one
cosine assignment to seeded starting points (G4 + J5), so both engines must
agree exactly. Scores, counts, quality and reports are checked with fixed
coefficients (a formula of the slot, ``FIXED_BETA``). The fits themselves
return certificates row by row: the oracle supplies ids and labels, Spark says
whether each row's condition holds.
"""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from claimlens.functions import decode_claims
from claimlens.operators import classify as cl
from claimlens.operators import clustering as ck
from claimlens.operators import features as fe
from claimlens.operators import sampling as sa
from claimlens.operators.common import global_rank, materialize, store_bucketed
from claimlens.plans import standins as si
from claimlens.plans.part3 import Part3Config, cluster_patients, run_part3
from claimlens.plans.registry import CH, W, charges_of, register, rounded
from claimlens.session import scratch_path
from claimlens.sinks import write_partitioned, write_scores, write_vectors
from claimlens.sources import read_partition

SEED = 42
K = 2
TRAIN_N = 50_000     # bounds the labelled rows the classifier is fitted on
SAMPLE_N = 150_000   # of the sampling query only
SMALL_N = 500
BUCKETS = 16


# ---- Spark side --------------------------------------------------------------

def features_of(spark: SparkSession, sf_dir: str, dedupe: bool = False) -> DataFrame:
    """J1 over the stand-in feeds of ``sf_dir``."""
    charges = charges_of(spark, sf_dir)
    return fe.patient_features(si.patient_feed(spark, sf_dir), si.claim_feed(spark, sf_dir),
                               fe.procedure_dim(charges), si.review_feed(spark, sf_dir), dedupe)


def _text(df: DataFrame) -> DataFrame:
    return fe.features_as_text(df)


def _seeded_points(spark: SparkSession, sf_dir: str, buckets: int | None = None) -> tuple[DataFrame, DataFrame]:
    """(features, centroids at the seeded starting points): only the chosen rows
    are hashed, every row looks for its id among the chosen. The features are stored
    once, in hash buckets of the id if ``buckets`` is given."""
    feats = features_of(spark, sf_dir)
    feats = store_bucketed(feats, "id", buckets, "features") if buckets else materialize(feats, "features")
    seeds = materialize(sa.seed_points(feats, K, SEED), "seeds")
    chosen = feats.join(F.broadcast(seeds.select("id")), "id", "left_semi")
    return feats, ck.seed_centroids(fe.vector_long(chosen), seeds)


def _step_clusters(spark: SparkSession, sf_dir: str, buckets: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Features and the fixed-rule clustering of all patients: seeded starting
    points, one cosine assignment. (patient_id, cluster, label, distance)."""
    feats, centroids = _seeded_points(spark, sf_dir, buckets)
    clustered = ck.assign_features(feats, centroids, K, fe.N_FEATURES) \
        .select(F.col("id").alias("patient_id"), "cluster", F.col("review").alias("label"), "distance")
    return feats, clustered


def _training(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    """Training and scoring set of the fixed-rule clustering."""
    feats, clustered = _step_clusters(spark, sf_dir)
    clustered = materialize(clustered, "clustered")
    negative = _negatives(clustered)
    # the sample behind the training set is stored already
    return (sa.training_set(feats, clustered, negative, TRAIN_N, SEED),
            sa.scoring_set(feats, clustered, negative))


def _fixed_beta(spark: SparkSession) -> DataFrame:
    """Coefficients by a formula of the slot that the oracle repeats; a third
    of them is zero."""
    slot = F.col("id")
    return spark.range(fe.N_FEATURES).select(
        slot.cast("int").alias("idx"),
        F.when(slot % 3 == 0, F.lit(0.0)).otherwise(((slot * 7919) % 2001 - 1000) / F.lit(50_000.0)).alias("beta"))


def _negatives(clustered: DataFrame) -> list[int]:
    """The negative cluster numbers (at most k values) for partition pruning."""
    return sorted(r.negative_cluster
                  for r in ck.negative_clusters(ck.crosstab(clustered, K)).collect())


# ---- SQL side ----------------------------------------------------------------

PROC_SQL = """
  procedure AS (SELECT DISTINCT regexp_replace(procedure_id, '^ *([0-9]*).*', '\\1') AS id,
                       type, procedure_id AS full_name FROM charges)"""


def _features_sql(dedupe: bool = False) -> str:
    """J1 afresh: claims are counted per patient and code, then multiplied by
    how often the code, the patient and the flag occur (once with dedupe)."""
    times = "1" if dedupe else "count(*)"
    return f"""
  code_count AS (SELECT patient_id, claim_id, count(*) AS n FROM patientclaim GROUP BY ALL),
  code_kind AS (SELECT id AS claim_id, type, {times} AS times FROM procedure GROUP BY ALL),
  person AS (SELECT id, age, gender, income, count(*) AS times FROM patient GROUP BY ALL),
  flag AS (SELECT patient_id AS id, {times} AS times FROM review GROUP BY ALL),
  tally AS (
    SELECT person.id, CAST(flag.id IS NOT NULL AS INTEGER) AS review, age, gender, income, claim_id, type,
           CAST(n * code_kind.times * person.times * coalesce(flag.times, 1) AS BIGINT) AS num
    FROM code_count JOIN code_kind USING (claim_id)
         JOIN person ON person.id = code_count.patient_id LEFT JOIN flag ON flag.id = person.id),
  feat AS (
    SELECT id, review, age, gender, income,
           CAST(coalesce(sum(num) FILTER (type = 'I'), 0) AS BIGINT) AS type_I,
           CAST(coalesce(sum(num) FILTER (type = 'O'), 0) AS BIGINT) AS type_O,
           array_to_string(list_transform(list_sort(list(DISTINCT struct_pack(code := claim_id, num := num))),
                                          lambda x: x.code || ',' || x.num), ',') AS claims
    FROM tally GROUP BY ALL)"""


BASE = (CH, si.PATIENT_SQL, si.CLAIM_SQL, si.REVIEW_SQL, PROC_SQL, _features_sql())


def _hash_sql(src: str = "feat") -> str:
    return f"""
  fc AS (SELECT DISTINCT id, review, age, gender, income, claim_id, num
         FROM tally SEMI JOIN (SELECT DISTINCT id AS kept FROM {src}) k ON tally.id = k.kept),
  words AS (
    SELECT id, review, age, gender, income, unnest([
             {{'feature': 'bias', 'weight': CAST(1 AS DOUBLE)}},
             {{'feature': 'age=' || coalesce(age, ''), 'weight': 1.0}},
             {{'feature': 'gender=' || coalesce(gender, ''), 'weight': 1.0}},
             {{'feature': 'income=' || coalesce(income, ''), 'weight': 1.0}},
             {{'feature': 'inpatient', 'weight': CAST(type_I AS DOUBLE)}},
             {{'feature': 'outpatient', 'weight': CAST(type_O AS DOUBLE)}}]) AS t FROM {src}),
  terms AS (
    SELECT id, review, age, gender, income, t.feature AS feature, 0 AS probe, t.weight AS weight FROM words
    UNION ALL
    SELECT id, review, age, gender, income, 'claim=' || claim_id, CAST(p.range AS INTEGER), CAST(num AS DOUBLE)
    FROM fc, range(2) p),
  hashed AS (
    SELECT id, review, age, gender, income, feature, probe,
           CAST(CAST('0x' || substr(md5(feature || '#' || CAST(probe AS VARCHAR)), 1, 8) AS BIGINT)
                % {fe.N_FEATURES} AS INTEGER) AS idx,
           weight
    FROM terms)"""


def _key(col: str) -> str:
    return f"md5(CAST({col} AS VARCHAR) || ':{SEED}')"


def _sample_sql(n: int) -> str:
    return f"""
  neg_sample AS (SELECT * FROM feat WHERE review = 0 ORDER BY {_key('id')}, id LIMIT {n}),
  sample AS (SELECT * FROM feat WHERE review = 1 UNION ALL SELECT * FROM neg_sample)"""


def _assign_sql(points: str, ids: str) -> str:
    """Seeded k starting points among ``ids``, one cosine assignment of
    ``points(id, idx, value)``; defines cent, pnorm, dist, assign."""
    return f"""
  seeds AS (SELECT id, CAST(row_number() OVER (ORDER BY {_key('id')}, id) - 1 AS INTEGER) AS cluster
            FROM (SELECT DISTINCT id FROM {ids}) ORDER BY {_key('id')}, id LIMIT {K}),
  cent AS (SELECT s.cluster, v.idx, v.value FROM {points} v JOIN seeds s ON v.id = s.id),
  pnorm AS (SELECT id, sqrt(sum(value * value)) AS norm FROM {points} GROUP BY id),
  cnorm AS (SELECT cluster, sqrt(sum(value * value)) AS cnorm FROM cent GROUP BY cluster),
  dots AS (SELECT p.id, c.cluster, sum(p.value * c.value) AS dot
           FROM {points} p JOIN cent c ON p.idx = c.idx GROUP BY p.id, c.cluster),
  pairs AS (SELECT id, norm, CAST(r.range AS INTEGER) AS cluster FROM pnorm, range({K}) r),
  dist AS (SELECT pr.id, pr.cluster,
                  least(2.0, greatest(0.0,
                        1.0 - coalesce(d.dot, 0.0) / nullif(pr.norm * cn.cnorm, 0))) AS distance
           FROM pairs pr LEFT JOIN dots d ON d.id = pr.id AND d.cluster = pr.cluster
                LEFT JOIN cnorm cn ON cn.cluster = pr.cluster),
  assign AS (SELECT id, cluster, distance FROM (
               SELECT *, row_number() OVER (PARTITION BY id
                                            ORDER BY distance ASC NULLS LAST, cluster) AS rn
               FROM dist) WHERE rn = 1)"""


def _crosstab_sql(labelled: str, labels: str) -> str:
    """Cells of ``labelled(cluster, label)`` over clusters x ``labels``."""
    return f"""
  cnt AS (SELECT cluster, label, count(*) AS n FROM {labelled} GROUP BY 1, 2),
  grid AS (SELECT l.label, CAST(r.range AS INTEGER) AS cluster FROM {labels}, range({K}) r),
  cells AS (SELECT g.cluster, g.label, coalesce(c.n, 0) AS n
            FROM grid g LEFT JOIN cnt c ON c.cluster = g.cluster AND c.label = g.label),
  xtab AS (SELECT cluster, label, n,
                  100.0 * (n / nullif(sum(n) OVER (PARTITION BY cluster), 0)) AS pct_of_cluster,
                  100.0 * (n / nullif(sum(n) OVER (PARTITION BY label), 0)) AS pct_of_label
           FROM cells),
  negative AS (SELECT cluster AS negative_cluster FROM (
                 SELECT cluster, row_number() OVER (ORDER BY n DESC, cluster DESC) AS r
                 FROM xtab WHERE label = 1) WHERE r > 1)"""


_EMB_SQL = f"""
  epts AS (SELECT vec_id AS id, CAST(u.i - 1 AS INTEGER) AS idx,
                  CAST(u.v AS DOUBLE) AS value
           FROM (SELECT vec_id, unnest(embedding) AS v,
                        unnest(range(1, len(embedding) + 1)) AS i FROM embeddings) u),
  eids AS (SELECT vec_id AS id FROM embeddings)"""

_PATIENT_STEP_SQL = (_hash_sql(), """
  svec AS (SELECT id, idx, sum(weight) AS value FROM hashed GROUP BY id, idx)""",
                     _assign_sql("svec", "feat"), """
  clustered AS (SELECT a.id AS patient_id, a.cluster, f.review AS label, a.distance
                FROM assign a JOIN feat f ON f.id = a.id)""",
                     _crosstab_sql("clustered", "(VALUES (0), (1)) l(label)"))

_FEATURE_COLS = "id, review, age, gender, income, type_I, type_O, claims"


# ---- features and hashing ------------------------------------------------------

@register("procedure_dim", W(CH, PROC_SQL) + "\nSELECT id, type, full_name FROM procedure")
def q_procedure_dim(spark, sf_dir):
    """C8 + I3: distinct procedures with their leading-digit code."""
    return fe.procedure_dim(charges_of(spark, sf_dir))


@register("patient_features", W(*BASE) + f"\nSELECT {_FEATURE_COLS} FROM feat")
def q_patient_features(spark, sf_dir):
    """Per-patient features (claims shown in their stored text form)."""
    return _text(features_of(spark, sf_dir))


@register("patient_features_dedupe", W(
    CH, si.PATIENT_SQL, si.CLAIM_SQL, si.REVIEW_SQL, PROC_SQL, _features_sql(dedupe=True))
    + f"\nSELECT {_FEATURE_COLS} FROM feat")
def q_patient_features_dedupe(spark, sf_dir):
    """J1 with ``dedupe=True``: dimension duplicates do not multiply counts."""
    return _text(features_of(spark, sf_dir, dedupe=True))


@register("claims_decode", W(*BASE) + """
SELECT DISTINCT id, claim_id, num AS n FROM tally""")
def q_claims_decode(spark, sf_dir):
    """A12 + I9: the stored text feature table scanned back and its claims
    string decoded by stride 2 into (claim_id, n) pairs."""
    path = scratch_path(spark, "patientfeatures-text")
    _text(features_of(spark, sf_dir)).write.parquet(path)
    stored = spark.read.parquet(path)
    return stored.select("id", F.explode(decode_claims("claims")).alias("c")) \
        .select("id", F.col("c.claim_id").alias("claim_id"), F.col("c.n").alias("n")).distinct()


@register("hashed_features_long", W(*BASE, _hash_sql()) + """
SELECT id, review, idx, round(sum(weight), 6) AS weight FROM hashed GROUP BY id, review, idx""")
def q_hashed_features_long(spark, sf_dir):
    """J2 in long form: every patient's slots with colliding weights summed."""
    return rounded(fe.hash_features_long(features_of(spark, sf_dir)))


@register("feature_dictionary", W(*BASE, _hash_sql()) + """
SELECT DISTINCT feature, probe, idx FROM hashed""")
def q_feature_dictionary(spark, sf_dir):
    """Feature name and probe -> slot."""
    return fe.feature_dictionary(features_of(spark, sf_dir))


@register("sparse_vectors", W(*BASE, _hash_sql()) + """
SELECT id, idx, round(sum(weight), 6) AS value FROM hashed GROUP BY id, idx""")
def q_sparse_vectors(spark, sf_dir):
    """J2 + B7: the vectors that both models are fitted on, written with
    ``write_vectors`` and read back as stored: their own indices and values."""
    path = scratch_path(spark, "vectors")
    write_vectors(fe.hash_features(features_of(spark, sf_dir)), path)
    stored = spark.read.schema("id string, features struct<type:tinyint,size:int,indices:array<int>,"
                               "values:array<double>>").parquet(path)
    return rounded(stored.select("id", F.explode(F.arrays_zip("features.indices", "features.values")).alias("t"))
                   .select("id", F.col("t.indices").alias("idx"), F.col("t.values").alias("value")))


@register("feature_row_scores", W(*BASE, """
  twice AS (SELECT * FROM feat UNION ALL SELECT id, review, 'other', gender, income, type_I + 1, type_O, claims FROM feat)""",
                                  """
  both_tally AS (SELECT * FROM tally UNION ALL SELECT id, review, 'other', gender, income, claim_id, type, num FROM tally)""",
                                  _hash_sql("twice").replace("FROM tally SEMI", "FROM both_tally tally SEMI"), f"""
  scored AS (SELECT id, age, 1 / (1 + exp(-sum(weight * {{beta}}))) AS p1 FROM hashed GROUP BY id, age)
""".replace("{beta}", "CASE WHEN idx % 3 = 0 THEN 0.0 ELSE ((idx * 7919) % 2001 - 1000) / 50000.0 END")) + """
SELECT id AS patient_id, CASE WHEN p1 > 0.5 THEN 1 ELSE 0 END AS review, round(p1, 6) AS p1 FROM scored""")
def q_feature_row_scores(spark, sf_dir):
    """J10 per feature row: every patient twice, with different attributes,
    gives two scores for one id (fixed coefficients)."""
    feats = features_of(spark, sf_dir)
    other = feats.withColumns({"age": F.lit("other"), "type_I": F.col("type_I") + 1})
    return rounded(cl.score_features(_fixed_beta(spark), feats.unionByName(other)).select("patient_id", "review", "p1"))


# ---- sampling ------------------------------------------------------------------

@register("clustering_sample", W(*BASE, _sample_sql(SAMPLE_N)) + f"\nSELECT {_FEATURE_COLS} FROM sample")
def q_clustering_sample(spark, sf_dir):
    """H2 + G3: all flagged patients + 150,000 seeded unflagged ones (the
    sampling operator at its default size)."""
    feats = materialize(features_of(spark, sf_dir), "features")
    return _text(sa.clustering_sample(feats, SAMPLE_N, SEED))


@register("clustering_sample_500", W(*BASE, _sample_sql(SMALL_N)) + f"\nSELECT {_FEATURE_COLS} FROM sample")
def q_clustering_sample_500(spark, sf_dir):
    """H2 + G3 with a sample smaller than the data (500 unflagged)."""
    feats = materialize(features_of(spark, sf_dir), "features")
    return _text(sa.clustering_sample(feats, SMALL_N, SEED))


# ---- clustering steps ------------------------------------------------------------

@register("kmeans_step_assign", W(_EMB_SQL, _assign_sql("epts", "eids")) + """
SELECT id, cluster, round(distance, 6) AS distance FROM assign""")
def q_kmeans_step_assign(spark, sf_dir):
    """G4 + J5 on embeddings: seeded starting points, nearest by cosine."""
    emb = si.table(spark, sf_dir, "embeddings")
    points = ck.embedding_long(emb)
    seeds = sa.seed_points(emb.select(F.col("vec_id").alias("id")), K, SEED)
    return rounded(ck.cosine_assign(points, ck.seed_centroids(points, seeds), K))


@register("kmeans_step_update", W(_EMB_SQL, _assign_sql("epts", "eids"), """
  members AS (SELECT a.id, a.cluster, n.norm FROM assign a JOIN pnorm n ON n.id = a.id
              WHERE n.norm > 0),
  sizes AS (SELECT cluster, count(*) AS size FROM members GROUP BY cluster)""") + """
SELECT m.cluster, p.idx, round(sum(p.value / m.norm) / any_value(s.size), 6) + 0.0 AS value
FROM epts p JOIN members m ON m.id = p.id JOIN sizes s ON s.cluster = m.cluster
GROUP BY m.cluster, p.idx""")
def q_kmeans_step_update(spark, sf_dir):
    """One centroid update after the seeded assignment (mean unit vector): both
    inside the rows, whole vectors added up."""
    emb = si.table(spark, sf_dir, "embeddings")
    seeds = sa.seed_points(emb.select(F.col("vec_id").alias("id")), K, SEED)
    start = ck.seed_centroids(ck.embedding_long(emb), seeds)
    width = emb.agg(F.max(F.size("embedding")).alias("n")).first()["n"] or 0
    vectors = emb.withColumn("features", array_to_vector(F.transform(
        "embedding", lambda v: F.coalesce(v.cast("double"), F.lit(0.0)))))
    assigned = ck.assign_arrays(vectors, "embedding", start, K, width, ("features",))
    return rounded(ck.vector_update(assigned, sparse=False))


@register("cluster_crosstab", W(_EMB_SQL, _assign_sql("epts", "eids"), """
  labelled AS (SELECT a.cluster, e.label FROM assign a JOIN embeddings e ON e.vec_id = a.id)""",
                                 _crosstab_sql("labelled", "(SELECT DISTINCT label FROM labelled) l")) + """
SELECT cluster, label, n, round(pct_of_cluster, 6) AS pct_of_cluster,
       round(pct_of_label, 6) AS pct_of_label FROM xtab""")
def q_cluster_crosstab(spark, sf_dir):
    """E11 + D6: cluster x label counts and shares (embeddings' labels)."""
    emb = si.table(spark, sf_dir, "embeddings")
    points = ck.embedding_long(emb)
    seeds = sa.seed_points(emb.select(F.col("vec_id").alias("id")), K, SEED)
    assign = ck.cosine_assign(points, ck.seed_centroids(points, seeds), K)
    labelled = ck.label_points(assign, emb, "vec_id", "label")
    return rounded(ck.crosstab(labelled, K, labels=None))


@register("negative_cluster", W(*BASE, *_PATIENT_STEP_SQL) + """
SELECT negative_cluster FROM negative""")
def q_negative_cluster(spark, sf_dir):
    """E14 / J6 on the patients' fixed-rule clustering."""
    _, clustered = _step_clusters(spark, sf_dir)
    return ck.negative_clusters(ck.crosstab(clustered, K))


@register("patient_clusters_step", W(*BASE, *_PATIENT_STEP_SQL) + """
SELECT patient_id, cluster, label, round(distance, 6) AS distance FROM clustered""")
def q_patient_clusters_step(spark, sf_dir):
    """J2 + G4 + J5 + D6: every patient's hashed vector assigned to seeded
    starting points by cosine distance, with its label."""
    _, clustered = _step_clusters(spark, sf_dir)
    return rounded(clustered)


@register("partitioned_roundtrip", W(*BASE, *_PATIENT_STEP_SQL) + """
SELECT patient_id, cluster, label FROM clustered
WHERE label = 0 AND cluster IN (SELECT negative_cluster FROM negative)""")
def q_partitioned_roundtrip(spark, sf_dir):
    """B4 + A13: clustered points written as cluster=/label= directories and
    read back pruned to the negative cluster's unflagged points."""
    _, clustered = _step_clusters(spark, sf_dir)
    path = scratch_path(spark, "clusteredclaims")
    write_partitioned(clustered, path, ("cluster", "label"))
    negative = _negatives(spark.read.parquet(path))
    return read_partition(spark, path, label=0).where(F.col("cluster").isin(negative)) \
        .select("patient_id", "cluster", "label")


@register("training_set", W(*BASE, *_PATIENT_STEP_SQL, f"""
  cand AS (SELECT f.* FROM feat f WHERE f.review = 0 AND f.id IN (
             SELECT patient_id FROM clustered
             WHERE label = 0 AND cluster IN (SELECT negative_cluster FROM negative))),
  train_neg AS (SELECT * FROM cand ORDER BY {_key('id')}, id LIMIT {TRAIN_N})""") + f"""
SELECT {_FEATURE_COLS} FROM feat WHERE review = 1
UNION ALL SELECT {_FEATURE_COLS} FROM train_neg""")
def q_training_set(spark, sf_dir):
    """All flagged + 50,000 sampled unflagged of the negative cluster."""
    return _text(_training(spark, sf_dir)[0])


@register("scoring_set", W(*BASE, *_PATIENT_STEP_SQL) + f"""
SELECT {_FEATURE_COLS} FROM feat WHERE review = 0 AND id NOT IN (
  SELECT patient_id FROM clustered
  WHERE label = 0 AND cluster IN (SELECT negative_cluster FROM negative))""")
def q_scoring_set(spark, sf_dir):
    """Unflagged patients outside the negative cluster's points."""
    return _text(_training(spark, sf_dir)[1])


@register("sets_from_buckets", W(*BASE, *_PATIENT_STEP_SQL, f"""
  picked AS (SELECT patient_id FROM clustered WHERE label = 0 AND cluster IN (SELECT negative_cluster FROM negative)),
  train_neg AS (SELECT id FROM feat WHERE review = 0 AND id IN (SELECT patient_id FROM picked)
                ORDER BY {_key('id')}, id LIMIT {SMALL_N})""") + f"""
SELECT {_FEATURE_COLS}, 'train' AS part FROM feat WHERE review = 1 OR id IN (SELECT id FROM train_neg)
UNION ALL
SELECT {_FEATURE_COLS}, 'score' FROM feat WHERE review = 0 AND id NOT IN (SELECT patient_id FROM picked)""")
def q_sets_from_buckets(spark, sf_dir):
    """J7 J8 D4 D5 from tables in hash buckets of the patient id, without
    broadcasting the ids: training set (500 sampled) and scoring set."""
    feats, clustered = _step_clusters(spark, sf_dir, BUCKETS)
    clustered = store_bucketed(clustered, "patient_id", BUCKETS, "clusters", ("cluster", "label"))
    negative = _negatives(clustered)
    train = sa.training_set(feats, clustered, negative, SMALL_N, SEED, max_broadcast_rows=0)
    score = sa.scoring_set(feats, clustered, negative, max_broadcast_rows=0)
    return _text(train).withColumn("part", F.lit("train")).unionByName(_text(score).withColumn("part", F.lit("score")))


# ---- scoring and reports with fixed coefficients ---------------------------------------

_BETA = "CASE WHEN idx % 3 = 0 THEN 0.0 ELSE ((idx * 7919) % 2001 - 1000) / 50000.0 END"
_NEGATIVE_IDS = """(SELECT patient_id FROM clustered
    WHERE label = 0 AND cluster IN (SELECT negative_cluster FROM negative))"""
_FITTED_SQL = (*BASE, *_PATIENT_STEP_SQL, f"""
  to_score AS (SELECT * FROM feat WHERE review = 0 AND id NOT IN {_NEGATIVE_IDS}),
  to_train AS (
    SELECT * FROM feat WHERE review = 1 UNION ALL
    SELECT * FROM (SELECT * FROM feat WHERE review = 0 AND id IN {_NEGATIVE_IDS}
                   ORDER BY {_key('id')}, id LIMIT {TRAIN_N})),
  p AS (SELECT id, review, 1 / (1 + exp(-sum(weight * {_BETA}))) AS p1 FROM hashed GROUP BY id, review),
  scored AS (SELECT id AS patient_id, CASE WHEN p1 > 0.5 THEN 1 ELSE 0 END AS review,
                    CASE WHEN p1 > 0.5 THEN p1 ELSE 1 - p1 END AS score
             FROM p WHERE id IN (SELECT id FROM to_score))""")


@register("fixed_scores", W(*_FITTED_SQL) + """
SELECT patient_id, review, round(score, 6) AS score FROM scored""")
def q_fixed_scores(spark, sf_dir):
    """J10 + B6: the scoring set scored with fixed coefficients, stored with
    ``write_scores`` and read back."""
    path = scratch_path(spark, "classifiedclaims")
    write_scores(cl.score_features(_fixed_beta(spark), _training(spark, sf_dir)[1]), path)
    return rounded(spark.read.parquet(path).select("patient_id", "review", "score"))


@register("predicted_counts", W(*_FITTED_SQL) + """
SELECT c.review, count(scored.review) AS n FROM (VALUES (0), (1)) c(review) LEFT JOIN scored USING (review)
GROUP BY c.review""")
def q_predicted_counts(spark, sf_dir):
    """Scored rows per predicted class, both classes (fixed coefficients)."""
    return cl.predicted_counts(cl.score_features(_fixed_beta(spark), _training(spark, sf_dir)[1]))


def _ranked_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The scoring set's scores, stored: a top n reads them twice, they are computed once."""
    scored = cl.score_features(_fixed_beta(spark), _training(spark, sf_dir)[1])
    return materialize(scored.select("patient_id", "review", F.round("score", 9).alias("score")), "scores")


@register("suspicious_patients", W(*_FITTED_SQL) + """
SELECT CAST(row_number() OVER (ORDER BY round(score, 9) DESC, patient_id) AS INTEGER) AS rank, patient_id,
       round(score, 6) AS score
FROM scored WHERE review = 1 QUALIFY rank <= 10000""")
def q_suspicious_patients(spark, sf_dir):
    """J12 + G2: top 10,000 scores among patients predicted suspicious (fixed
    coefficients; scores rounded to 9 places before ranking)."""
    return rounded(cl.suspicious_patients(_ranked_scores(spark, sf_dir)))


@register("suspicious_patients_20", W(*_FITTED_SQL) + """
SELECT CAST(row_number() OVER (ORDER BY round(score, 9) DESC, patient_id) AS INTEGER) AS rank, patient_id,
       round(score, 6) AS score
FROM scored WHERE review = 1 QUALIFY rank <= 20""")
def q_suspicious_patients_20(spark, sf_dir):
    """J12 + G2 with n far below the candidates: sketch, then candidates beyond a
    cut (fixed coefficients)."""
    return rounded(cl.suspicious_patients(_ranked_scores(spark, sf_dir), 20))


@register("model_quality", W(*_FITTED_SQL, """
  true_p AS (SELECT CASE WHEN review = 1 THEN p1 ELSE 1 - p1 END AS q,
                    CAST(CASE WHEN p1 > 0.5 THEN 1 ELSE 0 END = review AS INTEGER) AS hit
             FROM p WHERE id IN (SELECT id FROM to_train))""") + """
SELECT count(*) AS n, round(avg(ln(greatest(q, 1e-300))), 6) AS mean_log_likelihood,
       round(avg(hit), 6) AS accuracy FROM true_p""")
def q_model_quality(spark, sf_dir):
    """Mean log-likelihood and accuracy on the training set (fixed
    coefficients)."""
    return rounded(cl.model_quality(_fixed_beta(spark), _training(spark, sf_dir)[0]))


_REPORT_SQL = W(*_FITTED_SQL, f"""
  report AS (SELECT DISTINCT feature, probe, idx, {_BETA} AS beta FROM hashed
             WHERE id IN (SELECT id FROM to_train))""")


@register("coefficient_report", _REPORT_SQL + """
SELECT feature, probe, idx, round(beta, 6) + 0.0 AS beta FROM report""")
def q_coefficient_report(spark, sf_dir):
    """J11 + D7: every feature of the training set with its coefficient, zeros
    included (fixed coefficients)."""
    return rounded(cl.coefficient_report(_fixed_beta(spark), fe.feature_dictionary(_training(spark, sf_dir)[0])))


@register("top_coefficients", _REPORT_SQL + """
SELECT CAST(row_number() OVER (ORDER BY abs(beta) DESC, feature, probe) AS INTEGER) AS rank,
       feature, probe, idx, round(beta, 6) AS beta FROM report QUALIFY rank <= 10""")
def q_top_coefficients(spark, sf_dir):
    """G5 over the report: the 10 largest |beta| (fixed coefficients)."""
    rep = cl.coefficient_report(_fixed_beta(spark), fe.feature_dictionary(_training(spark, sf_dir)[0]))
    top = rep.withColumn("name", F.concat("feature", F.lit("#"), F.format_string("%04d", "probe")))
    return rounded(cl.top_by_abs(top, "beta", "name", 10).select("rank", "feature", "probe", "idx", "beta"))


# ---- certificates of the fits ----------------------------------------------------------

@register("kmeans_cosine", W(*BASE) + """
SELECT id AS patient_id, review AS label, TRUE AS nearest, TRUE AS no_worse_than_start FROM feat""")
def q_kmeans_cosine(spark, sf_dir):
    """J4 + J5: MLlib cosine k-means (k=2, 10 iterations) over all patients.

    Per patient: whether its cluster is the one MLlib predicts (or as near),
    and whether the fit's total distance is at most that of one assignment to
    seeded starting points."""
    cfg = Part3Config(seed=SEED)
    feats, start = _seeded_points(spark, sf_dir)
    clustered, model = cluster_patients(feats, cfg)
    centers = ck.centroids_long(model, spark)
    at_start = ck.assign_features(feats, start, K, fe.N_FEATURES).agg(F.sum("distance")).first()[0]
    total = clustered.agg(F.sum("distance")).first()[0]
    said = model.transform(fe.hash_features(feats)).select(F.col("id").alias("patient_id"),
                                                           F.col("cluster").alias("said"))
    each = ck.assign_features(feats, centers, K, fe.N_FEATURES, ("id",)) \
        .select(F.col("id").alias("patient_id"), F.col("distance").alias("least"))
    other = [ck.assign_features(feats, centers.where(F.col("cluster") == c).withColumn("cluster", F.lit(0)),
                                1, fe.N_FEATURES, ("id",))
             .select(F.col("id").alias("patient_id"), F.col("distance").alias(f"d{c}")) for c in range(K)]
    rows = clustered.join(said, "patient_id").join(each, "patient_id")
    for o in other:
        rows = rows.join(o, "patient_id")
    said_distance = F.when(F.col("said") == 0, F.col("d0")).otherwise(F.col("d1"))
    return rows.select("patient_id", "label",
                       (said_distance <= F.col("least") + 1e-9).alias("nearest"),
                       F.lit(total <= at_start + 1e-9).alias("no_worse_than_start"))


@register("part3_run", W(*BASE) + """
SELECT id AS patient_id, review AS label, TRUE AS placed, TRUE AS scored, TRUE AS listed FROM feat""")
def q_part3_run(spark, sf_dir):
    """Part 3 as one call (``run_part3``: features, fits, scores, top n). Per
    patient, with its label: it is in the training or the scoring set as its flag
    and cluster say; it has a score just if it is in the scoring set; and it is on
    the list of suspicious patients just if it was predicted so."""
    cfg = Part3Config(seed=SEED, training_sample=TRAIN_N)
    r = run_part3(si.patient_feed(spark, sf_dir), si.claim_feed(spark, sf_dir), charges_of(spark, sf_dir),
                  si.review_feed(spark, sf_dir), cfg)
    rows = r.features.select("id", "review") \
        .join(r.clustered.select(F.col("patient_id").alias("id"), "cluster"), "id", "left") \
        .join(r.training.select("id", F.lit(True).alias("trains")), "id", "left") \
        .join(r.scoring.select("id", F.lit(True).alias("scores")), "id", "left") \
        .join(r.scored.select(F.col("patient_id").alias("id"), F.col("review").alias("said"), "score"), "id", "left") \
        .join(r.suspicious.select(F.col("patient_id").alias("id"), "rank"), "id", "left")
    trains, scores = F.col("trains").isNotNull(), F.col("scores").isNotNull()
    flagged, negative = F.col("review") == 1, F.col("cluster").isin(r.negative)
    placed = F.when(flagged, trains & ~scores).when(negative, ~scores).otherwise(scores & ~trains)
    full = r.suspicious.count() >= cfg.top_n    # only then may a predicted patient be missing
    listed = F.col("rank").isNotNull() == F.coalesce(F.col("said") == 1, F.lit(False))
    return rows.select(
        F.col("id").alias("patient_id"), F.col("review").alias("label"), placed.alias("placed"),
        (scores == F.coalesce(F.col("score").between(0.5, 1.0), F.lit(False))).alias("scored"),
        (listed | (F.lit(full) & F.col("rank").isNull())).alias("listed"))


def _fitted(spark: SparkSession, sf_dir: str):
    training, scoring = _training(spark, sf_dir)
    model = cl.fit_l1_logistic(fe.hash_features(training))
    return model, training, scoring


@register("l1_logistic_scores", W(*_FITTED_SQL) + """
SELECT id AS patient_id, TRUE AS as_model FROM to_score""")
def q_l1_logistic_scores(spark, sf_dir):
    """J9 + J10: L1 logistic fit on the training set; for each row of the
    scoring set, whether its score is the one MLlib's model gives its vector."""
    model, _, scoring = _fitted(spark, sf_dir)
    scoring = materialize(scoring, "scoring")
    ours = cl.score_features(cl.coefficients(model, spark), scoring).select("patient_id", "p1", "review")
    theirs = cl.score(model, fe.hash_features(scoring)).select(
        "patient_id", F.col("p1").alias("q"), F.col("review").alias("said"))
    return ours.join(theirs, "patient_id").select(
        "patient_id", ((F.abs(F.col("p1") - F.col("q")) < 1e-9) & (F.col("review") == F.col("said"))).alias("as_model"))


@register("l1_logistic_optimality", W(*_FITTED_SQL) + """
SELECT DISTINCT idx, TRUE AS optimal FROM hashed WHERE id IN (SELECT id FROM to_train)""")
def q_l1_logistic_optimality(spark, sf_dir):
    """For every slot of the training set, whether the fit meets the
    optimality condition of the L1 problem to within 0.005."""
    model, training, _ = _fitted(spark, sf_dir)
    return cl.optimality(cl.coefficients(model, spark), training).select("idx", (F.col("miss") <= 5e-3).alias("optimal"))


@register("patient_kmeans_step_update", W(*BASE, *_PATIENT_STEP_SQL, """
  members AS (SELECT a.id, a.cluster, n.norm FROM assign a JOIN pnorm n ON n.id = a.id
              WHERE n.norm > 0),
  sizes AS (SELECT cluster, count(*) AS size FROM members GROUP BY cluster)""") + """
SELECT m.cluster, p.idx, round(sum(p.value / m.norm) / any_value(s.size), 6) + 0.0 AS value
FROM svec p JOIN members m ON m.id = p.id JOIN sizes s ON s.cluster = m.cluster
GROUP BY m.cluster, p.idx""")
def q_patient_kmeans_step_update(spark, sf_dir):
    """One centroid update on the patients' hashed vectors after the seeded
    cosine assignment (mean unit vector per cluster and slot)."""
    feats, centroids = _seeded_points(spark, sf_dir)
    assigned = ck.assign_features(feats, centroids, K, fe.N_FEATURES, (), vector="features")
    return rounded(ck.vector_update(assigned))


@register("coefficient_curve", _REPORT_SQL + """
SELECT CAST(row_number() OVER (ORDER BY beta DESC, feature, probe) AS INTEGER) AS position, feature, probe, idx,
       round(beta, 6) + 0.0 AS beta FROM report""")
def q_coefficient_curve(spark, sf_dir):
    """J11 + F5: every coefficient by descending beta (fixed coefficients)."""
    rep = cl.coefficient_report(_fixed_beta(spark), fe.feature_dictionary(_training(spark, sf_dir)[0]))
    order = [F.col("beta").desc(), F.col("feature").asc(), F.col("probe").asc()]
    return rounded(global_rank(rep, order, "position").withColumn("position", F.col("position").cast("int"))
                   .select("position", "feature", "probe", "idx", "beta"))


CAP_N = 1_000


@register("clustering_sample_capped", W(*BASE) + f"""
SELECT {_FEATURE_COLS} FROM feat ORDER BY {_key('id')}, id LIMIT {CAP_N}""")
def q_clustering_sample_capped(spark, sf_dir):
    """The patients capped at 1,000 points by a fair seeded sample (not
    "the first rows")."""
    feats = materialize(features_of(spark, sf_dir), "features")
    return _text(sa.cap_rows(feats, CAP_N, SEED))
