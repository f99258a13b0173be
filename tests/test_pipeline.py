"""Part 3 invariants (the fits are not bit-comparable to any oracle) and
the driver contract at sf0.001."""

import pytest
from pyspark.sql import functions as F

import __spark_entry__ as E
from claimlens.plans import registry
from claimlens.plans import standins as si
from claimlens.plans.part3 import Part3Config, run_part3

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def result(spark):
    charges = registry.charges_of(spark, SF)
    cfg = Part3Config(seed=7, top_n=50)
    return run_part3(si.patient_feed(spark, SF), si.claim_feed(spark, SF), charges,
                     si.review_feed(spark, SF), cfg)


def test_every_sampled_point_clustered(result):
    c = result.clustered
    assert c.count() > 0
    assert {r.cluster for r in c.select("cluster").distinct().collect()} <= {0, 1}
    assert c.where(F.col("distance").isNull()).count() == 0
    assert len(result.negative) == 1


def test_scores_are_probabilities_of_predicted_class(result):
    s = result.scored
    bad = s.where((F.col("score") < 0.5) | (F.col("score") > 1.0)).count()
    assert bad == 0
    # scoring set excludes all flagged patients
    assert s.join(result.features.where("review = 1").select(F.col("id").alias("patient_id")),
                  "patient_id").count() == 0


def test_top_n_is_monotone(result):
    top = result.suspicious.orderBy("rank").collect()
    assert len(top) <= 50
    assert all(a.score >= b.score for a, b in zip(top, top[1:]))


def test_quality_and_report(result):
    q = result.quality.first()
    assert q.n > 0 and 0.0 <= q.accuracy <= 1.0 and q.mean_log_likelihood <= 0.0
    from claimlens.operators import features as fe
    report = result.coefficients
    # every feature of the training set, zero coefficients included
    assert report.count() == fe.feature_dictionary(result.training).count()
    assert report.where(F.col("beta") == 0).count() > 0 and report.where(F.col("beta") != 0).count() > 0


def test_same_seed_same_result(spark, result):
    charges = registry.charges_of(spark, SF)
    again = run_part3(si.patient_feed(spark, SF), si.claim_feed(spark, SF), charges,
                      si.review_feed(spark, SF), Part3Config(seed=7, top_n=50))
    a = sorted((r.patient_id, r.cluster) for r in result.clustered.collect())
    b = sorted((r.patient_id, r.cluster) for r in again.clustered.collect())
    assert a == b


def test_entry_contract(spark):
    df = E.entry(spark)
    assert df.count() > 0
    qs, sql = E.queries(), E.oracle_sql()
    assert set(sql) <= set(qs)
    assert {"part1a", "part2b", "patient_features", "suspicious_patients"} <= set(qs)


def test_term_scoring_equals_mllib_transform(spark, result):
    from claimlens.operators import classify as cl
    from claimlens.operators import features as fe
    model = result.extra["model"]
    sample = result.scoring.orderBy("id").limit(200)
    a = {r.patient_id: (r.review, r.p1) for r in cl.score(model, fe.hash_features(sample)).collect()}
    b = {r.patient_id: (r.review, r.p1) for r in
         cl.score_features(cl.coefficients(model, spark), sample).collect()}
    assert a.keys() == b.keys()
    for k in a:
        assert a[k][0] == b[k][0] and abs(a[k][1] - b[k][1]) < 1e-9


def test_everyone_is_clustered_and_the_fit_is_optimal(spark, result):
    from claimlens.operators import classify as cl
    assert result.clustered.count() == result.features.count()
    miss = cl.optimality(cl.coefficients(result.extra["model"], spark), result.training)
    assert miss.agg(F.max("miss")).first()[0] < 5e-3


def test_rows_that_share_an_id_are_scored_and_clustered_apart(spark, result):
    from claimlens.operators import classify as cl
    from claimlens.operators import clustering as ck
    from claimlens.operators import features as fe
    one = result.features.limit(1)
    twins = one.unionByName(one.withColumn("age", F.lit("other")))
    coef = spark.range(fe.N_FEATURES).select(F.col("id").cast("int").alias("idx"), (F.col("id") * 1e-5).alias("beta"))
    scored = cl.score_features(coef, twins).collect()
    assert len(scored) == 2 and scored[0].p1 != scored[1].p1
    centers = spark.createDataFrame([(0, 1, 1.0), (1, 2, 1.0)], "cluster int, idx int, value double")
    assert ck.assign_features(twins, centers, 2, fe.N_FEATURES).count() == 2


def test_predicted_counts_keep_an_empty_class(spark):
    from claimlens.operators import classify as cl
    scored = spark.createDataFrame([("a", 0)], "patient_id string, review int")
    assert sorted((r.review, r.n) for r in cl.predicted_counts(scored).collect()) == [(0, 1), (1, 0)]


def test_part3_with_three_clusters(spark):
    charges = registry.charges_of(spark, SF)
    r = run_part3(si.patient_feed(spark, SF), si.claim_feed(spark, SF), charges,
                  si.review_feed(spark, SF), Part3Config(seed=5, k=3, top_n=30))
    assert len(r.negative) == 2 and set(r.negative) < {0, 1, 2}
    assert r.crosstab.count() == 6
    # training negatives come only from the negative clusters' unflagged points
    neg_ids = r.clustered.where(F.col("cluster").isin(r.negative) & (F.col("label") == 0)) \
        .select(F.col("patient_id").alias("id"))
    train_neg = r.training.where("review = 0").select("id")
    assert train_neg.join(neg_ids, "id", "left_anti").count() == 0
    # no scored patient is one of those points
    assert r.scored.join(neg_ids.withColumnRenamed("id", "patient_id"), "patient_id").count() == 0
