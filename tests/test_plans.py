"""Plan-shape guards for scale: no raw detail rows shuffled by a (possibly
hot) key, size-checked broadcasts, pruned scans."""

import contextlib
import io
import re

import pytest

from claimlens.operators import charges as ch
from claimlens.operators import clustering as ck
from claimlens.operators import features as fe


def _tree(df) -> list[str]:
    buf = io.StringIO()
    with contextlib.redirect_stdout(buf):
        df.explain("formatted")
    return buf.getvalue().split("\n\n\n")[0].splitlines()


def _exchange_children(lines):
    out = []
    for i, ln in enumerate(lines):
        if re.search(r"\bExchange \(\d+\)", ln) and i + 1 < len(lines):
            out.append(lines[i + 1])
    return out


@pytest.fixture
def skewed(charges_df):
    # one procedure holds most rows
    rows = [("I", "HOT", str(i % 50), "CA - X", 1.0, float(i % 97), 1.0) for i in range(400)]
    rows += [("O", f"P{i}", str(i), "FL - Y", 1.0, float(i), 0.5) for i in range(20)]
    return charges_df(rows)


@pytest.mark.parametrize("build", [
    lambda c: ch.relative_variance(c, 3),
    lambda c: ch.most_top_charges(c, 3),
    lambda c: ch.most_top_regions(c, 3),
    lambda c: ch.most_top_gaps(c, 3),
    lambda c: ch.provider_dispersion(c, 3),
    lambda c: ch.region_dispersion(c, 3),
])
def test_every_shuffle_is_pre_aggregated(skewed, build):
    lines = _tree(build(skewed))
    children = _exchange_children(lines)
    assert children, "expected at least one shuffle"
    for child in children:
        assert "Aggregate" in child, f"raw rows shuffled: {child}"


def test_stats_are_broadcast(skewed):
    text = "\n".join(_tree(ch.provider_dispersion(skewed, 3)))
    assert "BroadcastHashJoin" in text and "SortMergeJoin" not in text


def test_vectors_scores_and_assignments_stay_inside_the_row(spark):
    feats = spark.createDataFrame(
        [("1", 0, "3", "F", "low", 2, 1, [("0604", 2)]), ("2", 1, "4", "M", "hi", 0, 3, [("0019", 3)])],
        "id string, review int, age string, gender string, income string, type_I bigint, "
        "type_O bigint, claims array<struct<claim_id:string,n:bigint>>")
    cents = spark.createDataFrame([(0, 1, 1.0), (1, 2, 1.0)], "cluster int, idx int, value double")
    from claimlens.operators import classify as cl
    coef = spark.createDataFrame([(1, 0.5)], "idx int, beta double")
    for df in (fe.vector_long(feats), cl.score_features(coef, feats),
               ck.assign_features(feats, cents, 2, fe.N_FEATURES)):
        assert "Exchange" not in "\n".join(_tree(df))


def test_provider_questions_do_not_sort_detail_rows(spark, charges_df):
    from claimlens.operators import charges as ch
    df = charges_df([("I", "001 - A", "1", "AA - X", 5.0, 10.0, 4.0)])
    for by in ("charge", "gap"):
        assert "SortAggregate" not in "\n".join(_tree(ch.provider_win_counts(df, by)))


def test_join_small_falls_back_above_the_bound(spark):
    from claimlens.operators.common import broadcast_checked, join_small
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        big = spark.range(200).selectExpr("id % 20 AS k", "id")
        small = spark.range(20).selectExpr("id AS k", "id * 10 AS v")
        fast = join_small(big, small, "k", "inner", max_broadcast_rows=100)
        slow = join_small(big, small, "k", "inner", max_broadcast_rows=5)
        assert sorted(map(tuple, fast.collect())) == sorted(map(tuple, slow.collect()))
        assert "BroadcastHashJoin" in "\n".join(_tree(fast))
        assert "BroadcastHashJoin" not in "\n".join(_tree(slow))
        assert "BroadcastHashJoin" not in "\n".join(_tree(big.join(broadcast_checked(small, 5), "k")))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_large_top_n_keeps_per_partition_limit(spark):
    from pyspark.sql import functions as F

    from claimlens.operators.common import ranked_top
    df = spark.range(50_000).select(F.col("id"), (F.col("id") * 7 % 1000).alias("v"))
    text = "\n".join(_tree(ranked_top(df, 10_000, [F.col("v").desc(), F.col("id")])))
    assert "TakeOrderedAndProject" in text  # not a full sort into one partition


def test_bucketed_features_are_stored_once(spark, monkeypatch):
    from claimlens.plans import q_part3 as q
    stored = []
    for how in ("materialize", "store_bucketed"):
        def spy(df, *args, real=getattr(q, how), **kw):
            stored.append([a for a in args if isinstance(a, str)][-1])
            return real(df, *args, **kw)
        monkeypatch.setattr(q, how, spy)
    feats, clustered = q._step_clusters(spark, "/root/testdata/sf0.001", 4)
    assert stored.count("features") == 1
    assert clustered.count() == feats.count() > 0


def test_the_top_reads_stored_scores(spark, monkeypatch):
    from claimlens.operators import classify as cl
    from claimlens.plans import q_part3 as q
    given = []

    def spy(scored, *args, real=cl.suspicious_patients):
        given.append(scored)
        return real(scored, *args)
    monkeypatch.setattr(cl, "suspicious_patients", spy)
    assert q.q_suspicious_patients_20(spark, "/root/testdata/sf0.001").count() > 0
    assert "Python" not in "\n".join(_tree(given[0]))     # nothing is hashed again for the second pass
