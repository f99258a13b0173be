"""Seeded sampling: exact against a brute-force sort by md5."""

import hashlib

from pyspark.sql import functions as F

from claimlens.operators import sampling as sa


def _brute(ids, n, seed):
    return sorted(ids, key=lambda i: (hashlib.md5(f"{i}:{seed}".encode()).hexdigest(), i))[:n]


def test_seeded_sample_is_exact(spark):
    ids = [f"p{i}" for i in range(5000)]
    df = spark.createDataFrame([(i,) for i in ids], "id string").repartition(7)
    for n in (1, 37, 1000):
        got = sorted(r.id for r in sa.seeded_sample(df, n, seed=3).collect())
        assert got == sorted(_brute(ids, n, 3))


def test_sample_larger_than_data(spark):
    df = spark.createDataFrame([(f"x{i}",) for i in range(10)], "id string")
    assert sa.seeded_sample(df, 100).count() == 10


def test_union_sample(spark):
    rows = [(f"f{i}", 1) for i in range(3)] + [(f"u{i}", 0) for i in range(5)]
    df = spark.createDataFrame(rows, "id string, review int")
    out = sa.positives_plus_sample(df, 2, seed=1).collect()
    assert len(out) == 5 and sum(r.review for r in out) == 3


def test_training_and_scoring_sets(spark):
    feats = spark.createDataFrame(
        [("a", 1), ("b", 0), ("c", 0), ("d", 0), ("e", 0)], "id string, review int")
    clustered = spark.createDataFrame(
        [("a", 1, 1), ("b", 0, 0), ("c", 0, 0), ("d", 1, 0)],
        "patient_id string, cluster int, label int")
    train = sorted(r.id for r in sa.training_set(feats, clustered, 0, n=10).collect())
    assert train == ["a", "b", "c"]
    score = sorted(r.id for r in sa.scoring_set(feats, clustered, 0).collect())
    assert score == ["d", "e"]  # e was never clustered: still scored


def test_sample_keeps_the_partitions(spark):
    df = spark.range(200_000).selectExpr("cast(id as string) AS id").repartition(16)
    got = sa.seeded_sample(df, 50_000, seed=1)
    assert got.count() == 50_000
    held = got.rdd.mapPartitions(lambda rows: [sum(1 for _ in rows)]).collect()
    assert len(held) >= 2 and max(held) < 50_000


def test_edge_sizes_and_null_ids(spark):
    df = spark.createDataFrame([(None,), ("a",), ("b",)], "id string")
    assert sa.seeded_sample(df, 0).count() == 0
    assert sa.seeded_sample(df, 1).count() == 1
    assert sa.seeded_sample(df.where("false"), 5).count() == 0


def _counted(spark, df):
    """``df`` through a step that counts the rows it evaluates."""
    seen = spark.sparkContext.accumulator(0)

    def run(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    return df.mapInArrow(run, df.schema), seen


def test_the_input_is_evaluated_once(spark, tmp_path):
    rows = [(f"p{i}", int(i % 50 == 0), 7) for i in range(20_000)]
    spark.createDataFrame(rows, "id string, review int, x int").repartition(5).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    flagged = {r[0] for r in rows if r[1]}
    plain = [r[0] for r in rows if not r[1]]
    for n in (10, 3000, 50_000):
        counted, seen = _counted(spark, df)
        got = {r.id for r in sa.positives_plus_sample(counted, n, 5).collect()}
        assert got == flagged | set(_brute(plain, n, 5)) and seen.value == len(rows)
    clustered = spark.createDataFrame([(i, 0, 0) for i in plain[::2]] + [(plain[0], 0, 0)],
                                      "patient_id string, cluster int, label int")
    counted, seen = _counted(spark, df)
    got = sorted(r.id for r in sa.training_set(counted, clustered, 0, 100, 5).collect())
    assert got == sorted(flagged | set(_brute(plain[::2], 100, 5))) and seen.value == len(rows)


def test_a_wrong_size_estimate_costs_one_more_pass(spark, monkeypatch):
    ids = [f"p{i}" for i in range(20_000)]
    df = spark.createDataFrame([(i,) for i in ids], "id string").repartition(4)
    for share, passes in ((1e-6, 2), (0.9, 1), (1.0, 1)):
        monkeypatch.setattr(sa, "first_share", lambda df, n, share=share: share)
        counted, seen = _counted(spark, df)
        got = sorted(r.id for r in sa.seeded_sample(counted, 500, 9).collect())
        assert got == sorted(_brute(ids, 500, 9)) and seen.value == passes * len(ids)


def test_known_size_of_the_pool_bounds_the_candidates(spark, monkeypatch):
    n = 20_000
    feats = spark.range(n).selectExpr("cast(id AS string) AS id", "cast(id % 50 = 0 AS int) AS review")
    clustered = feats.selectExpr("id AS patient_id", "review AS label", "0 AS cluster")
    written = []
    real = sa.materialize

    def spy(df, name):
        table = real(df, name)
        written.append(table.count())
        return table
    monkeypatch.setattr(sa, "materialize", spy)
    train = sorted(r.id for r in sa.training_set(feats, clustered, [0], 500, 1).select("id").collect())
    flagged = n // 50
    assert written == [written[0]] and written[0] < flagged + 2_000        # not the whole pool
    monkeypatch.setattr(sa, "materialize", real)
    pool = sorted((r.id for r in feats.where("review = 0").collect()), key=lambda i: (hashlib.md5(f"{i}:1".encode()).hexdigest(), i))
    assert train == sorted([r.id for r in feats.where("review = 1").collect()] + pool[:500])
    # a wrong size changes the work, not the sample
    for rows in (1, 10 ** 9):
        again = sa.sample_with(feats, 500, 1, "id", F.col("review") == 1, F.col("review") == 0, rows)
        assert sorted(r.id for r in again.collect()) == train


def test_a_bound_of_zero_counts_nothing(spark, monkeypatch):
    def counted(_):
        raise AssertionError("counted")
    monkeypatch.setattr(sa, "measured", counted)
    feats = spark.createDataFrame([("1", 0), ("2", 1), ("3", 0)], "id string, review int")
    clustered = spark.createDataFrame([("1", 0, 0), ("2", 0, 1), ("3", 1, 0)], "patient_id string, cluster int, label int")
    assert [r.id for r in sa.scoring_set(feats, clustered, [0], max_broadcast_rows=0).collect()] == ["3"]
