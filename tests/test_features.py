"""Patient features and hashing (FIXTURES.md section 4)."""

import hashlib
import re

from pyspark.sql import functions as F

from claimlens import schemas
from claimlens.functions import decode_claims
from claimlens.operators import classify as cl
from claimlens.operators import features as fe


def _inputs(spark):
    patient = spark.createDataFrame(
        [("1", "3", "F", "low"), ("2", "4", "M", "hi"), ("3", "5", "F", "mid")], schemas.PATIENT)
    claims = spark.createDataFrame(
        [("d", "1", "0604"), ("d", "1", "0604"), ("d", "1", "0019"), ("d", "2", "0604"),
         ("d", "2", "9999")],  # unknown code drops; patient 3 has no claims
        schemas.PATIENT_CLAIM)
    procedure = spark.createDataFrame(
        [("0604", "I", "0604 - A"), ("0604", "I", "0604 - A bis"), ("0019", "O", "0019 - B")],
        schemas.PROCEDURE)
    review = spark.createDataFrame([("1",), ("1",)], schemas.REVIEW)
    return patient, claims, procedure, review


def test_features_fan_out_and_dedupe(spark):
    p, c, q, r = _inputs(spark)
    rows = {x.id: x for x in fe.patient_features(p, c, q, r).collect()}
    assert set(rows) == {"1", "2"}            # no claims / unknown code -> absent
    one = rows["1"]
    assert one.review == 1 and rows["2"].review == 0
    # 0604 twice x two names x listed twice for review = 8; 0019 once x 2
    assert one.type_I == 8 and one.type_O == 2
    assert [(e.claim_id, e.n) for e in one.claims] == [("0019", 2), ("0604", 8)]
    d = {x.id: x for x in fe.patient_features(p, c, q, r, dedupe=True).collect()}
    assert d["1"].type_I == 2 and d["1"].type_O == 1


def test_claims_text_and_decode(spark):
    p, c, q, r = _inputs(spark)
    f = fe.features_as_text(fe.patient_features(p, c, q, r, dedupe=True))
    one = f.where("id = '1'").first()
    assert one.claims == "0019,1,0604,2"
    dec = f.where("id = '1'").select(decode_claims("claims").alias("d")).first().d
    assert [(e.claim_id, e.n) for e in dec] == [("0019", 1), ("0604", 2)]


def _slot(name, probe, n):
    return int(hashlib.md5(f"{name}#{probe}".encode()).hexdigest()[:8], 16) % n


def test_hashing_matches_python_and_collisions_add(spark):
    p, c, q, r = _inputs(spark)
    feats = fe.patient_features(p, c, q, r, dedupe=True)
    n = 3  # tiny space: collisions are certain
    long = {(x.id, x.idx): x.weight for x in fe.hash_features_long(feats, n_features=n).collect()}
    want = {}
    for row in feats.collect():
        terms = [("bias", 0, 1.0), (f"age={row.age}", 0, 1.0), (f"gender={row.gender}", 0, 1.0),
                 (f"income={row.income}", 0, 1.0), ("inpatient", 0, float(row.type_I)),
                 ("outpatient", 0, float(row.type_O))]
        terms += [(f"claim={e.claim_id}", k, float(e.n)) for e in row.claims for k in (0, 1)]
        for name, probe, w in terms:
            key = (row.id, _slot(name, probe, n))
            want[key] = want.get(key, 0.0) + w
    assert long == want
    # row-local vectors agree with the long form
    vec = {x.id: x.features for x in fe.hash_features(feats, n_features=n).collect()}
    for (pid, idx), w in want.items():
        assert vec[pid][idx] == w


def test_feature_dictionary(spark):
    p, c, q, r = _inputs(spark)
    feats = fe.patient_features(p, c, q, r)
    d = fe.feature_dictionary(feats).collect()
    names = {(x.feature, x.probe) for x in d}
    assert ("claim=0604", 1) in names and ("bias", 0) in names
    assert all(x.idx == _slot(x.feature, x.probe, fe.N_FEATURES) for x in d)


def test_runs_of_a_slot_are_summed(spark):
    """slot_sums and norm_and_dots against numpy, with heavy collisions, single
    terms and empty rows; every slot comes once, in order."""
    import numpy as np
    from pyspark.sql import functions as F
    rng = np.random.default_rng(4)
    rows = []
    for i, n in enumerate([0, 1, 2, 5, 40, 700, 5000]):
        rows.append((i, [(int(s), float(v)) for s, v in zip(rng.integers(0, 60, n), rng.normal(size=n))]))
    df = spark.createDataFrame(rows, "id int, terms array<struct<idx:int,value:double>>")
    weights = [rng.normal(size=60), rng.normal(size=60)]
    arrays = [F.array(*[F.lit(float(x)) for x in w]) for w in weights]
    pairs = F.sort_array("terms")
    got = df.select("id", fe.slot_sums(pairs).alias("m"), fe.norm_and_dots(pairs, arrays).alias("f"),
                    fe.norm_and_dots(pairs).alias("g")).collect()
    for r in got:
        dense = np.zeros(60)
        for s, v in rows[r.id][1]:
            dense[s] += v
        slots = sorted({s for s, _ in rows[r.id][1]})
        assert [t.idx for t in r.m] == slots
        assert np.allclose([t.value for t in r.m], dense[slots])
        assert np.isclose(r.f.norm, np.linalg.norm(dense)) and r.g.norm == r.f.norm and r.g.dots == []
        assert np.allclose(r.f.dots, [w @ dense for w in weights])


def test_patient_with_thousands_of_codes(spark):
    """The in-row forms equal the vectors for a patient with 8,000 codes."""
    from pyspark.sql import functions as F
    one = spark.range(1).select(
        F.lit("p").alias("id"), F.lit(1).alias("review"), F.lit("1").alias("age"), F.lit("F").alias("gender"),
        F.lit("x").alias("income"), F.lit(3).cast("bigint").alias("type_I"), F.lit(0).cast("bigint").alias("type_O"),
        F.transform(F.sequence(F.lit(1), F.lit(8000)), lambda i: F.struct(
            i.cast("string").alias("claim_id"), (i % 7 + 1).cast("bigint").alias("n"))).alias("claims"))
    vector = fe.hash_features(one).first().features
    long = {r.idx: r.value for r in fe.vector_long(one).collect()}
    assert long == {int(i): v for i, v in zip(vector.indices, vector.values)}
    plan = fe.merged_terms(one)._jdf.queryExecution().optimizedPlan().toString()
    assert "hashpartitioning" not in plan


def test_vectors_of_odd_rows(spark):
    """Norms, dot products, vectors and long form agree with the column expressions, over
    several slices: patients without claims, null words, rows that share an id."""
    import numpy as np
    from pyspark.sql import functions as F
    rng = np.random.default_rng(3)
    rows = [(str(i % 4_000), i % 2, None if i % 5 == 0 else str(i % 7), "F", None if i % 3 == 0 else "lo\u00e9",
             int(rng.integers(0, 9)), 0, None if i % 11 == 0 else
             [(f"{c:04d}", int(rng.integers(1, 5))) for c in range(int(rng.integers(0, 6)))]) for i in range(4_500)]
    feats = spark.createDataFrame(rows, "id string, review int, age string, gender string, income string, type_I bigint, "
                                        "type_O bigint, claims array<struct<claim_id:string,n:bigint>>").coalesce(1)
    n = 50
    weights = [[float(x) for x in rng.normal(size=n)] for _ in range(2)]
    pairs = fe.hashed_pairs(feats, n)
    arrays = [F.array(*[F.lit(x) for x in w]) for w in weights]
    got = fe.merged_terms(fe.hash_features(feats, n, tuple(feats.columns)), n, "long").select(
        "features", "long", fe.slot_sums(pairs).alias("want"), fe.row_folds(n, weights).alias("f"),
        fe.row_folds(n).alias("g"), fe.norm_and_dots(pairs, arrays).alias("wanted")).collect()
    assert len(got) == len(rows)
    for r in got:
        assert r.long == r.want
        assert list(r.features.indices) == [t.idx for t in r.want] and list(r.features.values) == [t.value for t in r.want]
        assert np.isclose(r.f.norm, r.wanted.norm) and r.g.norm == r.f.norm and r.g.dots == []
        assert np.allclose(r.f.dots, r.wanted.dots)
    assert fe.hash_features(feats.where("false"), n).count() == 0


def test_only_the_seeds_are_hashed_for_the_centroids(spark, tmp_path, monkeypatch):
    """The starting points are looked up by id first; their plan hashes no other row."""
    from claimlens.plans import q_part3
    p, c, q, r = _inputs(spark)
    monkeypatch.setattr(q_part3, "features_of", lambda *a: fe.patient_features(p, c, q, r))
    hashed = spark.sparkContext.accumulator(0)
    seen = fe.vector_long

    def counted(df, *a, **kw):
        hashed.add(df.count())
        return seen(df, *a, **kw)

    monkeypatch.setattr(fe, "vector_long", counted)
    monkeypatch.setattr(q_part3, "K", 1)
    feats, start = q_part3._seeded_points(spark, "")
    assert feats.count() == 2 and hashed.value == 1
    assert {x.cluster for x in start.collect()} == {0}


def test_vectors_are_hashed_once_and_only_for_the_rows_kept(spark):
    """The exploded vectors have no filter that hashes all rows below a join."""
    rows = [(str(i), 0, "3", "F", "low", 2, 1, [("0604", 2)]) for i in range(40)]
    feats = spark.createDataFrame(rows, "id string, review int, age string, gender string, income string, type_I bigint, "
                                        "type_O bigint, claims array<struct<claim_id:string,n:bigint>>")
    kept = feats.join(F.broadcast(spark.createDataFrame([("7",)], "id string")), "id", "left_semi")
    long = fe.vector_long(kept)
    plan = long._jdf.queryExecution().executedPlan().toString()
    assert plan.count("ArrowEvalPython") == 1
    assert plan.index("ArrowEvalPython") < plan.index("LeftSemi")      # the join lies below
    assert {r.id for r in long.collect()} == {"7"} and long.count() == fe.vector_long(feats).count() // 40
    coef = spark.createDataFrame([(1, 0.5)], "idx int, beta double")
    # the scores and the vectors, each once
    assert cl.optimality(coef, feats)._jdf.queryExecution().executedPlan().toString().count("ArrowEvalPython") == 2


def test_types_that_multiply_a_code_alike_give_one_pair(spark):
    patient = spark.createDataFrame([("1", "3", "F", "low")], schemas.PATIENT)
    claims = spark.createDataFrame([("d", "1", c) for c in ("0001", "0002", "0003")] * 2, schemas.PATIENT_CLAIM)
    procedure = spark.createDataFrame(
        [("0001", "I", "a"), ("0001", "O", "b"), ("0002", "I", "a"), ("0002", "O", "b"), ("0002", "O", "c"),
         ("0003", "X", "a")], schemas.PROCEDURE)
    review = spark.createDataFrame([], schemas.REVIEW)
    row = fe.patient_features(patient, claims, procedure, review).first()
    assert [tuple(c) for c in row.claims] == [("0001", 2), ("0002", 2), ("0002", 4), ("0003", 2)]
    assert (row.type_I, row.type_O) == (4, 6)


def test_padded_numbers(spark):
    from pyspark.sql import functions as F

    from claimlens.plans.standins import padded
    rows = spark.createDataFrame([(0,), (7,), (9_999,), (10_000,), (123_456_789,), (-3,), (None,)], "v bigint")
    assert rows.where(~padded(F.col("v"), 4).eqNullSafe(F.format_string("%04d", "v"))).count() == 0


def _plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_vector_and_distance_from_one_hashing(spark):
    from claimlens.operators import clustering as ck
    p, c, q, r = _inputs(spark)
    feats = fe.patient_features(p, c, q, r)
    seeds = spark.createDataFrame([("1", 0), ("2", 1)], "id string, cluster int")
    start = ck.seed_centroids(fe.vector_long(feats), seeds)
    both = ck.assign_features(feats, start, 2, fe.N_FEATURES, ("id",), vector="features")
    plan = _plan(both)
    assert plan.count("ArrowEvalPython [run(") == 1 and "run(coalesce" in plan and "cast(claims" not in plan
    apart = {x.id: x for x in ck.assign_features(feats, start, 2, fe.N_FEATURES, ("id",)).collect()}
    vectors = {x.id: x.features for x in fe.hash_features(feats).collect()}
    for x in both.collect():
        assert x.features == vectors[x.id]
        assert (x.cluster, x.distance, x.norm) == (apart[x.id].cluster, apart[x.id].distance, apart[x.id].norm)


def test_texts_of_codes(spark):
    from claimlens.plans.standins import code_texts, padded
    k = F.col("v")
    rows = spark.createDataFrame([(0,), (7,), (129,), (130,), (-3,), (None,)], "v bigint")
    listed = code_texts(k, [f"{c:04d}" for c in range(130)], padded(k, 4))
    assert rows.where(~listed.eqNullSafe(padded(k, 4))).count() == 0
    assert rows.where("v between 0 and 129").select(code_texts(k, ["a"] * 130, padded(k, 4)).alias("t")).distinct().count() == 1


def test_crosstab_starts_no_python(spark):
    from claimlens.operators import clustering as ck
    points = spark.range(6).select((F.col("id") % 2).cast("int").alias("cluster"), F.lit(0).alias("label"))
    table = ck.crosstab(points, 2)
    assert "ExistingRDD" not in _plan(table)
    assert {(r.cluster, r.label): r.n for r in table.collect()} == {(0, 0): 3, (1, 0): 3, (0, 1): 0, (1, 1): 0}


def test_dictionary_makes_names_distinct_before_it_hashes_them(spark):
    feats = spark.createDataFrame(
        [("1", 0, None, "F", "low", 2, 1, [("0604", 2), ("0019", 1)]), ("2", 1, "4", "M", "hi", 0, 3, [("0019", 3)]),
         ("3", 0, "4", "M", "hi", 0, 0, None), ("4", 0, "4", "M", "hi", 0, 0, [])],
        "id string, review int, age string, gender string, income string, type_I bigint, "
        "type_O bigint, claims array<struct<claim_id:string,n:bigint>>")
    for probes in ({}, {"claim_probes": 3, "word_probes": 2}):
        said = fe.feature_dictionary(feats, **probes)
        want = fe.hashed_terms(feats, **probes).select("feature", "probe", "idx").distinct()
        assert sorted(map(tuple, said.collect())) == sorted(map(tuple, want.collect()))
    assert fe.feature_dictionary(feats.where("false")).count() == 0
    plan = said._jdf.queryExecution().executedPlan().toString()
    keys = re.findall(r"HashAggregate\(keys=\[([^\]]*)", plan)
    assert keys and not any("idx" in k for k in keys)     # slots are no part of what is made distinct


def test_patients_are_looked_up_without_sorting_the_lists(spark):
    claims = spark.createDataFrame([("1", "0604"), ("1", "0604"), ("2", "0019")], "patient_id string, claim_id string")
    patient = spark.createDataFrame([("1", "3", "F", "low"), ("2", "4", "M", "hi")], "id string, age string, gender string, income string")
    procedure = spark.createDataFrame([("0604", "I", "a"), ("0019", "O", "b")], "id string, type string, full_name string")
    review = spark.createDataFrame([("2",)], "patient_id string")
    out = fe.patient_features(patient, claims, procedure, review)
    assert "ShuffledHashJoin" in out._jdf.queryExecution().executedPlan().toString()
    assert sorted((r.id, r.review, r.type_I, r.type_O, [tuple(c) for c in r.claims]) for r in out.collect()) == [
        ("1", 0, 2, 0, [("0604", 2)]), ("2", 1, 0, 1, [("0019", 1)])]
