"""Per-patient features and their hashed sparse vectors.

``patient_features`` follows the two-level aggregation of the source job
(count per claim code, then per patient) but aggregates the claims *before*
any join: a patient holding a third of all claims ships one partial row per
(code, map task), never its raw claims. Join fan-out (a code with two names,
a patient listed twice for review) is kept as the defined result by carrying
multiplicities, unless ``dedupe=True``.

Hashing is row-local and needs no shuffle: Arrow UDFs hash each distinct feature
name of a slice of rows once and sum colliding slots of all its rows together, into
sparse vectors, long form, or norms and dot products (``row_folds``). The cost goes
with a row's number of terms, also for patients with thousands of codes.
``hashed_pairs``, ``slot_sums`` and ``norm_and_dots`` are the same as column
expressions, for other sources of terms.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from claimlens.functions import claims_text, leading_digits
from claimlens.operators.common import join_small
from claimlens.schemas import CLAIM_COUNT

N_FEATURES = 10_000       # vector slots
CLAIM_PROBES = 2          # slots per claim code
WORD_PROBES = 1           # slots per age / gender / income word
FEATURE_KEYS = ("id", "review", "age", "gender", "income")
SLICE_ROWS = 2_000        # rows of an Arrow batch that are hashed at once


def procedure_dim(charges: DataFrame) -> DataFrame:
    """C8 + I3: distinct (id = leading digits of the code, type, full name)."""
    return charges.select("type", "procedure_id").distinct() \
        .select(leading_digits("procedure_id").alias("id"), "type", F.col("procedure_id").alias("full_name"))


def patient_features(patient: DataFrame, claims: DataFrame, procedure: DataFrame,
                     review: DataFrame, dedupe: bool = False,
                     max_broadcast_rows: int = 2_000_000) -> DataFrame:
    """Id, review, age, gender, income, type_I, type_O, claims.

    ``claims`` is ``array<struct<claim_id, n>>`` (the distinct pairs, sorted),
    ``type_I``/``type_O`` sum the claim counts by procedure type, ``review``
    is 1 when the patient is on the review list. Patients without a claim,
    and claims whose code is not a procedure, drop (inner joins).
    """
    # E2, first level, before any join: one row per (patient, code).
    per_code = claims.groupBy("patient_id", "claim_id").agg(F.count(F.lit(1)).alias("n"))

    # Multiplicity of each dimension key = the join's fan-out.
    proc = procedure.select(F.col("id").alias("claim_id"), "type")
    if dedupe:
        proc = proc.distinct()
    # A row per code and fan-out: types that multiply a code alike give its patients one
    # pair, so the pairs collected below are distinct without a set.
    mult = F.col("proc_mult")
    proc = proc.groupBy("claim_id", "type").agg(F.count(F.lit(1)).alias("proc_mult")) \
        .groupBy("claim_id", "proc_mult").agg(
            F.sum(F.when(F.col("type") == "I", mult).otherwise(F.lit(0))).alias("mult_I"),
            F.sum(F.when(F.col("type") == "O", mult).otherwise(F.lit(0))).alias("mult_O"))

    rev = review.select(F.col("patient_id").alias("id"))
    if dedupe:
        rev = rev.distinct()
    rev = rev.groupBy("id").agg(F.count(F.lit(1)).alias("review_mult"))

    # The procedure dimension is bounded by the code vocabulary: broadcast
    # after a row-count check.
    typed = join_small(per_code, proc, "claim_id", "inner", max_broadcast_rows, "procedure")

    # Second level: per patient, before the join, so that it sees one row of claims a
    # patient. A patient has at most one row per code and fan-out here.
    n = F.col("n")
    per_patient = typed.select("patient_id", "claim_id", (n * mult).alias("n"), (n * F.col("mult_I")).alias("n_I"),
                               (n * F.col("mult_O")).alias("n_O")).repartition("patient_id") \
        .groupBy("patient_id").agg(
            F.sum("n_I").alias("n_I"), F.sum("n_O").alias("n_O"),
            F.sort_array(F.collect_list(F.struct("claim_id", "n"))).alias("codes"))

    # A patient's rows and flags multiply all its counts alike. An id has one or a few
    # patient rows, so the shuffle by id cannot be skewed. They are looked up in a hash
    # table of the task's patients: the rows of claims need no sort.
    pts = patient.repartition("id").groupBy("id", "age", "gender", "income") \
        .agg(F.count(F.lit(1)).alias("patient_mult")) \
        .join(rev, "id", "left")
    times = F.col("patient_mult") * F.coalesce(F.col("review_mult"), F.lit(1))
    return per_patient.join(pts.hint("shuffle_hash"), per_patient.patient_id == pts.id, "inner").select(
        "id", F.when(F.col("review_mult").isNull(), F.lit(0)).otherwise(F.lit(1)).alias("review"),
        "age", "gender", "income",
        (F.col("n_I") * times).alias("type_I"), (F.col("n_O") * times).alias("type_O"),
        F.when(times == 1, F.col("codes")).otherwise(F.transform(
            "codes", lambda c: F.struct(c["claim_id"].alias("claim_id"), (c["n"] * times).alias("n")))).alias("claims"))


def features_as_text(features: DataFrame) -> DataFrame:
    """The stored (text) form of the feature table: claims as ``'id,n,...'``."""
    return features.withColumn("claims", claims_text("claims"))


# ---- J2: feature hashing ----------------------------------------------------

def slot(name: Column, probe: Column, n_features: int = N_FEATURES) -> Column:
    """Vector slot of ``(feature name, probe)``: md5 of ``name#probe``,
    first 8 hex digits as a number, modulo ``n_features``."""
    h = F.conv(F.substring(F.md5(F.concat(name, F.lit("#"), probe.cast("string"))), 1, 8), 16, 10)
    return (h.cast("bigint") % F.lit(n_features)).cast("int")


def _probed(name: Column, weight: Column, probes: int) -> list[Column]:
    return [F.struct(name.alias("feature"), F.lit(p).alias("probe"),
                     weight.cast("double").alias("weight")) for p in range(probes)]


def feature_terms(features: DataFrame, claim_probes: int = CLAIM_PROBES,
                  word_probes: int = WORD_PROBES) -> Column:
    """Every (feature, probe, weight) term of a patient row, as an array.

    bias (1), the age / gender / income words (1 each), inpatient = type_I,
    outpatient = type_O (one probe each), and each claim code weighted by its
    count over ``claim_probes`` probes.
    """
    fixed = (
        _probed(F.lit("bias"), F.lit(1.0), 1)
        + _probed(F.concat(F.lit("age="), F.coalesce("age", F.lit(""))), F.lit(1.0), word_probes)
        + _probed(F.concat(F.lit("gender="), F.coalesce("gender", F.lit(""))), F.lit(1.0),
                  word_probes)
        + _probed(F.concat(F.lit("income="), F.coalesce("income", F.lit(""))), F.lit(1.0),
                  word_probes)
        + _probed(F.lit("inpatient"), F.col("type_I"), 1)
        + _probed(F.lit("outpatient"), F.col("type_O"), 1)
    )
    claim_terms = F.flatten(F.transform(
        F.coalesce(F.col("claims"), F.array().cast(T.ArrayType(CLAIM_COUNT))),
        lambda c: F.array(*[F.struct(F.concat(F.lit("claim="), c["claim_id"]).alias("feature"),
                                     F.lit(p).alias("probe"),
                                     c["n"].cast("double").alias("weight"))
                            for p in range(claim_probes)])))
    return F.concat(F.array(*fixed), claim_terms)


def hashed_terms(features: DataFrame, n_features: int = N_FEATURES, **probes) -> DataFrame:
    """Long form before collision sums: id, review, feature, probe, idx, weight."""
    t = features.select("id", "review", F.explode(feature_terms(features, **probes)).alias("t"))
    return t.select("id", "review", F.col("t.feature").alias("feature"),
                    F.col("t.probe").alias("probe"),
                    slot(F.col("t.feature"), F.col("t.probe"), n_features).alias("idx"),
                    F.col("t.weight").alias("weight"))


def hash_features_long(features: DataFrame, n_features: int = N_FEATURES, **probes) -> DataFrame:
    """J2 long form: id, review, idx, weight with colliding terms summed."""
    return vector_long(features, n_features, ("id", "review"), **probes) \
        .withColumnRenamed("value", "weight")


def feature_dictionary(features: DataFrame, n_features: int = N_FEATURES, **probes) -> DataFrame:
    """Feature name -> the slots it was hashed to (feature, probe, idx). Words and
    codes are made distinct first, so each name is built and hashed once, not in every row."""
    words = features.select("age", "gender", "income").distinct() \
        .withColumns({"type_I": F.lit(0), "type_O": F.lit(0), "claims": F.lit(None).cast(T.ArrayType(CLAIM_COUNT))})
    codes = features.select(F.explode("claims.claim_id").alias("code")).distinct()
    probe = F.explode(F.array(*[F.lit(p) for p in range(probes.get("claim_probes", CLAIM_PROBES))]).cast("array<int>"))
    names = words.select(F.explode(feature_terms(words, **probes)).alias("t")).select("t.feature", "t.probe").distinct() \
        .union(codes.select(F.concat(F.lit("claim="), "code").alias("feature"), probe.alias("probe")))
    return names.withColumn("idx", slot(F.col("feature"), F.col("probe"), n_features))


def term_arrays(features: DataFrame, n_features: int = N_FEATURES, **probes) -> tuple[Column, Column]:
    """Per row: the slot of every term and its weight, as two arrays
    (collisions not yet summed). Hashing runs JVM-side."""
    terms = feature_terms(features, **probes)
    idx = F.transform(terms, lambda t: slot(t["feature"], t["probe"], n_features))
    weight = F.transform(terms, lambda t: t["weight"])
    return idx, weight


def _slots(names: list[str], probes: int, n_features: int) -> np.ndarray:
    """``slot`` of every name and probe: (names, probes)."""
    return np.array([[int(hashlib.md5(f"{name}#{p}".encode()).hexdigest()[:8], 16) % n_features
                      for p in range(probes)] for name in names], np.int64).reshape(len(names), probes)


def _term_columns() -> list[Column]:
    """What a feature row's terms are made of."""
    return [*[F.coalesce(F.col(c).cast("string"), F.lit("")) for c in ("age", "gender", "income")],
            *[F.col(c).cast("double") for c in ("type_I", "type_O")],
            F.col("claims")]     # as they are: a cast here would build every pair anew


def _summed(columns: Sequence[pa.Array], n_features: int, claim_probes: int = CLAIM_PROBES,
            word_probes: int = WORD_PROBES) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """(row, slot, value) of the vectors of all rows, by row and slot: the terms of
    ``feature_terms`` with those of one slot summed. A claim without a code has no slot."""
    *words, type_i, type_o, claims = columns
    n = len(claims)
    every, one = np.arange(n), np.ones(n)
    terms = []      # (row, slot, weight)
    for name, column in zip(("age", "gender", "income"), words, strict=True):
        coded = column.dictionary_encode()
        slots = _slots([f"{name}={v}" for v in coded.dictionary.to_pylist()], word_probes, n_features)
        terms += [(every, slots[coded.indices.to_numpy(), p], one) for p in range(word_probes)]
    for name, weight in (("bias", one), ("inpatient", _numbers(type_i)), ("outpatient", _numbers(type_o))):
        terms.append((every, np.full(n, _slots([name], 1, n_features)[0, 0]), weight))
    lengths = pc.fill_null(pc.list_value_length(claims), 0).to_numpy()
    flat = claims.flatten()
    codes, rows = flat.field("claim_id").dictionary_encode(), np.repeat(every, lengths)
    at = pc.fill_null(codes.indices, -1).to_numpy()
    known = at >= 0
    rows, weight = rows[known], _numbers(flat.field("n"))[known]
    slots = _slots([f"claim={v}" for v in codes.dictionary.to_pylist()], claim_probes, n_features)[at[known]]
    terms += [(rows, slots[:, p], weight) for p in range(claim_probes)]
    key = np.concatenate([r * n_features + s for r, s, _ in terms])
    order = np.argsort(key, kind="stable")
    key, value = key[order], np.concatenate([w for _, _, w in terms])[order]
    if not n:
        return key, key, value
    first = np.flatnonzero(np.concatenate(([True], key[1:] != key[:-1])))
    key = key[first]
    return key // n_features, key % n_features, np.add.reduceat(value, first)


def _numbers(column: pa.Array) -> np.ndarray:
    """As doubles, nulls as NaN."""
    return column.to_numpy(zero_copy_only=False).astype(np.float64, copy=False)


def _nullable(values: np.ndarray) -> pa.Array:
    return pa.array(values, pa.float64(), from_pandas=True)


def _vector_udf(result, make: Callable, n_features: int, **probes) -> Column:
    """``make(rows, row, slot, value)``, an Arrow array, for the vectors of the feature rows,
    a slice of a batch at a time."""
    @F.arrow_udf(result)
    def run(batches: Iterator[tuple[pa.Array, ...]]) -> Iterator[pa.Array]:
        for batch in batches:
            n = len(batch[0])
            parts = [make(min(SLICE_ROWS, n - i), *_summed([c.slice(i, SLICE_ROWS) for c in batch], n_features, **probes))
                     for i in range(0, max(n, 1), SLICE_ROWS)]
            yield pa.concat_arrays(parts)
    return run(*_term_columns())


def _lists(n: int, row: np.ndarray, values: pa.Array) -> pa.Array:
    """A list column of ``n`` rows from the row number of each value."""
    return pa.ListArray.from_arrays(pa.array(np.searchsorted(row, np.arange(n + 1)), pa.int32()), values)


def _vectors(n: int, n_features: int, row: np.ndarray, slot_of: np.ndarray, value: np.ndarray) -> pa.Array:
    """Sparse vectors in their storage form (type 0 = sparse, size, indices, values)."""
    return pa.StructArray.from_arrays(
        [pa.array(np.zeros(n), pa.int8()), pa.array(np.full(n, n_features), pa.int32()),
         _lists(n, row, pa.array(slot_of, pa.int32())), _lists(n, row, pa.array(value, pa.float64()))],
        names=["type", "size", "indices", "values"])


def row_folds(n_features: int, arrays: Sequence[Sequence[float]] = (), vector: bool = False, **probes) -> Column:
    """struct<norm, dots> of a feature row: Euclidean norm of its vector and its dot
    product with each of ``arrays`` (a value for every slot). With ``vector`` also the
    vector itself, hashed once for all three."""
    dense = [np.asarray(a, np.float64) for a in arrays]
    result = T.StructType([T.StructField("norm", T.DoubleType()), T.StructField("dots", T.ArrayType(T.DoubleType())),
                           *([T.StructField("vector", VectorUDT())] if vector else [])])

    def make(n: int, row: np.ndarray, slot_of: np.ndarray, value: np.ndarray) -> pa.Array:
        dots = [np.bincount(row, value * a[slot_of], n) for a in dense]
        flat = np.stack(dots, axis=1).ravel() if dots else np.zeros(0)
        return pa.StructArray.from_arrays(
            [_nullable(np.sqrt(np.bincount(row, value * value, n))),
             pa.ListArray.from_arrays(pa.array(np.arange(n + 1) * len(dots), pa.int32()), _nullable(flat)),
             *([_vectors(n, n_features, row, slot_of, value)] if vector else [])], names=result.names)
    return _vector_udf(result, make, n_features, **probes)


def hash_features(features: DataFrame, n_features: int = N_FEATURES,
                  keep: tuple[str, ...] = ("id", "review"), **probes) -> DataFrame:
    """``keep`` columns plus ``features`` (SparseVector of ``n_features``), the
    vector's storage struct (type 0 = sparse, size, indices, values). No shuffle."""
    def make(n: int, row: np.ndarray, slot_of: np.ndarray, value: np.ndarray) -> pa.Array:
        return _vectors(n, n_features, row, slot_of, value)
    return features.select(*keep, _vector_udf(VectorUDT(), make, n_features, **probes).alias("features"))


def hashed_pairs(features: DataFrame, n_features: int = N_FEATURES, **probes) -> Column:
    """Per row: array<struct<idx, value>> of every hashed term, in slot order
    (terms of one slot side by side, not yet summed)."""
    return F.sort_array(F.transform(feature_terms(features, **probes), lambda t: F.struct(
        slot(t["feature"], t["probe"], n_features).alias("idx"), t["weight"].alias("value"))))


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use(value)`` with ``value`` computed once a row: a lambda's argument is a
    value, so the array is not built again for every element ``use`` looks at."""
    return F.element_at(F.transform(F.array(value), use), 1)


def slot_sums(pairs: Column) -> Column:
    """array<struct<idx, value>> with the runs of one slot summed (each slot once).

    Run lengths: the places where the slot changes are listed first, then every
    run is summed by itself. Each step looks at an element once, so a row costs
    its number of terms, not the square of it."""
    def merged(terms: Column) -> Column:
        def starts_run(i: Column) -> Column:
            return (i == 1) | (F.element_at(terms, i)["idx"] != F.element_at(terms, F.greatest(i - 1, F.lit(1)))["idx"])

        def summed(starts: Column) -> Column:
            ends = F.concat(F.slice(starts, 2, F.greatest(F.size(starts), F.lit(1))), F.array(F.size(terms) + 1))
            return F.zip_with(starts, ends, lambda s, e: F.struct(
                F.element_at(terms, s)["idx"].alias("idx"),
                F.aggregate(F.slice(terms, s, e - s), F.lit(0.0), lambda v, t: v + t["value"]).alias("value")))

        places = F.when(F.size(terms) > 0, F.sequence(F.lit(1), F.size(terms))).otherwise(F.array().cast("array<int>"))
        return F.when(F.size(terms) == 0, terms).otherwise(_bound(F.filter(places, starts_run), summed))

    return _bound(pairs, merged)


def norm_and_dots(pairs: Column, arrays: Sequence[Column] = ()) -> Column:
    """struct<norm, dots>: Euclidean norm of the vector that ``pairs`` (in slot
    order) add up to, and its dot product with each of ``arrays`` (one value a
    slot). One fold whose state is the last slot, the sum in it and the totals."""
    start = F.struct(F.lit(-1).alias("idx"), F.lit(0.0).alias("run"), F.lit(0.0).alias("squares"),
                     *[F.lit(0.0).alias(f"dot{k}") for k in range(len(arrays))])

    def add(state: Column, t: Column) -> Column:
        same = state["idx"] == t["idx"]
        return F.struct(
            t["idx"].alias("idx"),
            F.when(same, state["run"] + t["value"]).otherwise(t["value"]).alias("run"),
            F.when(same, state["squares"]).otherwise(state["squares"] + state["run"] * state["run"]).alias("squares"),
            *[(state[f"dot{k}"] + t["value"] * F.element_at(a, t["idx"] + 1)).alias(f"dot{k}")
              for k, a in enumerate(arrays)])

    def finish(state: Column) -> Column:
        dots = F.array(*[state[f"dot{k}"] for k in range(len(arrays))]).cast("array<double>")
        return F.struct(F.sqrt(state["squares"] + state["run"] * state["run"]).alias("norm"), dots.alias("dots"))

    return F.aggregate(pairs, start, add, finish)


def merged_terms(features: DataFrame, n_features: int = N_FEATURES, name: str = "terms",
                 **probes) -> DataFrame:
    """The feature rows with their vector as ``name``: array<struct<idx,
    value>>, collisions summed inside the row (no shuffle, one vector per
    feature row even where rows share an id)."""
    def make(n: int, row: np.ndarray, slot_of: np.ndarray, value: np.ndarray) -> pa.Array:
        return _lists(n, row, pa.StructArray.from_arrays(
            [pa.array(slot_of, pa.int32()), _nullable(value)], names=["idx", "value"]))
    return features.withColumn(name, _vector_udf("array<struct<idx:int,value:double>>", make, n_features, **probes))


def exploded(terms: str) -> Column:
    """The elements of a vector column, which always has some (the bias). ``explode`` would
    have Spark look for empty vectors first: that filter hashes every row once more, below
    joins that were to leave only a few rows to hash."""
    return F.explode_outer(terms)


def vector_long(features: DataFrame, n_features: int = N_FEATURES,
                keep: tuple[str, ...] = ("id",), **probes) -> DataFrame:
    """Sparse vectors in long form (``keep`` columns, idx, value), collisions
    summed inside the row: no shuffle."""
    return merged_terms(features, n_features, **probes).select(*keep, exploded("terms").alias("t")) \
        .select(*keep, F.col("t.idx").alias("idx"), F.col("t.value").alias("value"))
