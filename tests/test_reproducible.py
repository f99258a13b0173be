"""Sums and questions that do not depend on the order of rows."""

from __future__ import annotations

import math
import random
import statistics
from fractions import Fraction

import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from claimlens.operators import charges as ch
from claimlens.operators.reproducible import exact_avg, exact_sum, grouped_moments, moment_stats

NUMBER = st.one_of(st.floats(-1e9, 1e9), st.floats(-1e-5, 1e-5), st.sampled_from(
    [0.0, -0.0, 0.1, 1e16, -1e16, 1e-20, 2.0**47, 123456.78, 1 / 3, -7.25]))


def _one(spark, values, parts=3):
    df = spark.createDataFrame([(v,) for v in values], "x double").repartition(parts)
    sums = df.agg(exact_sum("x").alias("s"), exact_avg("x").alias("a"))
    return sums.join(moment_stats(grouped_moments(df, [], "x")).select(F.struct("mean", "var_pop", "var_samp").alias("t"))).first()


@settings(max_examples=25, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(NUMBER, min_size=1, max_size=40))
def test_sums_are_exact_but_for_the_last_rounding(spark, values):
    r = _one(spark, values)
    want = float(sum(map(Fraction, values)))
    assert math.isclose(r.s, want, rel_tol=1e-14, abs_tol=1e-20)
    kept = [v for v in values if abs(v) < 2.0**48]
    if len(kept) == len(values):
        mean = float(sum(map(Fraction, values)) / len(values))
        assert math.isclose(r.t.mean, mean, rel_tol=1e-15, abs_tol=1e-20)
        var = float(statistics.pvariance(map(Fraction, values)))
        assert math.isclose(r.t.var_pop, var, rel_tol=1e-9, abs_tol=1e-20)


def test_order_does_not_matter(spark):
    rng = random.Random(1)
    values = [rng.uniform(-1, 1) * 10.0 ** rng.randrange(-8, 12) for _ in range(3000)]
    seen = set()
    for parts in (1, 7, 200):
        rng.shuffle(values)
        r = _one(spark, values, parts)
        seen.add((r.s.hex(), r.a.hex(), r.t.mean.hex(), r.t.var_pop.hex(), r.t.var_samp.hex()))
    assert len(seen) == 1


def test_little_spread_around_a_large_mean(spark):
    values = [1e9 + i * 1e-3 for i in range(50)]
    r = _one(spark, values)
    assert math.isclose(r.t.var_pop, float(statistics.pvariance(map(Fraction, values))), rel_tol=1e-9)
    same = _one(spark, [0.1] * 37)
    assert (same.t.mean, same.t.var_pop, same.t.var_samp) == (0.1, 0.0, 0.0)


def test_odd_values(spark):
    empty = _one(spark, [])
    assert empty.s is None and empty.t.mean is None
    nulls = _one(spark, [None, 2.0, None])
    assert (nulls.s, nulls.a, nulls.t.mean, nulls.t.var_pop, nulls.t.var_samp) == (2.0, 2.0, 2.0, 0.0, None)
    assert _one(spark, [1.0, 1e300]).s == 1e300 and math.isinf(_one(spark, [1.0, math.inf]).s)
    assert math.isnan(_one(spark, [1.0, math.nan]).s)
    huge = _one(spark, [1e20, 3e20])
    assert math.isclose(huge.t.mean, 2e20) and math.isclose(huge.t.var_pop, 1e40)


def _near_tie():
    """Two regions whose weighted means are the same sums in another order, and a
    third a last bit below; plain sums order them by chance."""
    rng = random.Random(7)
    parts = [rng.uniform(1, 1e6) for _ in range(400)]
    rows = []
    for p in ("001 - A", "002 - B", "003 - C"):
        for region in ("AA - X", "BB - Y"):
            mine = parts[:]
            rng.shuffle(mine)
            rows += [(p, region, x) for x in mine]
        rows += [(p, "CC - Z", math.nextafter(x, 0)) for x in parts]
    return [("I", p, str(i % 5), r, 1.0, x, 1.0) for i, (p, r, x) in enumerate(rows)]


@pytest.mark.parametrize("ask", [
    lambda c: ch.relative_variance(c, 3), lambda c: ch.most_top_regions(c, 3), lambda c: ch.region_weighted_mean(c),
    lambda c: ch.provider_dispersion(c, 3), lambda c: ch.region_dispersion(c, 3),
    lambda c: ch.dispersion_stats(c, ["provider_id", "type"])])
def test_questions_are_bit_equal_over_any_partitions(spark, charges_df, ask):
    rows = _near_tie()
    seen = set()
    for parts in (1, 7, 200):
        random.Random(parts).shuffle(rows)
        out = ask(charges_df(rows).repartition(parts)).collect()
        seen.add(tuple(sorted(tuple(v.hex() if isinstance(v, float) else repr(v) for v in r) for r in out)))
    assert len(seen) == 1


def test_a_tie_of_weighted_means_goes_to_the_smaller_region(spark, charges_df):
    top = ch.most_top_regions(charges_df(_near_tie()).repartition(7), 3).collect()
    assert [(r.region, r.cnt) for r in top] == [("X,AA", 3)]
