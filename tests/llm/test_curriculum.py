"""Operator 11: targets, exact words per source, positions, odd input."""

from __future__ import annotations

import hashlib
import re

import pytest

from claimlens.llm import curriculum as cu

SCHEMA = "doc_id bigint, text string, source string"


def brute(rows):
    """{row number: taken}, {source: target} by the plain rule."""
    size = [len(re.findall(r"[^\x20\x09-\x0D]+", t or "")) for _, t, _ in rows]
    names = sorted({s for *_, s in rows}, key=lambda s: (s is None, (s or "").encode()))
    total = {n: sum(z for z, r in zip(size, rows) if r[2] == n) for n in names}
    weight = {n: (5, 2, 1)[i % 3] for i, n in enumerate(names)}
    target, free, rest = {}, set(names), 1.5 * sum(size)
    while free:
        share = {n: rest * weight[n] / sum(weight[m] for m in free) for n in free}
        over = [n for n in free if share[n] > 2 * total[n]]
        if not over:
            target |= share
            break
        for n in over:
            target[n] = 2.0 * total[n]
            rest -= target[n]
            free.remove(n)
    taken = {}
    for n in names:
        mine = sorted((hashlib.md5(f"{'-' if r[0] is None else r[0]}:{cu.SEED}:{r[1] or ''}".encode()).hexdigest(), i)
                      for i, r in enumerate(rows) if r[2] == n)
        wanted, before = round(target[n]), 0
        for _, i in mine:
            taken[i] = sum(max(0, min(size[i], wanted - before - p * total[n])) for p in (0, 1))
            before += size[i]
    return size, taken, target


def rows_of(n: int):
    return [(i, " ".join(["w"] * (i * 7 % 40)), ["a", "b", "b", "b", None, "é", "c"][i % 7]) for i in range(n)]


def test_equals_the_plain_rule(spark):
    rows = rows_of(300)
    size, taken, target = brute(rows)
    out = {r.doc_id: r for r in cu.report(spark.createDataFrame(rows, SCHEMA)).collect()}
    assert len(out) == 300
    for i, (_, _, source) in enumerate(rows):
        assert (out[i]["size"], out[i].taken) == (size[i], taken[i])
        assert out[i].target == pytest.approx(target[source])
        assert out[i].taken <= 2 * out[i]["size"]
    for name in target:
        mine = [out[i] for i, r in enumerate(rows) if r[2] == name]
        assert sum(r.taken for r in mine) == round(target[name])


def test_training_order_follows_the_schedules(spark):
    """Words of a source by a progress are the integral of its schedule."""
    docs = spark.createDataFrame([(i, "w " * 10, "abc"[i % 3]) for i in range(3000)], SCHEMA)
    mixed = cu.mix(docs)
    got = cu.training_order(mixed).collect()
    assert [r.position for r in got] == sorted(r.position for r in got)
    assert sum(r.words for r in got) == sum(sum(p.words for p in r.passes) for r in mixed.collect())
    for kind, name in enumerate("abc"):
        schedule = cu.SCHEDULES[kind]
        whole = sum(r.words for r in got if r.source == name)
        for t in (0.25, 0.5, 0.9):
            part, reached = 0.0, 0.0
            for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
                x = min(max(t - t0, 0.0), t1 - t0)
                part += w0 * x + (w1 - w0) / (t1 - t0) * x * x / 2
            reached = sum(r.words for r in got if r.source == name and r.position < t)
            assert reached == pytest.approx(whole * part / cu.integral(schedule), abs=11)


def test_hot_source_and_repeated_ids(spark):
    rows = [(i if i % 2 else 7, f"x{i} y z", "hot" if i % 3 else f"s{i}") for i in range(500)]
    out = cu.report(spark.createDataFrame(rows, SCHEMA)).collect()
    assert len(out) == 500
    again = cu.report(spark.createDataFrame(rows[::-1], SCHEMA).repartition(5)).collect()
    assert sorted(map(repr, out)) == sorted(map(repr, again))


def test_odd_rows(spark):
    rows = [(1, None, "a"), (2, "", "a"), (None, " \t\n", None), (3, "one", "b"), (3, "one", "b"), (4, "long " * 5000, "b")]
    docs = spark.createDataFrame([(*r, 1, 2) for r in rows], SCHEMA + ", size int, target int")
    out = cu.report(docs).collect()
    size, taken, _ = brute(rows)
    assert sorted((r["size"], r.taken) for r in out) == sorted((size[i], taken[i]) for i in range(6))
    assert all(r.position is None for r in out if r.taken == 0)
    assert cu.report(docs.where("false")).collect() == []
    assert [r.taken for r in cu.report(docs.where("text is null")).collect()] == [0]


def test_inverse_of_the_integral(spark):
    from pyspark.sql import functions as F
    schedule = ((0.0, 0.0), (0.4, 3.0), (0.5, 1.0), (1.0, 1.0))
    got = spark.range(1001).select((F.col("id") / 1000).alias("y")) \
        .select("y", cu.progress_at(F.col("y"), schedule).alias("t")).collect()
    for r in got:
        part = 0.0
        for (t0, w0), (t1, w1) in zip(schedule, schedule[1:]):
            x = min(max(r.t - t0, 0.0), t1 - t0)
            part += w0 * x + (w1 - w0) / (t1 - t0) * x * x / 2
        assert part / cu.integral(schedule) == pytest.approx(r.y, abs=1e-9)
