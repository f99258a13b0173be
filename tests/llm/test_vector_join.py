"""Operator 6 against all pairs."""
import re

import numpy as np

from claimlens.llm import vector_join as vj

SCHEMA = "vec_id bigint, embedding array<float>, label int, n int, v string, root int"


def table(spark, rows):
    return spark.createDataFrame([(i, None if e is None else [None if x is None else float(x) for x in e], 1, 2, "v", 3)
                                  for i, e in rows], SCHEMA)


def brute(rows, threshold=0.9):
    def ok(e):
        return e is not None and len(e) > 0 and all(x is not None and np.isfinite(x) for x in e) and any(e)
    good = [(i, np.array(np.float32(e), float)) for i, e in rows if i is not None and ok(e)]
    parent = {i: i for i, _ in rows if i is not None}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    links = {k: 0 for k in range(len(good))}
    for a, (i, x) in enumerate(good):
        for b, (j, y) in enumerate(good[:a]):
            if len(x) == len(y) and x @ y / np.linalg.norm(x) / np.linalg.norm(y) >= threshold:
                links[a] += 1
                links[b] += 1
                p, q = sorted((find(i), find(j)))
                parent[q] = p
    out = [(i, links[k], find(i)) for k, (i, _) in enumerate(good)]
    return sorted(out + [(i, 0, i) for i, e in rows if i is not None and not ok(e)])


def vectors(seed, n, d, groups):
    rng = np.random.default_rng(seed)
    centre = rng.normal(size=(groups, d))
    return [centre[rng.integers(groups)] * rng.uniform(0.1, 9) + rng.normal(size=d) * rng.uniform(0, 0.5)
            for _ in range(n)]


def result(df):
    return sorted((r.vec_id, r.n_links, r.component_id) for r in vj.linked_vectors(df).collect())


def test_equals_all_pairs_over_many_blocks(spark, monkeypatch):
    monkeypatch.setattr(vj, "BLOCK", 16)
    monkeypatch.setattr(vj, "SUB_BLOCK", 4)
    rows = [(3 * k + 1, e) for k, e in enumerate(vectors(1, 300, 12, 40))]
    rows += [(5000 + k, rows[7][1]) for k in range(40)]
    got = result(table(spark, rows))
    assert got == brute(rows) and sum(n for _, n, _ in got) > 500


def test_odd_vectors(spark):
    e = [1.0, 2.0, 3.0]
    rows = [(1, e), (2, e), (2, e), (3, None), (4, [0.0, 0.0, 0.0]), (5, [1.0, None, 1.0]), (6, [float("nan"), 1, 1]),
            (7, [float("inf"), 1, 1]), (8, []), (9, [1.0, 2.0]), (10, [2.0, 4.0]), (11, [2.0, 4.0, 6.0]),
            (12, [1e-30, 2e-30, 3e-30]), (13, [1e30, 2e30, 3e30]), (14, [-1.0, -2.0, -3.0])]
    assert result(table(spark, rows)) == brute(rows)
    got = vj.linked_vectors(table(spark, [(None, e), (1, e)])).collect()
    assert sorted((r.vec_id or -1, r.n_links, r.kept) for r in got) == [(-1, 0, True), (1, 0, True)]
    assert vj.linked_vectors(table(spark, [])).collect() == []


def test_boxes_never_skip_a_link():
    for seed in range(5):
        x = vj.unit(np.array(vectors(seed, 200, 10, 20)))
        axes = vj.principal_axes(x[:100], 4)
        link = vj.links_between(x, None, axes, 0.9)
        assert (link == ((x @ x.T >= 0.9) & ~np.eye(200, dtype=bool))).all()
        cross = vj.links_between(x[:90], x[90:], axes, 0.9)
        assert (cross == link[:90, 90:]).all()


def test_no_vector_is_shuffled_for_a_pair_of_blocks(spark, monkeypatch):
    """Disk grows with the vectors, not with the pairs of blocks."""
    monkeypatch.setattr(vj, "BLOCK", 16)
    plans, stored = {}, vj.stored

    def watched(df, name):
        plans[name] = df._jdf.queryExecution().explainString(
            spark._jvm.org.apache.spark.sql.execution.ExplainMode.fromString("formatted"))
        return stored(df, name)
    monkeypatch.setattr(vj, "stored", watched)
    rows = list(enumerate(np.random.default_rng(5).normal(size=(300, 64)).tolist()))
    assert result(table(spark, rows)) == brute(rows)
    nodes = re.findall(r"\(\d+\) (\w+).*\n(?:Left output|Input|Output) \[\d+\]: (.*)", plans["vector-links"])
    assert any("vectors" in columns for _, columns in nodes)
    assert not [columns for node, columns in nodes if "Exchange" in node and "vectors" in columns]


def test_bound_of_leading_dimensions_never_skips_a_link():
    rng = np.random.default_rng(7)
    x = rng.normal(size=(700, 64))
    x[350:] = x[:350] + rng.normal(size=(350, 64)) * rng.uniform(0.3, 0.7, size=(350, 1))
    u = vj.unit(x)
    axes = vj.principal_axes(u, 64)
    lead = vj.lead_dimensions(u[:350], axes, 0.9)
    assert 0 < lead <= 32
    want = u @ u.T >= 0.9
    assert 20 < np.triu(want, 1).sum() < 350
    for n in (0, 8, lead):
        assert (vj.links_between(x, None, axes, 0.9, n) == (want & ~np.eye(700, dtype=bool))).all()
        assert (vj.links_between(x.astype(np.float32)[:90], x.astype(np.float32)[90:], axes, 0.9, n) == want[:90, 90:]).all()


def test_one_hash_for_two_vectors(spark, monkeypatch):
    """Rows meet their class by the vector where hashes clash; minus zero is zero."""
    rows = [(1, [1.0, 0.0]), (2, [1.0, -0.0]), (3, [0.0, 1.0]), (4, [0.0, 2.0]), (5, [0.0, 1.0]), (6, [-1.0, 1.0])]
    want = brute(rows)
    assert result(table(spark, rows)) == want
    monkeypatch.setattr(vj.F, "xxhash64", lambda *c: vj.F.lit(7).cast("bigint"))
    assert result(table(spark, rows)) == want


def test_few_links_connect_what_all_links_connect():
    rng = np.random.default_rng(3)
    for share in (0.02, 0.1, 0.5, 1.0):
        for _ in range(20):
            part = (rng.random((9, 14)) < share) & (rng.random(9) < 0.8)[:, None]
            p, q = vj.few_links(part)
            assert part[p, q].all()
            left, right = np.arange(9), np.arange(9, 23)
            for few, many in zip(vj.smallest_linked(p, q, left, right),
                                 vj.smallest_linked(*np.nonzero(part), left, right), strict=True):
                assert (few == many).all()


def test_chains_over_many_blocks(spark, monkeypatch):
    """Groups that a task meets bit by bit: each vector links two others only."""
    monkeypatch.setattr(vj, "BLOCK", 4)
    rng = np.random.default_rng(11)
    rows = []
    for a in range(6):
        for k in range(15):
            e = [0.0] * 12
            e[2 * a], e[2 * a + 1] = np.cos(0.4 * k), np.sin(0.4 * k)   # 0.4 links, 0.8 does not
            rows.append(e)
    rows = [(int(i), e) for i, e in zip(rng.permutation(len(rows)), rows, strict=True)]
    got = result(table(spark, rows))
    assert got == brute(rows) and len({c for _, _, c in got}) == 6


def test_rows_of_a_large_group_grow_with_its_vectors(spark, monkeypatch):
    """Not with its pairs of blocks: 100 blocks of one group in at most 4 files."""
    monkeypatch.setattr(vj, "BLOCK", 4)
    kept, stored = {}, vj.stored

    def watched(df, name):
        kept[name] = stored(df, name)
        return kept[name]
    monkeypatch.setattr(vj, "stored", watched)
    rng = np.random.default_rng(13)
    rows = [(i, e) for i, e in enumerate((np.ones(24) + rng.normal(size=(400, 24)) * 0.05).tolist())]
    got = result(table(spark, rows))
    assert got == [(i, 399, 0) for i in range(400)]
    assert kept["vector-links"].where("n > 0").count() <= 2 * 4 * 400
    assert kept["vector-links"].count() <= 3 * 4 * 400      # 40,000 by pairs of blocks
