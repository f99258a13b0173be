"""Operator 9: EM on known labellers, held-out agreement, odd rows."""
import random

import numpy as np
from pyspark.sql import functions as F

from claimlens.llm import quality as q

WORDS = "alpha beta gamma delta river stone light house green paper story quiet window market".split()
FUNCTION = "the of and to in is that it for was as with".split()


def good(rng, n=80):
    out = []
    for k in range(n):
        w = rng.choice(FUNCTION) if rng.random() < 0.4 else rng.choice(WORDS) + rng.choice(["", "s", "ly"])
        out.append(w + ("." if k % 12 == 11 else ""))
    return " ".join(out)


def bad(rng, kind):
    words = good(rng).split()
    if kind == 0:
        return " ".join(w + rng.choice(["%%%", "***", "$$$"]) for w in words)
    if kind == 1:
        return " | ".join(w for w in words if w not in FUNCTION)
    if kind == 2:
        return " ".join(w.upper() + "!!" for w in words)
    return "\n".join([rng.choice(WORDS) + " "] * 1) + " ".join(x for w in words[:6] for x in [w] * 30)


def rows(seed, n):
    rng = random.Random(seed)
    return [(i, bad(rng, i % 4) if rng.random() < 0.2 else good(rng)) for i in range(n)]


def test_label_model_recovers_accuracies():
    rng = np.random.default_rng(0)
    truth = rng.random(20000) < 0.15
    votes = []
    rate = {k: (0.3 if k < 6 else 0.0, 0.002) for k in range(10)}
    for t in truth:
        p = [rate[k][0 if t else 1] for k in range(10)]
        votes.append("".join("0" if rng.random() < x else "1" for x in p))
    counts = {}
    for v in votes:
        counts[v] = counts.get(v, 0) + 1
    posterior, report = q.label_model(counts)
    for k in range(6):
        assert abs(report["bad_if_bad"][k] - 0.3) < 0.1
    decided = np.array([posterior[v] < 0.5 for v in votes])
    seen = np.array(["0" in v[:6] for v in votes])
    assert (decided == truth)[seen].mean() > 0.9 and not decided[truth == 0].mean() > 0.02
    assert q.label_model({}) [0] == {}


def test_label_model_recovers_an_unreliable_labeller():
    for size in (5_000, 40_000):
        rng = np.random.default_rng(1)
        truth = rng.random(size) < 0.1
        said = rng.random((size, 10)) < np.where(truth[:, None], 0.4, [0.1] + [0.002] * 9)
        votes = ["".join("0" if x else "1" for x in r) for r in said]
        names, n = np.unique(votes, return_counts=True)
        posterior, report = q.label_model(dict(zip(names.tolist(), n.tolist(), strict=True)))
        assert abs(report["bad_if_good"][0] - 0.1) < 0.02
        decided = np.array([posterior[v] < 0.5 for v in votes])
        assert posterior["0" + "1" * 9] > 0.5 and decided[~truth].mean() < 0.03 and decided[truth].mean() > 0.9


def test_fitted_scorer_keeps_good_and_rejects_each_kind(docs_of):
    docs = docs_of(rows(1, 600))
    model = q.fit_quality(docs)
    rng = random.Random(9)
    fresh = [(i, good(rng)) for i in range(40)] + [(100 + i, bad(rng, i % 4)) for i in range(40)]
    got = {r.doc_id: r.s for r in docs_of(fresh).select("doc_id", model.score("text").alias("s")).collect()}
    assert all(got[i] >= q.KEEP_FROM for i in range(40))
    assert np.mean([got[100 + i] < q.KEEP_FROM for i in range(40)]) >= 0.95
    assert model.report["labeller"].tolist() == list(q.LABELLERS)


def test_long_words_are_read_to_the_end():
    clean = "a" * 64
    words = q.Words()
    f = [q.features(t, words).tolist() for t in (clean, clean + "#$%" * 1000, clean + "b" * 64)]
    assert len(f[0]) == 1 and len(f[1]) > 100 and f[0] != f[2]
    shape = q.features("#$%" * 21 + "#", q.Words())[0]
    assert shape in q.features(clean + "#$%" * 21 + "#", q.Words())
    assert q.features("one two, three", words).tolist() == q.features("one two, three", q.Words()).tolist()


def test_the_sample_is_bounded_whatever_the_ids(docs_of, monkeypatch):
    sizes = []
    fit = q.fit_logistic
    monkeypatch.setattr(q, "fit_logistic", lambda i, v, r, y, d: sizes.append(len(y)) or fit(i, v, r, y, d, steps=2))
    for ids, texts in ((None, rows(3, 400)), (7, rows(3, 400)), (None, rows(3, 1) * 400)):
        q.fit_quality(docs_of([(ids, t) for _, t in texts]), sample_rows=40)
    assert max(sizes) <= 80 and all(n > 10 for n in sizes[:2])


def test_odd_rows(docs_of):
    docs = docs_of(rows(2, 60) + [(None, None), (7, ""), (7, ""), (8, "word " * 50_000), (None, "x")])
    model = q.fit_quality(docs, sample_rows=10)
    got = docs.select("text", model.score("text").alias("s")).collect()
    assert len(got) == 65 and all(0 <= r.s <= 1 for r in got)
    assert all(r.s == 0 for r in got if not (r.text or "").split())
    empty = docs.where(F.lit(False))
    assert empty.select(q.fit_quality(empty).score("text")).collect() == []


def test_workers_do_not_load_pandas_and_let_go_of_their_batch(monkeypatch):
    import os
    import subprocess
    import sys

    import pyarrow as pa
    from claimlens.llm import quality as ql
    code = "import sys, claimlens.llm.quality; sys.exit('pandas' in sys.modules)"
    root = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
    assert subprocess.run([sys.executable, "-c", code], cwd=root).returncode == 0
    made, held = [], []
    monkeypatch.setattr(ql.F, "arrow_udf", lambda kind: lambda f: made.append(f) or (lambda column: None))
    monkeypatch.setattr(ql, "freed", lambda: held.append(pa.total_allocated_bytes()))
    ql._votes_udf()
    ql.QualityModel(np.zeros(ql.DIMS + 1), None).score(None)
    before = pa.total_allocated_bytes()
    for run in made:
        for a in run(pa.array([f"some words {i}. " * 50, None]) for i in range(3)):
            assert len(a) == 2
            del a
    assert held == [before, before]
