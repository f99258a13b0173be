"""Operator 8 against brute force."""
import random
from collections import Counter

import numpy as np

from claimlens.llm import minhash as mh
from claimlens.llm.common import WordIds


def shingles(text):
    w = text.lower().split()
    return Counter(tuple(w[k:k + 5]) for k in range(max(1, len(w) - 4))) if w else Counter()


def brute_jp(x, y):
    total = 0.0
    for d in x.keys() & y.keys():
        total += 1 / sum(max(x[q] / x[d], y[q] / y[d]) for q in x.keys() | y.keys())
    return total


def brute_classes(rows, threshold=0.8):
    ids = sorted({i for i, _ in rows if i is not None})
    parent = {i: i for i in ids}

    def find(x):
        while parent[x] != x:
            x = parent[x]
        return x

    sets = [(i, shingles(t or "")) for i, t in rows if i is not None]
    for n, (i, x) in enumerate(sets):
        for j, y in sets[:n]:
            if x and y and brute_jp(x, y) >= threshold:
                a, b = sorted((find(i), find(j)))
                parent[b] = a
    return {i: find(i) for i in ids}


def near_copies(rng, n, words=60, edits=3):
    base = [f"w{rng.randrange(500)}" for _ in range(words)]
    out = []
    for _ in range(n):
        w = list(base)
        for _ in range(rng.randrange(edits + 1)):
            w[rng.randrange(words)] = f"e{rng.randrange(10 ** 6)}"
        out.append(" ".join(w))
    return out


def sets_of(texts):
    ids = WordIds()
    return [mh._weighted_shingles(t.lower().split(), ids) for t in texts]


def test_signature_agreement_estimates_the_similarity():
    rng = random.Random(3)
    a, b = near_copies(rng, 2, words=200, edits=8)
    sa, sb = sets_of([a + " x y z x y z x y z", b])
    sig = mh.probminhash([sa, sb, (sa[0][:0], sa[1][:0])], 4000)
    exact = brute_jp(shingles(a + " x y z x y z x y z"), shingles(b))
    assert abs((sig[0] == sig[1]).mean() - exact) < 0.04
    assert abs(mh.probability_jaccard(*sa, *sb) - exact) < 1e-12
    assert not sig[2].any()


def test_blocks_find_the_links_of_all_pairs():
    rng = random.Random(5)
    texts = near_copies(rng, 40) + near_copies(rng, 30) + [t + " and and and and and and" for t in near_copies(rng, 6)]
    sets = [(x, w if (w > 1).any() else None) for x, w in sets_of(texts)]
    link = mh._linked(sets, 0, 0.8)
    for i in range(len(texts)):
        for j in range(i):
            assert link[i, j] == link[j, i] == (brute_jp(shingles(texts[i]), shingles(texts[j])) >= 0.8)
    half = mh._linked(sets, 35, 0.8)
    assert (half[:35, 35:] == link[:35, 35:]).all() and not half[:35, :35].any() and not half[35:, 35:].any()


def test_forest_keeps_the_groups():
    rng = np.random.default_rng(0)
    for _ in range(30):
        n = 12
        m = rng.random((n, n)) < 0.12
        m = m | m.T
        np.fill_diagonal(m, False)
        a, b = mh._forest(m, np.arange(n))
        parent = list(range(n))
        for x, y in zip(a, b, strict=True):
            parent[y] = x
        label = np.arange(n)
        for _ in range(n):
            label = np.minimum(label, np.where(m, label[None], n).min(axis=1))
        assert parent == label.tolist()


def test_classes_equal_brute_force(docs_of):
    rng = random.Random(1)
    rows, i = [], 0
    for size in (1, 2, 3, 9, 25):
        for t in near_copies(rng, size, edits=4):
            rows.append((i, t))
            i += 1
    rows += [(900, None), (901, ""), (902, " \n "), (903, "one two"), (904, "One  TWO"), (905, "one"),
             (None, "one two"), (906, rows[0][1]), (906, rows[0][1]), (907, "q " * 3000), (908, "q " * 3001),
             (909, "a b c d e f g h"), (909, rows[4][1])]
    rng.shuffle(rows)
    got = {r.doc_id: r.class_id for r in mh.near_duplicate_classes(docs_of(rows)).collect()}
    assert got == brute_classes([(i, t) for i, t in rows if i not in (907, 908)]) | {
        907: got[907], 908: got[907]} and got[907] == 907


def test_blocks_of_a_family_larger_than_a_block(docs_of, monkeypatch):
    monkeypatch.setattr(mh, "BLOCK", 4)
    rows = list(enumerate(near_copies(random.Random(9), 30, edits=5)))
    got = {r.doc_id: r.class_id for r in mh.near_duplicate_classes(docs_of(rows)).collect()}
    assert got == brute_classes(rows)


def test_keep_one_row_of_each_class(docs_of):
    t = near_copies(random.Random(2), 2, edits=1)
    docs = docs_of([(3, t[0]), (5, t[1]), (5, t[1]), (7, "other text"), (7, "other text"), (None, t[0]), (8, None)])
    kept = mh.keep_one(docs, mh.near_duplicate_classes(docs))
    assert kept.columns == docs.columns
    assert sorted(((r.doc_id or -1), r.text or "") for r in kept.collect()) == sorted(
        [(3, t[0]), (7, "other text"), (-1, t[0]), (8, "")])


def test_empty_table(docs_of):
    assert mh.near_duplicate_classes(docs_of([])).collect() == []
