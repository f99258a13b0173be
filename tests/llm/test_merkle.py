"""Operator 13 against a tree built in plain Python; sweeps; tampering; odd input."""

from __future__ import annotations

import random
import zlib
from hashlib import sha256

import pytest
from pyspark.sql import functions as F

from claimlens.llm import merkle as mk

SCHEMA = "doc_id bigint, source string, lang string, n_chars bigint, text string"


def h(*parts: str) -> str:
    return sha256("".join(parts).encode()).hexdigest()


def leaf(row) -> str:
    return h("".join("-" if v is None else f"{len(str(v).encode())}:{v}" for v in row[:5]))


def tree(digests):
    """Levels of the tree, leaves first."""
    levels = [digests]
    while len(levels[-1]) > 1:
        below = levels[-1]
        levels.append([h(*below[i:i + 8]) for i in range(0, len(below), 8)])
    return levels


def way(levels, i):
    """(before, after) of every level up to the root."""
    out = []
    for level in levels[:-1]:
        at = i // 8 * 8
        run = level[at:at + 8]
        out.append(("".join(run[:i - at]), "".join(run[i - at + 1:])))
        i //= 8
    return out


def brute(rows):
    groups = {}
    for r in rows:
        groups.setdefault(r[2], []).append(r)
    names = sorted(groups, key=lambda n: (n is not None, (n or "").encode()))
    trees = []
    for n in names:
        groups[n].sort(key=lambda r: (r[0] is not None, r[0] or 0, leaf(r)))
        trees.append(tree([leaf(r) for r in groups[n]]))
    above = tree([t[-1][0] for t in trees])
    out = []
    for k, n in enumerate(names):
        for i, r in enumerate(groups[n]):
            steps = way(trees[k], i) + way(above, k)
            changed = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 3 == 0 and r[4] is not None
            low = "".join(c.lower() if "A" <= c <= "Z" else c for c in r[4] or "")
            d = leaf((*r[:4], low)) if changed else leaf(r)
            for before, after in steps:
                d = h(before, d, after)
            out.append((r[0], leaf(r), trees[k][-1][0], above[-1][0], h(*[b + a for b, a in steps]), d,
                        d == above[-1][0]))
    return sorted(map(repr, out))


def result(df):
    return sorted(repr(tuple(r)) for r in df.select(
        "doc_id", "leaf", "subroot", "root", "proof_sha256", "folded_root", "verified").collect())


@pytest.mark.parametrize("n, groups, span", [(1, 1, 3), (9, 1, 1), (700, 20, 1), (1200, 3, 2), (600, 1, 3)])
def test_equals_plain_trees(spark, n, groups, span):
    rng = random.Random(n)
    names = [None, "", "é", "en", "EN", *[f"g{i}" for i in range(20)]][:groups]
    # the first group holds most rows
    rows = [(i * 3, f"s{i % 4}", rng.choice([names[0], rng.choice(names)]), i, f"Text {i} Ä Z") for i in range(n)]
    docs = spark.createDataFrame(rows, SCHEMA).repartition(4)
    tamper = F.crc32(F.col("doc_id").cast("string")) % 3 == 0
    assert result(mk.manifest(docs, tamper=tamper, span=span)) == brute(rows)


def test_odd_rows(spark):
    rows = [(None, None, None, None, None), (1, "a", "x", 2, ""), (1, "a", "x", 2, ""), (1, "a", "x", 2, "B"),
            (3, "", "", -5, "long É " * 9000), (6, "a", None, 2, None), (9, "S", "x", 1, "no capitals")]
    docs = spark.createDataFrame([(*r, 1, "c", "d") for r in rows], SCHEMA + ", idx int, digest string, tree string")
    assert result(mk.report(docs)) == brute(rows)
    assert mk.report(docs.where("false")).collect() == []
    assert mk.report(docs.where("false")).columns == mk.report(docs).columns


def test_text_ids_and_no_tampering(spark):
    docs = spark.createDataFrame([(f"d{i}", "s", "en", i, "A") for i in range(20)],
                                 SCHEMA.replace("doc_id bigint", "doc_id string"))
    out = mk.manifest(docs).collect()
    assert all(r.verified for r in out) and len({r.doc_id for r in out}) == 20


@pytest.mark.parametrize("n", [2, 7, 8, 9, 64, 65, 511, 512, 513, 1300])
def test_sweeps_of_one_block_each(n):
    """Forward and reversed sweeps of a tree that one block holds."""
    digests = [h(str(i)) for i in range(n)]
    levels = tree(digests)
    span = len(levels) - 1
    nodes = list(mk.forward_sweep(iter([(5, n, i, d) for i, d in enumerate(digests)]), span))
    made = {(level, i): d for _, _, level, i, _, d, _ in nodes}
    assert made == {(k, i): d for k, level in enumerate(levels) if k for i, d in enumerate(level)}
    rows = [(5, 0, min((i + 1) * 8 ** k, n) - 1, k, i, c, None) for _, _, k, i, c, _, _ in nodes]
    rows += [(5, 0, i, 0, i, None, None) for i in range(n)]
    rows.sort(key=lambda r: (-r[2], -r[3]))
    got = {row[4]: suffix for row, suffix in mk.reversed_sweep(iter([(5, 0, 1 << 62, 9, 0, "", ""), *rows]))}
    for i in range(n):
        assert got[i] == ",".join(f"{b}|{a}" for b, a in way(levels, i))
        assert mk.folded(digests[i], got[i]) == levels[-1][0]


def test_a_missing_message_is_an_error():
    with pytest.raises((ValueError, IndexError)):
        list(mk.reversed_sweep(iter([(5, 0, 1 << 62, 9, 0, "", ""), (5, 0, 8, 1, 1, h("x"), None), (5, 0, 3, 0, 3, None, None)])))
