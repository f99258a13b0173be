"""Operator 12 against plain dynamic programming over (cost, audit)."""

from __future__ import annotations

import random
import re
import zlib
from hashlib import md5, sha256

import numpy as np
import pytest

from claimlens.llm import conversations as cv

SCHEMA = "conv_id bigint, turn bigint, role string, text string"
SPACE = " \t\n\x0b\x0c\r"


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        key = f"{' ' if conv is None else conv}:{' ' if turn is None else turn}"
        fate = zlib.crc32(key.encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else re.sub("[.!?]", "", text) if fate == 2 else text
        out += [(turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return out


def repair(rows):
    """Expected columns of one conversation's (turn, role, text) rows."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(),
                                       md5(f"{r[1]}\0{r[2]}".encode()).hexdigest()))
    turns = {t for t, *_ in rows if t is not None}
    gaps = max(turns) - min(turns) + 1 - len(turns) if turns else 0
    fault, seen = [], set()
    for _, role, text in rows:
        fault.append("blank" if not text.strip(SPACE) else "duplicate" if (role, text) in seen
                     else "truncated" if text.rstrip(SPACE)[-1] not in ".!?" else "")
        seen.add((role, text))
    first = [r[1][:1] for r in rows]
    illegal = sum(a + b not in ("su", "ua", "au") for a, b in zip(first, first[1:]))

    def keep(state, c):
        return {("0", "s"): "1", ("0", "u"): "2", ("1", "u"): "2", ("2", "a"): "3", ("3", "u"): "2"}.get((state, c))

    step = {"0": "2", "1": "2", "2": "3", "3": "2"}
    name = {"2": "user", "3": "assistant"}

    # forward: best (cost, audit, lines) of every state after i rows
    def closed(best):
        for _ in range(3):
            for q in list(best):
                c, a, lines = best[q]
                new = (c + 3, a + "I", (*lines, name[step[q]] + ":"))
                if step[q] not in best or new[:2] < best[step[q]][:2]:
                    best[step[q]] = new
        return best

    best = closed({"0": (0, "", ())})
    for (_, role, text), f in zip(rows, fault):
        nxt = {}
        for q, (c, a, lines) in best.items():
            moves = [(q, c + 4, "D", ())]
            if f not in ("blank", "duplicate"):
                cut = 3 * (f == "truncated")
                if keep(q, role[:1]):
                    moves.append((keep(q, role[:1]), c + cut, "K", (f"{role}:{text}",)))
                moves.append((step[q], c + 3 + cut, "R", (f"{name[step[q]]}:{text}",)))
            for to, cost, letter, line in moves:
                new = (cost, a + letter, lines + line)
                if to not in nxt or new[:2] < nxt[to][:2]:
                    nxt[to] = new
        best = closed(nxt)
    cost, audit, lines = min((best[q] for q in ("0", "3") if q in best), key=lambda b: b[:2])
    return (gaps, *[fault.count(k) for k in ("blank", "duplicate", "truncated")], illegal, cost, audit,
            sha256("\n".join(lines).encode()).hexdigest())


def expected(rows, damaged=True):
    convs = {}
    for r in rows:
        convs.setdefault(r[0], []).append(r)
    out = []
    for c, mine in convs.items():
        mine = damage(mine) if damaged else [(t, " " if r is None else r, " " if x is None else x) for _, t, r, x in mine]
        out.append((c, *repair(mine)))
    return sorted(map(repr, out))


def result(df):
    return sorted(repr(tuple(r)) for r in df.select(
        "conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256").collect())


def chat(rng, n):
    texts = ["Yes.", "No!", "Why?", "cut off", " ", "", "Ends here.  \n", "ünï ☃.", *[f"Text {i}." for i in range(n)]]
    roles = ["user", "assistant", "user", "assistant", "system", "tool", "", "s", "admin", "Üser"]
    return [(rng.choice(roles), rng.choice(texts)) for _ in range(n)]


@pytest.mark.parametrize("block", [1024, 3, 1])
def test_equals_plain_dp(spark, block):
    rng = random.Random(block)
    rows = [(c, t, *x) for c in range(150) for t, x in enumerate(chat(rng, rng.randrange(1, 14)))]
    rows += [(1000, t, *x) for t, x in enumerate(chat(rng, 60))]
    rng.shuffle(rows)
    convs = spark.createDataFrame(rows, SCHEMA)
    assert result(cv.repair(convs, cv.damaged(convs), block)) == expected(rows)


def test_one_conversation_holds_most_rows(spark):
    rng = random.Random(5)
    rows = [(7, t, *x) for t, x in enumerate(chat(rng, 900))] + [(c, 0, "user", "Hi.") for c in range(8, 40)]
    convs = spark.createDataFrame(rows, SCHEMA).repartition(5)
    assert result(cv.repair(convs, block=32)) == expected(rows, damaged=False)


def test_odd_rows(spark):
    rows = [(None, None, None, None), (None, 1, "user", "Q?"), (None, 2, "assistant", "A."), (1, None, "user", "x."),
            (1, None, "assistant", "y."), (1, 5, "user", "z."), (1, 5, "user", "z."), (1, 5, "assistant", "w."),
            (2, -4, "user", "long " * 9000 + "."), (2, 9, "assistant", ". " * 5), (3, 1, None, "no role."),
            (4, 0, "system", "only."), (5, 0, "", "")]
    convs = spark.createDataFrame([(*r, 1, "b", "c") for r in rows], SCHEMA + ", block int, letters string, _c string")
    assert result(cv.repair(convs, cv.damaged(convs), 2)) == expected(rows)
    assert result(cv.repair(convs)) == expected(rows, damaged=False)
    empty = convs.where("false")
    assert cv.report(empty).collect() == [] and cv.report(empty).columns == cv.report(convs).columns


def test_conversation_that_lost_all_rows(spark):
    lost = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    convs = spark.createDataFrame([(lost, 0, "user", "Gone.")], SCHEMA)
    assert result(cv.report(convs)) == [repr((lost, 0, 0, 0, 0, 0, 0, "", sha256().hexdigest()))]


def test_pieces_of_long_text(spark, monkeypatch):
    monkeypatch.setattr(cv, "PIECE", 20)
    rows = [(1, t, ("user", "assistant")[t % 2], f"Turn number {t}, of some length.") for t in range(40)]
    parts = [r for batch in cv._repaired(iter([cv.pa.RecordBatch.from_pylist([
        {"_c": ":1", "block": b, "pos": p, "role": r, "text": x, "letters": a, "entry": 0 if b == 0 else 3, "alone": False}
        for b in (0, 1) for p, r, x, a in [(-1, None, None, "K" * 20),
                                           *[(t, rows[t][2], rows[t][3], None) for t in range(b * 20, b * 20 + 20)]]])]))
        for r in batch.to_pylist()]
    assert len(parts) > 10
    text = "".join(p["text"] for p in parts)
    assert text[1:] == "\n".join(f"{r}:{x}" for _, _, r, x in rows)


def test_ranks_order_nodes_by_their_audits():
    """Prefix doubling ranks every node by its whole least audit."""
    rng = random.Random(3)
    codes = [bytes(rng.choice([0, 1, 2, 3, 5, 9, 17]) for _ in range(n)) for n in (1, 4, 30)]
    part = cv.Slice(codes)
    ends = np.array([cv.AT_END] * 3)[:, :, None]
    best, target = part.arcs(part.costs(ends)[:, :, 0])
    letter, pointers, steps = cv.ranked_paths(best, target)
    for node in range(len(best)):
        at, audit = node, ""
        while best[at].any():
            k = best[at].argmax()
            audit, at = audit + "DIKR"[k], target[at, k]
        path, lens = cv._walk(np.array([node]), pointers, steps)
        assert "".join(" DIKR"[x] for x in letter[path]) == audit and lens[0] == len(audit)
        assert pointers[-1][node] == at
