"""Operator 5: exact round trip of ids, gapless sequences, little padding."""
import random
import zlib
from collections import Counter, defaultdict

import numpy as np
import public_tokenizers
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from claimlens.llm import packing as pk

PATH = public_tokenizers.path(pk.TOKENIZER)
LIBRARY = Tokenizer.from_file(PATH)


def ids_of(text):
    return LIBRARY.encode(text or "", add_special_tokens=False).ids + [1]


@settings(max_examples=300, deadline=None)
@given(st.lists(st.one_of(st.text(max_size=10), st.sampled_from(
    ["<|endoftext|>", "Word.", "don't!", "İ.", "ΣΑΣ", "É,", "\x1c", "ǅ", "  ", "᠎", "ﬁ", "ß", "12", "a|b", "%%%"])),
    max_size=10).map("".join))
def test_ids_equal_the_library(text):
    assert pk._words(PATH).of(text) == np.array(ids_of(text)[:-1], "<u4").tobytes()


@settings(max_examples=100, deadline=None)
@given(st.dictionaries(st.integers(1, 64), st.integers(1, 50), max_size=30))
def test_patterns_hold_every_piece_once(histogram):
    groups = pk.pack_histogram(histogram, 64)
    got = Counter()
    for packs, pattern in groups:
        assert 0 < sum(a * b for a, b in pattern) <= 64
        for length, copies in pattern:
            got[length] += packs * copies
    assert got == Counter(histogram)
    slots = pk.placements(groups, histogram)
    covered = Counter()
    for length, lo, hi, *_ in slots:
        covered[length] += hi - lo
    assert covered == got
    # first-fit guarantee: at most one pack is half empty or less
    assert sum(p for p, pattern in groups if 2 * sum(a * b for a, b in pattern) <= 64) <= 1


def check(rows, got, max_tokens):
    want = defaultdict(list)
    for i, t in rows:
        want[i].append(ids_of(t))
    sequences, pieces = defaultdict(list), defaultdict(list)
    for r in got:
        sequences[r.sequence_id].append((r.offset, r.length, r.padded_length))
        pieces[r.doc_id].append(r)
    for parts in sequences.values():
        at = 0
        for offset, length, _ in sorted(parts):
            assert offset == at
            at += length
        assert at <= max_tokens and {p for *_, p in parts} == {at if at & (at - 1) == 0 else max_tokens}
    for i, texts in want.items():
        found = Counter((r.start, r.length, r.ids_crc32, r.doc_tokens) for r in pieces[i])
        expect = Counter()
        for ids in texts:
            for s in range(0, len(ids), max_tokens):
                part = ids[s:s + max_tokens]
                expect[s, len(part), zlib.crc32(np.array(part, "<u4").tobytes()), len(ids)] += 1
        assert found == expect
    return len(sequences), sum(r.length for r in got)


def test_round_trip(docs_of):
    rng = random.Random(1)
    rows = [(i, " ".join(f"word{rng.randrange(900)}," for _ in range(rng.randrange(200)))) for i in range(150)]
    rows += [(500, None), (501, ""), (502, "same text here"), (502, "same text here"), (None, "no id"),
             (503, "long " * 5000)] + [(600 + k, "hot length") for k in range(300)]
    got = pk.packed(docs_of(rows)).collect()
    n, tokens = check(rows, got, 2048)
    assert n <= tokens / 2048 * 1.02 + 1
    small = pk.packed(docs_of(rows), max_tokens=64).collect()
    check(rows, small, 64)


def test_empty_table(docs_of):
    assert pk.packed(docs_of([])).collect() == []
