"""Quality classifier from weak labels (operator 9).

1. *Labellers.* Ten overlapping heuristics vote good, bad or abstain on every
   whole text (symbols, capitals, bare delimiters, repetition, function
   words, sentence ends, word length, ...).
2. *Label model.* Expectation-maximisation over the counts of vote patterns
   estimates each labeller's accuracy in both classes (votes independent
   given the class) and the share of bad texts; no true label is read. There
   are at most 3^10 patterns, whatever the number of documents.
3. *Scorer.* The posterior labels of a bounded sample (about ``SAMPLE_ROWS``
   rows by hash of id and text, at most twice as many) train a logistic scorer linear in hashed features (word shapes,
   pairs of shapes, repeated neighbours), which scores every document.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import chain
from typing import TYPE_CHECKING

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import SLICE_ROWS, arrow_map, freed, lists

if TYPE_CHECKING:       # only the driver's report needs it: the workers don't load it
    import pandas as pd

#: Documents whose posterior labels train the scorer (all others are scored only).
SAMPLE_ROWS = 8_000
DIMS = 1 << 13
#: Characters of a word that make one feature.
PIECE = 64
KEEP_FROM = 0.5
#: Characters whose words a task holds at once.
SLICE_CHARS = 1 << 18
#: Prior of each class of the label model, in documents.
PRIOR_VOTES = 20
#: A labeller that alone calls more than this share of the texts bad misfires.
LONE_SHARE = 0.08
#: A labeller that calls less than this share of the texts bad gets no class.
RARE_SHARE = 0.003

# Frequent function words of the four languages.
FUNCTION_WORDS = frozenset((
    "the of and to in is that it for was as with be by on are this from at or an "
    "der die das und in zu den ist von mit sich des auf für nicht ein eine als auch dem "
    "le la les de des et un une du en est que qui dans pour pas sur au par avec "
    "el los las y del se con una por su para al lo como más o a").split())

LABELLERS = ("symbols", "capitals", "delimiters", "repeats", "top_word", "function_words",
             "sentence_ends", "word_length", "length", "lines")
GOOD, BAD, ABSTAIN = "1", "0", "-"
_PLAIN = set(".,;:!?'\"()-–—«»„“”’/")


class _Classes(dict):
    """Code point -> mark, for ``str.translate``; each is worked out once."""

    def __init__(self, mark):
        super().__init__()
        self.mark = mark

    def __missing__(self, code: int) -> str:
        self[code] = mark = self.mark(chr(code))
        return mark


_CASE = _Classes(lambda c: "X" if c.isupper() else "x" if c.isalpha() else "0" if c.isdigit() else c)
_KIND = _Classes(lambda c: "a" if c.isalnum() else "." if c in _PLAIN else "#")
_RUNS = re.compile(r"(.)\1{2,}", re.DOTALL)


def _shape(word: str) -> str:
    """Letters by case, digits as 0, runs of one mark cut to two."""
    return _RUNS.sub(r"\1\1", word.translate(_CASE))


@lru_cache(maxsize=1 << 14)
def _shape_id(shape: str) -> int:
    return xxhash.xxh64_intdigest(shape.encode("utf-8", "surrogatepass")) & 0x7FFFFFFF


_SMALL = {1: _shape_id("x")}
_SMALL_LONG = _shape_id("xx")


class Words(dict):
    """Word -> its attributes in one number: five flags (symbols, capitals, bare,
    function word, sentence end), 27 bits of length, 31 of the shape's id; cleared
    at ``limit`` words."""

    def __init__(self, limit: int = 200_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: str) -> int:
        if word.isascii() and word.isalpha() and word.islower():    # most words
            flags = 8 if word in FUNCTION_WORDS else 0
            shape = _SMALL.get(len(word), _SMALL_LONG)
        else:
            kinds = word.translate(_KIND)
            alnum = kinds.count("a")
            flags = (("#" in kinds and alnum > 0) + 2 * (alnum > 1 and word.isupper()) + 4 * (alnum == 0)
                     + 8 * (word.strip(".,;:!?'\"()").lower() in FUNCTION_WORDS) + 16 * (word[-1] in ".!?"))
            shape = _shape_id(_shape(word[:PIECE]))
        self[word] = code = flags | min(len(word), (1 << 27) - 1) << 5 | shape << 32
        return code

    def codes(self, words: list[str]) -> np.ndarray:
        if len(self) > self.limit:
            self.clear()
        return np.fromiter(map(self.__getitem__, words), np.int64, len(words))

    def rows_of(self, words: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the words, attributes: one line a word)."""
        code = self.codes(words)
        flags = [code >> k & 1 for k in range(5)]
        return _ids(words), np.stack([*flags, code >> 5 & 0x7FFFFFF, code >> 32], 1)


def _ids(words: list[str]) -> np.ndarray:
    """Numbers that tell the words of a process apart (64-bit hashes)."""
    return np.fromiter(map(hash, words), np.int64, len(words))


def _vote(value: float, bad: bool, good: bool) -> str:
    return BAD if bad else GOOD if good else ABSTAIN


def votes(text: str | None, words: Words) -> str:
    """One character a labeller, in the order of ``LABELLERS``."""
    tokens = (text or "").split()
    n = len(tokens)
    if n == 0:
        return ABSTAIN * 8 + BAD + ABSTAIN
    at, a = words.rows_of(tokens)
    symbols, capitals, bare, function, ends, _, _ = a.mean(axis=0)
    length = a[:, 5].sum() / n
    again = (at[1:] == at[:-1]).mean() if n > 1 else 0.0
    top = np.unique(at, return_counts=True)[1].max() / n
    lines = [x for x in text.split("\n") if x.strip()]
    line_again = 1 - len(set(lines)) / len(lines)
    rules = (
        (symbols > 0.2, symbols < 0.05),
        (capitals > 0.3 and n >= 5, capitals < 0.1),
        (bare > 0.2, bare < 0.05),
        (again > 0.2, again < 0.05),
        (n >= 20 and top > 0.5, n >= 20 and top < 0.15),
        (n >= 20 and function < 0.05, n >= 20 and function > 0.12),
        (n >= 40 and ends < 0.01, ends > 0.03),
        (length > 15 or length < 2.2, 3 <= length <= 9),
        (False, n >= 5),
        (len(lines) >= 5 and line_again > 0.4, len(lines) >= 2 and line_again < 0.1))
    return "".join(_vote(0, bad, good) for bad, good in rules)


class Bag:
    """The words of several texts side by side: word ids ``at``, attributes ``code``,
    words of each text ``n`` (texts without words left out) and their starts."""

    def __init__(self, texts: list[str | None], words: Words, piece: int | None = None):
        split = [(t or "").split() for t in texts]
        flat = list(chain.from_iterable(split))
        n = np.fromiter(map(len, split), np.int64, len(split))
        if piece and flat and max(map(len, flat)) > piece:
            flat = [w[i:i + piece] for w in flat for i in range(0, len(w), piece)]
            n = np.fromiter((sum(-(-len(w) // piece) for w in t) for t in split), np.int64, len(split))
        self.texts = np.flatnonzero(n)
        self.n = n[self.texts]
        self.starts = np.cumsum(self.n) - self.n
        self.at, self.code = _ids(flat), words.codes(flat)
        # neighbours of one text
        self.inner = np.ones(max(0, len(flat) - 1), bool)
        self.inner[self.starts[1:] - 1] = False
        self.same = self.at[1:] == self.at[:-1]

    def pair_sums(self, values: np.ndarray) -> np.ndarray:
        """Sums over each text's neighbouring words of ``values`` (one a pair)."""
        return np.add.reduceat(np.append(np.where(self.inner, values, 0), 0), self.starts)

    def top_counts(self) -> np.ndarray:
        """Occurrences of each text's most frequent word."""
        of = np.repeat(np.arange(len(self.n)), self.n)
        order = np.lexsort((self.at, of))
        at, of = self.at[order], of[order]
        first = np.flatnonzero(np.append(True, (at[1:] != at[:-1]) | (of[1:] != of[:-1])))
        runs = np.diff(np.append(first, len(at)))
        return np.maximum.reduceat(runs, np.searchsorted(first, self.starts))

    def means(self) -> list[np.ndarray]:
        """Each text's share of words with each flag, and mean word length."""
        columns = [*(self.code >> k & 1 for k in range(5)), self.code >> 5 & 0x7FFFFFF]
        return [np.add.reduceat(c, self.starts) / self.n for c in columns]


def votes_of(texts: list[str | None], words: Words) -> list[str]:
    """``votes`` of several texts, computed together."""
    out = [ABSTAIN * 8 + BAD + ABSTAIN] * len(texts)
    bag = Bag(texts, words)
    if len(bag.n) == 0:
        return out
    n = bag.n
    symbols, capitals, bare, function, ends, length = bag.means()
    again = bag.pair_sums(bag.same) / np.maximum(1, n - 1)
    top = bag.top_counts() / n
    lines = [[x for x in texts[i].split("\n") if x.strip()] for i in bag.texts]
    n_lines = np.fromiter(map(len, lines), np.int64, len(lines))
    line_again = 1 - np.fromiter((len(set(x)) for x in lines), np.int64, len(lines)) / n_lines
    never = np.zeros(len(n), bool)
    rules = (
        (symbols > 0.2, symbols < 0.05),
        ((capitals > 0.3) & (n >= 5), capitals < 0.1),
        (bare > 0.2, bare < 0.05),
        (again > 0.2, again < 0.05),
        ((n >= 20) & (top > 0.5), (n >= 20) & (top < 0.15)),
        ((n >= 20) & (function < 0.05), (n >= 20) & (function > 0.12)),
        ((n >= 40) & (ends < 0.01), ends > 0.03),
        ((length > 15) | (length < 2.2), (3 <= length) & (length <= 9)),
        (never, n >= 5),
        ((n_lines >= 5) & (line_again > 0.4), (n_lines >= 2) & (line_again < 0.1)))
    marks = np.stack([np.where(bad, BAD, np.where(good, GOOD, ABSTAIN)) for bad, good in rules], 1)
    for i, row in zip(bag.texts.tolist(), marks.tolist()):
        out[i] = "".join(row)
    return out


def scores_of(texts: list[str | None], words: Words, weights: np.ndarray) -> np.ndarray:
    """Scores of several texts: the mean weight of their ``features``."""
    out = np.zeros(len(texts))
    bag = Bag(texts, words, PIECE)
    if len(bag.n) == 0:
        return out
    shape = bag.code >> 32
    pair = (shape[1:] * 31 + shape[:-1] * 17 + 7) % 2147483647
    total = np.add.reduceat(weights[shape % DIMS], bag.starts) \
        + bag.pair_sums(weights[pair % DIMS] + np.where(bag.same, weights[1], weights[2]))
    mean = total / (3 * bag.n - 2)
    out[bag.texts] = 1 / (1 + np.exp(-np.clip(mean + weights[-1], -60, 60)))
    return out


def label_model(counts: dict[str, int], rounds: int = 200) -> tuple[dict[str, float], pd.DataFrame]:
    """EM over {vote pattern: documents}. Returns the posterior of class good
    for each pattern, and each labeller's rates and accuracy.

    Good texts are one class, bad texts several, one a labeller, so that the
    commonest kind of junk does not make the rarer kinds good. Class k starts
    with the texts labeller k calls bad. All rates are set by the data; the
    prior of a class weighs a few documents, whatever the corpus size.

    Votes cannot tell junk that only one labeller sees from its misfires. If
    more than ``LONE_SHARE`` of the texts are called bad by labeller k alone,
    they start as good and k has no class; its rate among good texts follows.
    So do those of a labeller that calls less than ``RARE_SHARE`` bad.
    """
    import pandas as pd
    names = sorted(counts)
    if not names:
        return {}, pd.DataFrame(columns=["labeller", "bad_if_bad", "bad_if_good", "accuracy"])
    n = np.array([counts[p] for p in names], float)
    v = np.array([[c for c in p] for p in names])
    bad_vote, good_vote = v == BAD, v == GOOD
    cast = bad_vote | good_vote
    alone = bad_vote & (bad_vote.sum(1) == 1)[:, None]
    trusted = (n @ alone <= LONE_SHARE * n.sum()) & (n @ bad_vote >= RARE_SHARE * n.sum())
    if not trusted.any():
        trusted[:] = True
    said = bad_vote & (trusted | ~alone)
    any_bad = said.any(axis=1)
    shares = np.where(any_bad[:, None], said / np.maximum(1, said.sum(1))[:, None], 1 / len(LABELLERS))
    shares = shares[:, trusted] + 1e-9
    start = np.where(any_bad, 0.9, 0.02)[:, None]
    of = np.hstack([1 - start, start * shares / shares.sum(1, keepdims=True)])
    # a class's own labeller nearly always says bad, any other one rarely
    usual = np.vstack([np.full(len(LABELLERS), 0.001), np.where(np.eye(len(LABELLERS)), 0.9, 0.001)[trusted]])
    for _ in range(rounds):
        w = n[:, None] * of
        bad_votes, all_votes = w.T @ bad_vote, w.T @ cast
        # share of bad votes among votes, by class
        rate = (bad_votes + PRIOR_VOTES * usual) / (all_votes + PRIOR_VOTES)
        log = np.log((w.sum(0) + 1) / (n.sum() + w.shape[1])) \
            + bad_vote @ np.log(rate).T + good_vote @ np.log1p(-rate).T
        new = np.exp(log - log.max(axis=1, keepdims=True))
        new /= new.sum(axis=1, keepdims=True)
        if np.abs(new - of).max() < 1e-9:
            break
        of = new
    p_bad = 1 - of[:, 0]
    tg, prior = rate[0], (n @ p_bad + 1) / (n.sum() + 5)
    tb = (bad_votes[1:].sum(0) + 1.0) / (all_votes[1:].sum(0) + 4.0)
    accuracy = prior * tb + (1 - prior) * (1 - tg)
    report = pd.DataFrame({"labeller": LABELLERS, "bad_if_bad": tb, "bad_if_good": tg,
                           "accuracy": accuracy})
    return dict(zip(names, 1 - p_bad, strict=True)), report


def features(text: str | None, words: Words) -> np.ndarray:
    """Hashed feature of every position: shape, pair of shapes, repeat. A
    longer word counts as its consecutive pieces of ``PIECE`` characters."""
    tokens = (text or "").split()
    if not tokens:
        return np.zeros(0, np.int64)
    at, a = words.rows_of(tokens)
    if a[:, 5].max() > PIECE:
        at, a = words.rows_of([t[i:i + PIECE] for t in tokens for i in range(0, len(t), PIECE)])
    shape = a[:, 6].astype(np.int64)
    pair = (shape[1:] * 31 + shape[:-1] * 17 + 7) % 2147483647
    same = np.where(at[1:] == at[:-1], 1, 2)
    return np.concatenate([shape % DIMS, pair % DIMS, same])


def _slices(column: pa.Array) -> Iterator[list[str | None]]:
    """The texts of a batch as Python strings, about ``SLICE_CHARS`` at a time."""
    held, size = [], 0
    for i in range(0, len(column), SLICE_ROWS):
        for text in column.slice(i, SLICE_ROWS).to_pylist():
            held.append(text)
            size += len(text or "")
            if size > SLICE_CHARS:
                yield held
                held, size = [], 0
    if held:
        yield held


def _votes_udf():
    @F.arrow_udf("string")
    def run(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
        words = Words()
        for s in it:
            yield pa.array([v for part in _slices(s) for v in votes_of(part, words)], pa.string())
        s = words = None
        freed()
    return run


def _sample_fn(text_col: str, key: str):
    words = Words()

    def run(cols: dict) -> dict:
        idx, val, size, pattern = [], [], [], []
        for text in cols[text_col].to_pylist():
            f = features(text, words)
            i, c = np.unique(f, return_counts=True)
            idx.append(i)
            val.append(c / max(1, len(f)))
            size.append(len(i))
            pattern.append(votes(text, words))
        return {key: cols[key], "pattern": pattern,
                "idx": lists(np.concatenate(idx).astype(np.int32), size, pa.int32()),
                "val": lists(np.concatenate(val), size, pa.float64())}
    return run


def fit_logistic(idx: np.ndarray, val: np.ndarray, row: np.ndarray, y: np.ndarray, dims: int,
                 steps: int = 300, rate: float = 0.3, l2: float = 1e-6) -> np.ndarray:
    """Weights (dims + 1, bias last) of a logistic model on soft labels ``y``;
    entries (row, idx, val), full-batch Adam."""
    w, n = np.zeros(dims + 1), max(1, len(y))
    m, s = np.zeros(dims + 1), np.zeros(dims + 1)
    for k in range(1, steps + 1):
        z = np.bincount(row, w[idx] * val, n) + w[-1]
        d = (1 / (1 + np.exp(-np.clip(z, -60, 60))) - y) / n
        g = np.append(np.bincount(idx, val * d[row], dims), d.sum()) + l2 * w
        m, s = 0.9 * m + 0.1 * g, 0.999 * s + 0.001 * g * g
        w -= rate * (m / (1 - 0.9 ** k)) / (np.sqrt(s / (1 - 0.999 ** k)) + 1e-9)
    return w


class QualityModel:
    """Fitted weights plus the label model's report."""

    def __init__(self, weights: np.ndarray, report: pd.DataFrame):
        self.weights, self.report = weights, report

    def score(self, text: str | Column) -> Column:
        """Probability that a text is good; 0 for a text without words."""
        w = self.weights

        @F.arrow_udf("double")
        def run(it: Iterator[pa.Array]) -> Iterator[pa.Array]:
            words = Words()
            for s in it:
                parts = [scores_of(part, words, w) for part in _slices(s)]
                yield pa.array(np.concatenate(parts) if parts else [], pa.float64())
            s = parts = words = None
            freed()
        return run(F.col(text) if isinstance(text, str) else text)


def fit_quality(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                sample_rows: int = SAMPLE_ROWS) -> QualityModel:
    """Label model over all texts, then the scorer on its posterior labels.

    Rows may repeat ids or hold null ids or texts; an empty table gives a
    model that scores every text with words 0.5. Other columns are not read.
    """
    counts = {r["p"]: r["n"] for r in docs.select(_votes_udf()(F.col(text_col)).alias("p"))
              .groupBy("p").agg(F.count(F.lit(1)).alias("n")).collect()}
    posterior, report = label_model(counts)
    total = sum(counts.values())
    if total == 0:
        return QualityModel(np.zeros(DIMS + 1), report)
    # id and text: rows under one id, or none, are drawn apart; beyond twice
    # the size (copies of one row are drawn together) the smallest hashes stay
    part = F.xxhash64(F.col(id_col).cast("string"), F.col(text_col))
    take = docs.select(F.col(text_col).alias("t"), part.alias("h")) \
        .where(F.pmod("h", F.lit(1 << 40)) < (1 << 40) * min(1.0, sample_rows / total))
    got = arrow_map(take, _sample_fn("t", "h"), "h bigint, pattern string, idx array<int>, val array<double>") \
        .orderBy("h").limit(2 * sample_rows).toArrow()
    if got.num_rows == 0:
        return QualityModel(np.zeros(DIMS + 1), report)
    y = np.array([posterior[p] for p in got["pattern"].to_pylist()])
    idx = got["idx"].combine_chunks()
    row = np.repeat(np.arange(got.num_rows), np.diff(idx.offsets.to_numpy()))
    return QualityModel(fit_logistic(idx.flatten().to_numpy(), got["val"].combine_chunks().flatten()
                                     .to_numpy(), row, y, DIMS), report)
