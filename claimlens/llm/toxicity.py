"""Toxicity by multiple-instance learning (operator 2).

A document is a bag of sentences. A sentence's probability of being toxic is
logistic in its hashed features (words and their first four and five letters);
the document's is the noisy-or of its sentences, 1 - prod(1 - p). Only document labels are known:
the gradient of the document's log-likelihood is shared out among the
sentences by the noisy-or. Only features that documents labelled 1 hold
significantly more often (``G_LEAST``) get a weight, so that the many rare
words of a small training set are not learned by heart. The fitted sentence
model then locates the offending sentences.

Labels, language, source and id are never inputs of a score. Training reads
labelled rows outside the held-out quarter only, at most ``CLASS_DOCS`` of
each label (by id hash; weights restore the shares of the labels).
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from claimlens.llm.common import arrow_map, lists

CLASS_DOCS = 3_000
DIMS = 1 << 18
PREDICT_FROM, OFFENDING_FROM = 0.3, 0.5
#: Least G statistic (likelihood ratio, one degree of freedom) of a feature.
G_LEAST = 15.0
HELD_OUT = 2
_SENTENCE = re.compile(r"[.!?\n]+")
_MARKS = ".,;:!?\"'()[]*%&$#|"


def held_out(id_col: Column) -> Column:
    """crc32 of the id as text, mod 4, is 2."""
    return F.crc32(id_col.cast("string").cast("binary")) % 4 == HELD_OUT


class Features(dict):
    """Word -> its three hashed features; cleared at ``limit`` words."""

    def __init__(self, limit: int = 500_000):
        super().__init__()
        self.limit = limit

    def __missing__(self, word: str) -> tuple[int, int, int]:
        if len(self) >= self.limit:
            self.clear()
        core = word.strip(_MARKS).lower()
        self[word] = tuple(xxhash.xxh32_intdigest(part.encode("utf-8", "surrogatepass"), seed) % DIMS
                           for seed, part in enumerate((core, core[:4], core[:5])))
        return self[word]


def sentences(text: str | None) -> list[tuple[int, int]]:
    """(start, end) of every sentence that holds a word."""
    text = text or ""
    out, at = [], 0
    for m in _SENTENCE.finditer(text):
        out.append((at, m.end()))
        at = m.end()
    out.append((at, len(text)))
    return [(a, b) for a, b in out if text[a:b].strip(" \t\r\n.!?")]


def bags(texts: list[str | None], words: Features) -> tuple[np.ndarray, list[int], list[int]]:
    """(features, features of each sentence, sentences of each text)."""
    flat, per_sentence, per_text = [], [], []
    for text in texts:
        n = 0
        for sentence in _SENTENCE.split(text or ""):
            tokens = sentence.split()
            if tokens:
                for w in tokens:
                    flat.append(words[w])
                per_sentence.append(3 * len(tokens))
                n += 1
        per_text.append(n)
    return np.array(flat, np.int32).reshape(-1), per_sentence, per_text


def _starts(lengths) -> np.ndarray:
    return np.concatenate(([0], np.cumsum(lengths)))[:-1].astype(np.int64)


def sentence_logits(weights: np.ndarray, flat: np.ndarray, per_sentence) -> np.ndarray:
    if len(per_sentence) == 0:
        return np.zeros(0)
    return np.add.reduceat(weights[flat], _starts(per_sentence)) + weights[-1]


def noisy_or(z: np.ndarray, per_text) -> tuple[np.ndarray, np.ndarray]:
    """(document of each sentence, -log(1 - p) of each document)."""
    doc = np.repeat(np.arange(len(per_text)), per_text)
    return doc, np.bincount(doc, np.logaddexp(0, z), len(per_text))


def telling(col: np.ndarray, doc: np.ndarray, y: np.ndarray, size: int) -> np.ndarray:
    """Features whose document frequency is significantly higher in label 1."""
    seen = np.unique(col.astype(np.int64) * len(y) + doc)
    f, d = seen // len(y), seen % len(y)
    a = np.bincount(f, y[d] == 1, size)              # documents with the feature, label 1
    b = np.bincount(f, y[d] == 0, size)
    n1, n0 = (y == 1).sum(), (y == 0).sum()

    def part(o, e):
        return np.where(o > 0, o * np.log(np.maximum(o, 1e-9) / np.maximum(e, 1e-9)), 0.0)

    p = (a + b) / (n1 + n0)
    g = 2 * (part(a, n1 * p) + part(b, n0 * p) + part(n1 - a, n1 * (1 - p)) + part(n0 - b, n0 * (1 - p)))
    return (g >= G_LEAST) & (a * n0 > b * n1)


def fit_mil(flat: np.ndarray, per_sentence: np.ndarray, per_text: np.ndarray, y: np.ndarray,
            weight: np.ndarray, steps: int = 300, rate: float = 0.1, l2: float = 1e-4) -> np.ndarray:
    """Weights (DIMS + 1, bias last) by full-batch Adam on the noisy-or
    likelihood, over the telling features only."""
    n, n_sent = len(y), len(per_sentence)
    doc = np.repeat(np.arange(n), per_text)
    sentence = np.repeat(np.arange(n_sent), per_sentence)
    use = telling(flat, doc[sentence], y, DIMS)
    used = np.flatnonzero(use)
    hit = use[flat]
    col, sentence = np.searchsorted(used, flat[hit]), sentence[hit]
    k = len(used)
    w, bias = np.zeros(k), -4.0
    m, v = np.zeros(k + 1), np.zeros(k + 1)
    share = weight / weight.sum()
    for t in range(1, steps + 1):
        z = np.bincount(sentence, w[col], n_sent) + bias
        s = np.bincount(doc, np.logaddexp(0, z), n)           # -log(1 - P)
        # d loss / d s: share for label 0, -share * (1 - P) / P for label 1
        ds = np.where(y == 1, -share / np.expm1(np.clip(s, 1e-9, 50)), share)
        dz = ds[doc] / (1 + np.exp(-np.clip(z, -60, 60)))
        g = np.append(np.bincount(col, dz[sentence], k) + l2 * w, dz.sum())
        m, v = 0.9 * m + 0.1 * g, 0.999 * v + 0.001 * g * g
        step = rate * (m / (1 - 0.9 ** t)) / (np.sqrt(v / (1 - 0.999 ** t)) + 1e-8)
        w, bias = w - step[:-1], bias - step[-1]
    out = np.zeros(DIMS + 1)
    out[used], out[-1] = w, bias
    return out


def _bags_fn(text_col: str):
    words = Features()

    def run(cols: dict) -> dict:
        flat, per_sentence, per_text = bags(cols[text_col].to_pylist(), words)
        size = np.add.reduceat(np.append(per_sentence, 0), _starts(per_text)) * (np.array(per_text) > 0) \
            if len(per_text) else []
        return {"label": cols["label"], "flat": lists(flat, size, pa.int32()),
                "sentences": lists(np.array(per_sentence, np.int32), per_text, pa.int32())}
    return run


class ToxicityModel:
    """Fitted sentence weights."""

    def __init__(self, weights: np.ndarray):
        self.weights = weights

    def assess(self, text: Column, at_least: float = OFFENDING_FROM) -> Column:
        """struct<score, n_offending>: the probability that a document is toxic
        (0 for a text without words), and how many of its sentences have a
        probability of their own of at least ``at_least``."""
        weights, cut = self.weights, np.log(at_least / (1 - at_least))

        @F.pandas_udf("score double, n_offending bigint")
        def run(it: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
            words = Features()
            for s in it:
                texts, out = list(s), [(np.zeros(0), np.zeros(0))]
                for i in range(0, len(texts), 500):
                    flat, per_sentence, per_text = bags(texts[i:i + 500], words)
                    z = sentence_logits(weights, flat, per_sentence)
                    doc, none = noisy_or(z, per_text)
                    out.append((-np.expm1(-none), np.bincount(doc, z >= cut, len(per_text))))
                yield pd.DataFrame({"score": np.concatenate([a for a, _ in out]).astype(float),
                                    "n_offending": np.concatenate([b for _, b in out]).astype(np.int64)})
        return run(text)

    def offending(self, text: Column, at_least: float = OFFENDING_FROM) -> Column:
        """array<struct<start, end, score>>: the sentences whose own
        probability is at least ``at_least``, with their code point spans."""
        weights = self.weights

        @F.pandas_udf("array<struct<start: bigint, end: bigint, score: double>>")
        def run(it: Iterator[pd.Series]) -> Iterator[pd.Series]:
            words = Features()
            for s in it:
                out = []
                for t in s:
                    spans = sentences(t)
                    flat, per_sentence, _ = bags([t[a:b] for a, b in spans], words)
                    p = 1 / (1 + np.exp(-np.clip(sentence_logits(weights, flat, per_sentence), -60, 60)))
                    out.append([{"start": a, "end": b, "score": float(x)}
                                for (a, b), x in zip(spans, p, strict=True) if x >= at_least])
                yield pd.Series(out, dtype=object)
        return run(text)


def fit_toxicity(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                 label_col: str = "toxic", class_docs: int = CLASS_DOCS) -> ToxicityModel:
    """Train on labelled documents outside the held-out quarter.

    Rows without id, text words or label are not trained on; repeated rows
    count as often as they occur. Without examples of both labels every text
    with words scores almost 0.
    """
    known = labels.select(F.col(id_col).alias("i"), F.col(label_col).cast("int").alias("label")) \
        .where("label is not null and i is not null").distinct()
    known = known.where(~held_out(F.col("i")))
    n = {r["label"]: r["n"] for r in known.groupBy("label").agg(F.count(F.lit(1)).alias("n")).collect()}
    none = np.zeros(DIMS + 1)
    none[-1] = -12.0
    if not n.get(0) or not n.get(1):
        return ToxicityModel(none)
    part = F.pmod(F.xxhash64(F.col("i").cast("string"), F.lit("toxicity")), F.lit(1 << 20))
    cut = F.when(F.col("label") == 1, min(1.0, class_docs / n[1])).otherwise(min(1.0, class_docs / n[0]))
    taken = known.where(part < cut * (1 << 20))
    # at most about 2 x class_docs ids: bounded by the parameter
    sample = docs.select(F.col(id_col).alias("i"), text_col).join(F.broadcast(taken), "i")
    got = arrow_map(sample.select("label", text_col), _bags_fn(text_col),
                    "label int, flat array<int>, sentences array<int>").toArrow()
    got = got.filter(pa.compute.greater(pa.compute.list_value_length(got["sentences"]), 0))
    y = got["label"].to_numpy()
    if not (y == 1).any() or not (y == 0).any():
        return ToxicityModel(none)
    flat, sent = got["flat"].combine_chunks(), got["sentences"].combine_chunks()
    weight = np.where(y == 1, n[1] / (y == 1).sum(), n[0] / (y == 0).sum())
    return ToxicityModel(fit_mil(flat.flatten().to_numpy(), sent.flatten().to_numpy(),
                                 np.diff(sent.offsets.to_numpy()), y, weight))


def score_documents(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text",
                    label_col: str = "toxic") -> DataFrame:
    """``id_col``, held_out, score, n_offending (sentences located by the fitted
    sentence model), predicted for every row.

    A null or wordless text scores 0. Ids may repeat or be null (held_out is
    null then). Further columns are not read; an empty table gives no rows.
    """
    model = fit_toxicity(docs, labels, id_col, text_col, label_col)
    text = F.coalesce(F.col(text_col), F.lit(""))
    return docs.select(F.col(id_col), held_out(F.col(id_col)).alias("held_out"),
                       model.assess(text).alias("a")) \
        .select(id_col, "held_out", "a.score", "a.n_offending") \
        .withColumn("predicted", (F.col("score") >= PREDICT_FROM).cast("int"))
