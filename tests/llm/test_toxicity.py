"""Operator 2: held-out accuracy, gradient, located sentences, odd rows."""
import random
import zlib

import numpy as np
from pyspark.sql import functions as F

from claimlens.llm import toxicity as tx

PLAIN = [f"word{i}" for i in range(400)]
NASTY = ["rotter", "blighter", "scoundrel"]


def make(seed, n):
    rng = random.Random(seed)
    docs, labels = [], []
    for i in range(n):
        toxic = int(rng.random() < 0.2)
        sentences = [" ".join(rng.choices(PLAIN, k=rng.randrange(3, 12))) for _ in range(rng.randrange(1, 8))]
        if toxic:
            k = rng.randrange(len(sentences))
            sentences[k] += " " + rng.choice(NASTY) + rng.choice(["s", "ish", ""])
        docs.append((i, ". ".join(sentences) + "."))
        labels.append((i, toxic))
    return docs, labels


def labels_of(spark, rows):
    return spark.createDataFrame([(i, 1, t, "x") for i, t in rows],
                                 "doc_id bigint, quality int, toxic int, text string")


def test_held_out_accuracy_and_columns(spark, docs_of):
    docs, labels = make(1, 900)
    got = tx.score_documents(docs_of(docs), labels_of(spark, labels)).collect()
    truth = dict(labels)
    assert len(got) == 900
    held = [r for r in got if r.held_out]
    assert all(r.held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2) for r in got)
    assert all(r.predicted == int(r.score >= 0.3) and 0 <= r.score <= 1 for r in got)
    assert np.mean([r.predicted == truth[r.doc_id] for r in held]) > 0.97


def test_held_out_labels_are_not_read(spark, docs_of):
    docs, labels = make(2, 300)
    flipped = [(i, 1 - t if zlib.crc32(str(i).encode()) % 4 == 2 else t) for i, t in labels]
    a = tx.score_documents(docs_of(docs), labels_of(spark, labels)).collect()
    b = tx.score_documents(docs_of(docs), labels_of(spark, flipped)).collect()
    assert {r.doc_id: r.score for r in a} == {r.doc_id: r.score for r in b}


def test_offending_sentences_are_located(spark, docs_of):
    docs, labels = make(3, 900)
    model = tx.fit_toxicity(docs_of(docs), labels_of(spark, labels))
    got = docs_of(docs).select("doc_id", "text", model.offending(F.col("text")).alias("o")).collect()
    truth = dict(labels)
    found = [r for r in got if truth[r.doc_id] and r.o]
    counted = docs_of(docs).select("doc_id", model.assess(F.col("text")).alias("a")).collect()
    assert {r.doc_id: r.a.n_offending for r in counted} == {r.doc_id: len(r.o) for r in got}
    assert len(found) > 0.95 * sum(truth.values())
    assert all(any(n in r.text[x.start:x.end] for n in NASTY) for r in found for x in r.o)


def test_noisy_or_equals_the_product():
    words = tx.Features()
    texts = ["a b. c d! e", "", None, "one. two"]
    w = np.zeros(tx.DIMS + 1)
    w[:] = np.random.default_rng(0).normal(size=len(w)) * 0.3
    flat, per_sentence, per_text = tx.bags(texts, words)
    z = tx.sentence_logits(w, flat, per_sentence)
    _, none = tx.noisy_or(z, per_text)
    at = 0
    for n, s in zip(per_text, none, strict=True):
        p = 1 / (1 + np.exp(-z[at:at + n]))
        assert abs((1 - np.prod(1 - p)) - (-np.expm1(-s))) < 1e-12
        at += n
    assert per_text == [3, 0, 0, 2]


def test_odd_rows(spark, docs_of):
    docs, labels = make(4, 80)
    docs = docs_of([*docs, (None, "text"), (501, None), (502, ""), (3, "again. again"), (503, "w " * 60_000)])
    rows = labels_of(spark, [*labels, (None, 1), (501, None), (502, 1), (503, 0), (3, 1)])
    got = tx.score_documents(docs, rows).collect()
    assert len(got) == 85 and all(r.score == 0 for r in got if r.doc_id in (501, 502))
    none = tx.score_documents(docs, rows.where("false")).collect()
    assert len(none) == 85 and all(r.score < 0.3 for r in none)
    assert tx.score_documents(docs.where("false"), rows).collect() == []
