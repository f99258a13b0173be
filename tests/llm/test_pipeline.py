"""The corpus pipeline and the registered queries."""
import random

import pytest

import corpus_pipeline
from claimlens.llm import queries

from .test_packing import check
from .test_quality import bad, good


@pytest.fixture
def sf_dir(spark, tmp_path):
    rng = random.Random(7)
    rows = [(i, good(rng, 60)) for i in range(120)]
    rows += [(200 + i, bad(rng, i % 4)) for i in range(24)]
    rows += [(300, rows[5][1]), (301, rows[6][1] + " extra"), (302, None), (303, "")]
    item = good(rng, 40)
    rows += [(310, good(rng, 30) + " " + item + " " + good(rng, 30))]
    rows += [(320, good(rng, 30) + ' token = "0123456789abcdef0123456789abcdef" ' + good(rng, 30))]
    docs = spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows],
                                 "doc_id bigint, text string, lang string, source string, n_chars int")
    docs.write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(1, item)], "item_id bigint, text string").write.parquet(f"{tmp_path}/benchmark.parquet")
    return str(tmp_path)


def test_stages_take_effect(spark, sf_dir):
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    columns, seen = docs.columns, {}
    for name, stage in corpus_pipeline.STAGES[:-1]:
        docs = stage(spark, docs, sf_dir).cache()
        assert docs.columns == columns
        seen[name] = {r.doc_id: r for r in docs.collect()}
    assert [n for n, _ in corpus_pipeline.STAGES] == ["quality", "dedup", "decontaminate", "secrets", "packing"]
    assert set(range(120)) <= set(seen["quality"]) and not set(range(200, 224)) & set(seen["quality"])
    assert not {302, 303} & set(seen["quality"])
    assert not {300, 301} & set(seen["dedup"]) and {5, 6} <= set(seen["dedup"])
    assert 310 in seen["dedup"] and 310 not in seen["decontaminate"]
    assert set(seen["secrets"]) == set(seen["decontaminate"])
    row = seen["secrets"][320]
    assert "[SECRET]" in row.text and "0123456789abcdef" not in row.text and row.n_chars == len(row.text)
    got = corpus_pipeline.run(spark, sf_dir).collect()
    check([(i, r.text) for i, r in seen["secrets"].items()], got, 2048)


def test_every_operator_is_registered():
    names = list(queries.QUERIES)
    assert all(any(n.startswith(f"op{k}_") for n in names) for k in range(1, 11)) and "pipeline" in names
    assert set(queries.ORACLE) <= set(names)
