import os
import sys

import pytest

ROOT = os.path.dirname(os.path.dirname(os.path.dirname(os.path.abspath(__file__))))
for p in (ROOT,):
    if p not in sys.path:
        sys.path.insert(0, p)
    # Python workers import the package by path
    os.environ["PYTHONPATH"] = os.pathsep.join(dict.fromkeys([p, *filter(None, [os.environ.get("PYTHONPATH")])]))

DOCS = "doc_id bigint, text string, lang string, score string, key string, w string, id string, bucket int"


@pytest.fixture
def docs_of(spark):
    """Documents from (doc_id, text) pairs, with columns whose names clash
    with those the operators use inside."""
    def make(rows):
        return spark.createDataFrame([(i, t, "en", "s", "k", "w", "x", 1) for i, t in rows], DOCS)
    return make
