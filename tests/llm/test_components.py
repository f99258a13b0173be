"""Connected components against union-find."""
import random

from claimlens.llm.components import connected_components


def brute(edges):
    parent = {}

    def find(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = sorted((find(a), find(b)))
            parent[y] = x
    return {x: find(x) for x in parent}


def test_components(spark):
    rng = random.Random(4)
    chain = [(k, k + 1) for k in range(1000, 1040)]
    star = [(7, k) for k in range(2000, 2060)]
    noise = [(rng.randrange(150), rng.randrange(150)) for _ in range(70)]
    edges = chain + star + noise + noise[:5] + [(None, 3), (4, None), (5, 5)]
    rng.shuffle(edges)
    df = spark.createDataFrame(edges, "a bigint, b bigint")
    assert {r.node: r.component for r in connected_components(df).collect()} == brute(edges)
    assert connected_components(df.where("false")).collect() == []
