"""Components of random graphs, chains and hubs against union-find."""

import itertools
import random

import pytest

from cliploom.llm.graph import components


def union_find(edges):
    root = {n: n for e in edges for n in e}

    def find(n):
        while root[n] != n:
            root[n] = root[root[n]]
            n = root[n]
        return n

    for a, b in edges:
        x, y = find(a), find(b)
        root[max(x, y)] = min(x, y)
    return {n: find(n) for n in root}


RNG = random.Random(4)
GRAPHS = {
    "random": [(RNG.randrange(120), RNG.randrange(120)) for _ in range(90)],
    "chain": [(i, i + 1) for i in range(60)],
    "shuffled chain": list(itertools.pairwise(RNG.sample(range(60), 60))),
    "hub": [(500, i) for i in range(300)],
    "repeated": [(1, 2), (2, 1), (1, 2), (3, 4)],
}


@pytest.mark.parametrize("name", GRAPHS)
def test_components(spark, name):
    edges = GRAPHS[name]
    found = {r["node"]: r["component"] for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    expected = union_find([e for e in edges if e[0] != e[1]])
    assert found == expected


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0
