"""Connected components against union-find."""

import random

from scorewatch.llm.graph import components


def test_random_graphs(spark):
    rnd = random.Random(4)
    names = [f"{rnd.getrandbits(64):016x}" for _ in range(300)]
    edges = [tuple(rnd.sample(names, 2)) for _ in range(220)] + [(names[i], names[i + 1]) for i in range(0, 60)] + [(names[5], names[5])]
    root = {}

    def find(x):
        while root.setdefault(x, x) != x:
            x = root[x]
        return x

    for a, b in edges:
        a, b = find(a), find(b)
        root[max(a, b)] = min(a, b)
    got = dict(components(spark.createDataFrame(edges, "a string, b string")).collect())
    assert got == {x: find(x) for e in edges for x in e}


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a string, b string")).count() == 0
