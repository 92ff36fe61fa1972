import random

from activitymill.llm.components import components


def expected(edges):
    root = {}

    def find(x):
        root.setdefault(x, x)
        while root[x] != x:
            x = root[x]
        return x

    for a, b in edges:
        if a is not None and b is not None and a != b:
            x, y = find(a), find(b)
            root[max(x, y)] = min(x, y)
    return {x: find(x) for x in root}


def test_chains_stars_loops_nulls_and_repeats(spark):
    rng = random.Random(2)
    edges = [(k, k + 1) for k in range(60)] + [(500, k) for k in range(600, 700)] + [(7, 7), (None, 3), (3, None), (1, 0)]
    edges += [(rng.randint(-90, -1), rng.randint(-90, -1)) for _ in range(70)]
    edges += [(-(2 ** 63), 2 ** 63 - 1)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert {r.node: r.root for r in got} == expected(edges) and len(got) == len(expected(edges))


def test_no_edges(spark):
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []
