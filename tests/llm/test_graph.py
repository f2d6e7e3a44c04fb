import random

import numpy as np

from loadlens.llm.graph import components


def reference(edges):
    up = {}

    def find(x):
        up.setdefault(x, x)
        while up[x] != x:
            x = up[x]
        return x
    for a, b in edges:
        if a is None or b is None or a == b:
            continue
        x, y = find(a), find(b)
        up[max(x, y)] = min(x, y)
    return {x: find(x) for x in up}


def test_components_of_chains_hubs_and_repeats(spark):
    rnd = random.Random(3)
    edges = [(i, i + 1) for i in range(100, 140)] + [(500, i) for i in range(501, 560)]
    edges += [(rnd.randrange(1000, 1100), rnd.randrange(1000, 1100)) for _ in range(70)]
    edges += edges[:20] + [(7, 7), (None, 3), (-5, 2 ** 62)]
    got = components(spark.createDataFrame(edges, "a long, b long")).collect()
    assert len(got) == len({r.id for r in got})
    assert {r.id: r.component for r in got} == reference(edges)


def test_no_links(spark):
    assert components(spark.createDataFrame([], "a long, b long")).count() == 0


def test_stars_in_a_tile():
    from loadlens.llm.near_vectors import stars
    label = stars(np.array([0, 2, 3]), np.array([1, 3, 4]), 6)
    assert label.tolist() == [0, 0, 2, 2, 2, 5]
