"""Connected components against union-find."""

import random

import pytest

from satchel.llm.components import components

SCHEMA = "a long, b long"


def joined(links):
    parent = {x: x for link in links for x in link}

    def root(x):
        while parent[x] != x:
            x = parent[x]
        return x

    for a, b in links:
        a, b = root(a), root(b)
        parent[max(a, b)] = min(a, b)
    return {x: root(x) for x in parent if root(x) != x}


def drawn(seed, n, links):
    draw = random.Random(seed)
    return [(draw.randrange(n), draw.randrange(n)) for _ in range(links)]


CASES = {
    "none": [],
    "own": [(3, 3)],
    "repeated": [(1, 2), (2, 1), (1, 2)],
    "chain": [(i, i + 1) for i in range(120)],
    "star": [(0, i) for i in range(1, 200)],
    "star on its largest": [(500, i) for i in range(200)],
    "two stars by their ends": [(0, i) for i in range(2, 50)] + [(1, i) for i in range(49, 90)],
    "sparse": drawn(1, 300, 120),
    "dense": drawn(2, 300, 400),
}


@pytest.mark.parametrize("case", CASES)
def test_components(spark, case):
    links = CASES[case]
    found = [(r.node, r.component) for r in components(spark.createDataFrame(links, SCHEMA)).collect()]
    assert len(found) == len(set(found))
    assert dict(found) == joined(links)
