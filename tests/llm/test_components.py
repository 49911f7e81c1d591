import random

import pytest

from tidemark.llm.components import connected_components


def brute(edges):
    low = {n: n for e in edges if None not in e for n in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            if None not in (a, b) and low[a] != low[b]:
                low[a] = low[b] = min(low[a], low[b])
                changed = True
    return sorted(low.items())


CASES = {
    "none": [],
    "loop": [(3, 3)],
    "nulls": [(None, 1), (2, None), (4, 5)],
    "chain": [(i, i + 1) for i in range(60)],
    "star": [(0, i) for i in range(1, 200)] + [(200 + i, 199 - i) for i in range(20)],
    "repeats": [(1, 2), (2, 1), (1, 2), (-5, 2)],
    "random": [(random.Random(i).randrange(150), random.Random(i + 999).randrange(150)) for i in range(110)],
}


@pytest.mark.parametrize("name", CASES)
def test_components(spark, name):
    edges = CASES[name]
    got = connected_components(spark.createDataFrame(edges, "a bigint, b bigint")).collect()
    expected = [x for x in brute(edges) if any(a != b and x[0] in (a, b) and None not in (a, b) for a, b in edges)]
    assert sorted(map(tuple, got)) == expected
