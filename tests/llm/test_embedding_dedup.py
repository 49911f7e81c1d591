import random

import numpy as np
import pytest

from tidemark.llm.embedding_dedup import near_duplicates, tables_needed

TYPES = "vec_id bigint, embedding array<float>, label int, id string, size int"


def brute(rows, threshold=0.98):
    def sound(v, label):
        return label is not None and v is not None and len(v) and all(x is not None and np.isfinite(x) for x in v) and any(v)

    ok = [i for i, (_, v, label, *_) in enumerate(rows) if sound(v, label)]
    unit = {}
    for i in ok:
        v = np.array(rows[i][1], np.float32).astype(np.float64)
        v = v / np.abs(v).max()
        unit[i] = v / np.linalg.norm(v)
    low, links = {i: i for i in range(len(rows))}, [0] * len(rows)
    pairs = [
        (i, j) for i in ok for j in ok
        if i < j and rows[i][2] == rows[j][2] and len(unit[i]) == len(unit[j]) and unit[i] @ unit[j] >= threshold
    ]
    for i, j in pairs:
        links[i] += 1
        links[j] += 1
    changed = True
    while changed:
        changed = False
        for i, j in pairs:
            if low[i] != low[j]:
                low[i] = low[j] = min(low[i], low[j])
                changed = True
    known = {}
    for i, r in enumerate(low.values()):
        known.setdefault(r, []).append(rows[i][0])
    ids = {r: min((x for x in found if x is not None), default=None) for r, found in known.items()}
    return sorted(((rows[i][0], links[i], ids[low[i]]) for i in range(len(rows))), key=str)


def found(spark, rows, **options):
    return sorted(map(tuple, near_duplicates(spark.createDataFrame(rows, TYPES), **options).collect()), key=str)


def clusters(seed, centres, members, spread, dim=16):
    draw = np.random.default_rng(seed)
    rows, k = [], 0
    for c in range(centres):
        centre = draw.standard_normal(dim)
        for _ in range(members):
            v = centre / np.linalg.norm(centre) + draw.standard_normal(dim) * spread
            rows.append((k, [float(x) for x in v], c % 2, "x", 1))
            k += 1
    return rows


EDGE = [
    (1, [1.0, 0.0], 1, "x", 1), (2, [2.0, 0.0], 1, "x", 1), (3, [1.0, 0.1], 1, "x", 1), (4, [1.0, 0.3], 1, "x", 1), (5, [1.0, 0.0], 2, "x", 1),
    (6, None, 1, "x", 1), (7, [0.0, 0.0], 1, "x", 1), (8, [1.0, None], 1, "x", 1), (9, [1.0, float("nan")], 1, "x", 1), (10, [float("inf"), 0.0], 1, "x", 1),
    (11, [1.0, 0.0], None, "x", 1), (12, [], 1, "x", 1), (13, [1.0, 0.0, 0.0], 1, None, None), (14, [3e38, 3e38], 3, "x", 1), (15, [1e-38, 1e-38], 3, "x", 1),
    (None, [1.0, 0.0], 1, "x", 1), (2, [2.0, 0.0], 1, "x", 1), (2, [0.0, 1.0], 1, "x", 1), (0, [-0.0, 1.0], 1, "x", 1), (None, [5.0, 5.0], 4, "x", 1),
]


@pytest.mark.parametrize("block", [1024, 2])
def test_edge_cases(spark, block):
    assert found(spark, EDGE, block=block) == brute(EDGE)


@pytest.mark.parametrize("block", [1024, 16])
def test_clusters(spark, block):
    rows = clusters(1, 12, 12, 0.02) + [(k, [float(x) for x in np.random.default_rng(k).standard_normal(16)], 1, "x", 1) for k in range(1000, 1100)]
    rows += [(5000 + i, rows[0][1], rows[0][2], "x", 1) for i in range(40)]
    random.Random(1).shuffle(rows)
    assert found(spark, rows, recall=0.999999, block=block) == brute(rows)


def test_recall_at_the_threshold(spark):
    """Pairs that just reach the threshold are the hardest; at least 0.9 of the links are found."""
    draw = np.random.default_rng(4)
    rows = []
    for k in range(400):
        a, b = draw.standard_normal(32), draw.standard_normal(32)
        a /= np.linalg.norm(a)
        b -= (a @ b) * a
        b /= np.linalg.norm(b)
        rows.append((2 * k, [float(x) for x in a], 1, "x", 1))
        rows.append((2 * k + 1, [float(x) for x in 0.981 * a + (1 - 0.981**2) ** 0.5 * b], 1, "x", 1))
    got, expected = found(spark, rows), brute(rows)
    links = sum(n for _, n, _ in got)
    assert links <= sum(n for _, n, _ in expected) == 800
    assert links >= 0.98 * 800


def test_tables():
    assert tables_needed(0)[0] == 4
    bits, tables = tables_needed(10**9)
    assert 2**bits * 32 >= 10**9 and 1 - (1 - 0.9362**bits) ** tables >= 0.998


def test_empty_table(spark):
    assert found(spark, []) == []
