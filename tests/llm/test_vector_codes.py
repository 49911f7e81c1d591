import hashlib
import math
import random
from fractions import Fraction

import numpy as np
import pytest

from tidemark.llm import vector_codes
from tidemark.llm.vector_codes import compress, limb_width, limbs, products, squared_distances, whole_numbers

TYPES = "vec_id bigint, embedding array<double>, label int, id string, code string, part int"


def brute(rows, n_parts=8, n_entries=16, rounds=6):
    """Plain numbers of any length, no matrices."""
    kept = [r for r in rows if r[1] is not None and all(x is not None and math.isfinite(x) for x in r[1])]
    if not kept:
        return []
    kept.sort(key=lambda r: (r[0] is None, r[0] or 0, r[1]))
    width = max(1, -(-max(len(r[1]) for r in kept) // n_parts)) * n_parts
    numbers = [[math.floor(Fraction(x) * 4096) for x in r[1]] + [0] * (width - len(r[1])) for r in kept]
    d = width // n_parts
    parts = [[v[p * d : p * d + d] for v in numbers] for p in range(n_parts)]
    books = [[list(x) for x in own[:n_entries]] for own in parts]

    def nearest(x, book):
        return min((sum((a - b) ** 2 for a, b in zip(x, c, strict=True)), e) for e, c in enumerate(book))

    for _ in range(rounds):
        for p, own in enumerate(parts):
            chosen = [nearest(x, books[p])[1] for x in own]
            for e in range(len(books[p])):
                mine = [x for x, c in zip(own, chosen, strict=True) if c == e]
                if mine:
                    books[p][e] = [sum(x[i] for x in mine) // len(mine) for i in range(d)]
    final = [[nearest(parts[p][k], books[p]) for p in range(n_parts)] for k in range(len(kept))]
    errors = [sum(a for a, _ in f) for f in final]
    sums = {}
    for r, e in zip(kept, errors, strict=True):
        sums[r[2]] = sums.get(r[2], 0) + e

    def fits(x):
        return x if x < 1 << 63 else None

    wide = {r[2] for r, e in zip(kept, errors, strict=True) if fits(e) is None}
    digest = hashlib.sha256(",".join(str(x) for book in books for c in book for x in c).encode()).hexdigest()
    return sorted(
        (
            (r[0], "".join(f"{e:02x}" for _, e in f), fits(error), None if r[2] in wide else fits(sums[r[2]]), digest)
            for r, f, error in zip(kept, final, errors, strict=True)
        ),
        key=str,
    )


def found(spark, rows, **options):
    got = compress(spark.createDataFrame([(*r, "x", "x", 1) for r in rows], TYPES).repartition(3), **options)
    return sorted((tuple(r) for r in got.drop("label").collect()), key=str)


def vectors(n, dim, seed, size=1.0):
    draw = np.random.default_rng(seed)
    return [(k, [float(x) for x in draw.standard_normal(dim) * size], k % 3 or None) for k in range(n)]


EDGE = [
    (1, None, 1), (2, [None, 1.0], 1), (3, [float("nan")] * 16, 1), (4, [float("-inf")] * 16, 2), (5, [], None), (6, [0.5], 1),
    (None, [0.25] * 16, 1), (7, [-0.00001] * 16, None), (7, [-0.00001] * 16, None), (7, [0.0] * 16, 1), (8, [1.0] * 17, 2),
]


@pytest.mark.parametrize(
    "rows",
    [
        vectors(60, 16, 1),
        vectors(9, 24, 2, 1e4),
        vectors(40, 8, 3, 1e9),
        vectors(30, 16, 4) + [(100 + k, [3.4e38 * (-1) ** k] * 16, 5) for k in range(4)],
        [(k, [1.7e308] * 8, 1) for k in range(3)] + [(9, [-1.7e308] * 8, 2)],
        [(k, [1.0, -1.0] * 8, 1) for k in range(40)],
        EDGE,
        EDGE + vectors(50, 40, 5),
    ],
    ids=["usual", "few", "wide", "very wide", "widest", "equal", "edge", "edge and usual"],
)
def test_equals_brute_force(spark, rows):
    rows = list(rows)
    random.Random(1).shuffle(rows)
    assert found(spark, rows) == brute(rows)


def test_other_sizes(spark):
    rows = vectors(40, 12, 6)
    assert found(spark, rows, parts=4, entries=5, rounds=2) == brute(rows, 4, 5, 2)


def test_blocks_do_not_matter(spark, monkeypatch):
    rows = vectors(50, 16, 7)
    monkeypatch.setattr(vector_codes, "BLOCK", 48)
    assert found(spark, rows) == brute(rows)


def test_empty_table(spark):
    assert found(spark, []) == [] and found(spark, [(1, None, 1)]) == []


def test_floats_and_numbers(spark):
    rows = [(k, [k / 7, 1.0, -k / 3, 2.0] * 2, 1) for k in range(20)]
    floats = [(i, [float(np.float32(x)) for x in v], c) for i, v, c in rows]
    df = spark.createDataFrame(floats, "vec_id bigint, embedding array<float>, label int")
    assert sorted(map(tuple, compress(df).drop("label").collect()), key=str) == brute(floats)


@pytest.mark.parametrize("length", [1, 2, 3, 8, 9, 64, 100, 4096])
def test_limb_products_are_exact(length):
    draw = np.random.default_rng(length)
    width = limb_width(length)
    assert length * (1 << width) ** 2 <= 1 << 53
    for bits in (5, width, width + 1, 40, 61):
        top = (1 << bits) - 1
        a, b = (np.concatenate([draw.integers(-top, top + 1, (3, length)), np.full((1, length), s * top)]) for s in (1, -1))
        expected = a.astype(object) @ b.astype(object).T
        assert (products(a, b, object) == expected).all()
        assert ((a.astype(object)[:, None] - b.astype(object)[None]) ** 2).sum(-1).tolist() == squared_distances(a, b).tolist()
        parts = limbs(a, width)
        assert max(np.abs(p).max() for p in parts) <= 1 << width
        assert (sum(p.astype(np.int64).astype(object) << k * width for k, p in enumerate(parts)) == a).all()


def test_floors_go_down():
    assert whole_numbers(np.array([-0.0001, 0.0001, -1 / 4096, 2.0])).tolist() == [-1, 0, -1, 8192]
