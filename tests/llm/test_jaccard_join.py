import random
import re

import numpy as np
import pytest

from tidemark.llm import jaccard, jaccard_join
from tidemark.llm.jaccard import allocate, bounds, keys, largest_difference, linked, may_link, shingle_sets, sketch
from tidemark.llm.jaccard_join import drop_similar, similar_groups

DOCS = "doc_id bigint, text string, n bigint, cid string"


def brute_set(text, n_words=4):
    words = re.findall(r"[^\x20\x09-\x0D]+", "".join(c.lower() if "A" <= c <= "Z" else c for c in text or ""))
    if len(words) < n_words:
        return {tuple(words)} if words else set()
    return {tuple(words[i : i + n_words]) for i in range(len(words) - n_words + 1)}


def brute(rows, percent=85, n_words=4):
    sets = [brute_set(t, n_words) for _, t, *_ in rows]
    low = list(range(len(rows)))
    pairs = [
        (i, j) for i in range(len(rows)) for j in range(i)
        if sets[i] and sets[j] and 100 * len(sets[i] & sets[j]) >= percent * len(sets[i] | sets[j])
    ]
    changed = True
    while changed:
        changed = False
        for i, j in pairs:
            if low[i] != low[j]:
                low[i] = low[j] = min(low[i], low[j])
                changed = True
    ids = {}
    for i, r in enumerate(low):
        ids.setdefault(r, []).append(rows[i][0])
    first = {r: min((x for x in found if x is not None), default=None) for r, found in ids.items()}
    return sorted(((rows[i][0], len(sets[i]), first[low[i]]) for i in range(len(rows))), key=str)


def found(spark, rows, **options):
    got = similar_groups(spark.createDataFrame(rows, DOCS).repartition(3), **options).collect()
    return sorted(((r["id"], r["n_shingles"], r["component_id"]) for r in got), key=str)


def near_copies(seed, bases=6, copies=8, rate=0.02, sizes=(3, 5, 8, 12, 30, 80, 200, 600)):
    pick = random.Random(seed)
    rows = []
    for _ in range(bases):
        base = [f"w{pick.randrange(400)}" for _ in range(pick.choice(sizes))]
        for _ in range(copies):
            words = [f"x{pick.randrange(10**6)}" if pick.random() < rate * pick.random() * 3 else w for w in base]
            if pick.random() < 0.3:
                del words[pick.randrange(len(words)) :][:2]
            rows.append(" ".join(words))
    return rows


EDGE = [
    (1, "one two three", 1, "x"), (2, "ONE\ttwo\n three ", 1, "x"), (3, "one two", 1, "x"), (4, None, None, None), (5, "", 0, ""), (6, " \n", 0, ""),
    (7, "a b c d", 1, "x"), (8, "a b c d a b c d", 1, "x"), (9, "É é x y", 1, ""), (10, "é é x y", 1, ""), (None, "a b c d", 1, ""), (None, "only null id here", 1, ""),
    (7, "a b c d", 1, "x"), (7, "a  b c d", 1, "x"), (7, "other text of this id", 1, "x"), (11, "  a b", 1, ""), (12, "x" * 100_000, 1, ""),
]


def test_edge_cases(spark):
    assert found(spark, EDGE) == brute(EDGE)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("frequent, block", [(32, 1024), (2, 4)])
def test_near_copies(spark, monkeypatch, seed, frequent, block):
    monkeypatch.setattr(jaccard_join, "FREQUENT", frequent)
    rows = [(i, t, 1, "x") for i, t in enumerate(near_copies(seed, bases=14))]
    random.Random(seed).shuffle(rows)
    got = found(spark, rows, block=block)
    assert got == brute(rows)
    assert 5 < len({c for *_, c in got}) < len(rows) - 5


def test_common_passage_and_chain(spark):
    """Many share half of their words, which makes keys frequent; others are linked from one to the next only."""
    pick = random.Random(3)
    passage = " ".join(f"p{i}" for i in range(60))
    rows = [(i, passage + " " + " ".join(f"u{pick.randrange(10**6)}" for _ in range(pick.randrange(5, 60))), 1, "") for i in range(150)]
    words = [f"c{i}" for i in range(100)]
    for i in range(40):
        rows.append((1000 - i, " ".join(words), 1, ""))
        words[pick.randrange(100)] = f"d{i}"
    assert found(spark, rows, block=16) == brute(rows)


def test_other_threshold_and_rows_that_stay(spark):
    rows = [(i, t, 1, "x") for i, t in enumerate(near_copies(5, bases=8, rate=0.03))] + EDGE
    docs = spark.createDataFrame(rows, DOCS)
    assert found(spark, rows, percent=80, n_words=5) == brute(rows, 80, 5)
    got = drop_similar(docs)
    assert got.columns == docs.columns
    expected = brute(rows, 80, 5)
    stay = sorted(str(i) for i, n, c in {(i, n, c) for i, n, c in expected if i == c or n == 0})
    # Ids that stand for several groups, and rows without words, which repeat nothing.
    assert sorted({str(r["doc_id"]) for r in got.collect()}) == sorted(set(stay))


def test_empty_table(spark):
    assert found(spark, []) == []


def test_sets(monkeypatch):
    texts = ["", "a", "a b c", "a b c d", "A b\x0bc\x0cd e f a b c d", "é b \x1c d e", *near_copies(9)]
    sets = dict(shingle_sets((i, t.encode()) for i, t in enumerate(texts)))
    assert [len(s) for s in sets.values()] == [len(brute_set(t)) for t in texts]
    for i in range(len(texts)):
        for j in range(i):
            assert len(np.intersect1d(sets[i], sets[j])) == len(brute_set(texts[i]) & brute_set(texts[j]))
    monkeypatch.setattr(jaccard.sections, "__defaults__", (20,))
    cut = dict(shingle_sets((i, t.encode()) for i, t in enumerate(texts)))
    assert all((cut[i] == sets[i]).all() for i in sets)


def differing(pick, size, most):
    """Two sets of about this size that differ in at most so many elements."""
    a = {pick.randrange(1 << 64) for _ in range(size)}
    b = set(a)
    for _ in range(pick.randint(0, most)):
        if pick.random() < 0.5 and b:
            b.remove(pick.choice(sorted(b)[:3]))
        else:
            b.add(pick.randrange(1 << 64))
    return (np.array(sorted(x), np.uint64) for x in (a, b))


def test_linked_sets_share_a_key_and_pass_the_sketch():
    """More keys than their spares allow to be left out."""
    pick = random.Random(4)
    for percent in (80, 85):
        tried = 0
        for _ in range(1500):
            a, b = differing(pick, pick.choice([1, 2, 5, 7, 9, 13, 20, 33, 60, 150, 400]), pick.choice([1, 3, 8, 30, 80]))
            if not len(b) or not linked(a, b, percent):
                continue
            tried += 1
            (ka, sa), (kb, sb) = keys(a, percent), keys(b, percent)
            shared, at_a, at_b = np.intersect1d(ka, kb, return_indices=True)
            assert len(shared) > max(0, min(sa[at_a].max(), sb[at_b].max()))
            x, y = (np.frombuffer(sketch(s, percent), np.uint64)[None] for s in (a, b))
            words = min(x.shape[1], y.shape[1])
            x, y = jaccard.folded(x, words), jaccard.folded(y, words)
            assert may_link(x, y, np.array([len(a)]), np.array([len(b)]), percent)[0]
        assert tried > 300


def test_plans():
    for percent in (80, 85):
        starts = bounds(percent)
        for band in range(45):
            plan = allocate(band, percent)
            low, high = starts[band], starts[band + 1] - 1
            for a in range(max(1, low * percent // 100), high + 1, max(1, high // 50)):
                for b in {max(low, a), high}:
                    if 100 * min(a, b) >= percent * max(a, b):
                        assert plan.segments + plan.deleted > largest_difference(a, b, percent) + plan.spare - 1
    assert any(allocate(b, 85).deleted for b in range(20)) and allocate(30, 85).spare > 0


def test_long_words_that_polynomials_confuse(spark):
    """The Thue-Morse word and its complement agree in every polynomial hash modulo a power of two with an odd base."""
    word = "".join("ab"[bin(i).count("1") % 2] for i in range(4096))
    other = word.translate(str.maketrans("ab", "ba"))
    rows = [(1, word), (2, other), (3, f"{word} {other} x y z"), (4, f"{other} {other} x y z"), (5, word.upper())]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string")
    found = {r["id"]: (r["n_shingles"], r["component_id"]) for r in similar_groups(docs).collect()}
    assert found == {1: (1, 1), 2: (1, 2), 3: (2, 3), 4: (2, 4), 5: (1, 1)}
