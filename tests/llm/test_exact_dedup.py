import random

import pytest

from tidemark.llm import exact_dedup as x
from tidemark.llm.exact_dedup import combine, drop_exact_copies, exact_groups, fingerprints

ROWS = "doc_id bigint, text string, id string, n_chars bigint, mark int"


def brute(rows):
    groups = {}
    for i, (doc_id, text, *_) in enumerate(rows):
        text = text or ""
        bare = "".join(c for c in text if c not in " \t\n\x0b\x0c\r")
        groups.setdefault(bare, []).append((-len(text), doc_id is None, doc_id, i))
    out = []
    for members in groups.values():
        members.sort(key=lambda m: (m[0], m[1], m[2] or 0))
        out += [(m[2], members[0][2], len(members), k == 0) for k, m in enumerate(members)]
    return sorted(out, key=str)


def found(spark, rows, **options):
    got = exact_groups(spark.createDataFrame(rows, ROWS), **options).collect()
    return sorted(((r.id, r.keep_id, r.group_size, r.kept) for r in got), key=str)


EDGE = [
    (1, "a b", "x", 1, 1), (2, "ab", "x", 1, 1), (3, " a\tb\n", None, None, None), (4, None, "y", 0, 0), (5, "", "z", 0, 0),
    (6, " \r\n", "z", 0, 0), (7, "a\u00a0b", "n", 3, 1), (None, "a  b ", "n", 3, 1), (8, "ab", "x", 1, 1), (8, "ab", "x", 1, 1),
    (9, "ba", "x", 1, 1), (10, "lang " * 40_000, "v", 1, 1), (11, "lang" * 40_000, "v", 1, 1), (12, "\0", "v", 1, 1),
    (13, "\0\0", "v", 1, 1),
]


@pytest.mark.parametrize("huge", [x.HUGE, 3, 1000])
def test_edge_cases(spark, huge):
    assert found(spark, EDGE, huge=huge) == brute(EDGE)


def test_random_rows(spark):
    pick = random.Random(5)
    rows = [
        (pick.randrange(30), "".join(pick.choice("ab \n") for _ in range(pick.randrange(6))), "", 0, 0) for _ in range(300)
    ]
    assert found(spark, rows) == brute(rows)
    assert found(spark, rows, huge=2) == brute(rows)


def test_empty_table(spark):
    assert found(spark, []) == []


def test_parts_combine():
    data = random.Random(1).randbytes(3 * x.CHUNK + 17)
    hashed = x.Fingerprinter()
    for cut in (0, 1, x.CHUNK, len(data) - 1, len(data)):
        assert combine(hashed(data[:cut]), hashed(data[cut:]), len(data) - cut) == hashed(data)


def test_shared_fingerprints_of_different_texts_are_told_apart(spark):
    docs = spark.createDataFrame([(i, t, "", 0, 0) for i, t in enumerate(["ab", "cd", "ab", "ef"])], ROWS)
    prints = fingerprints(docs)
    same = prints.drop("fa", "fb").selectExpr("*", "1L as fa", "1L as fb").select(*prints.columns)
    wrong = spark.createDataFrame([(1, 1, 2)], "fa bigint, fb bigint, n_bytes bigint")
    got = x.settle(same, wrong).collect()
    assert sorted((r.id, r.keep_id, r.group_size) for r in got) == [(0, 0, 2), (1, 1, 1), (2, 0, 2), (3, 3, 1)]


def test_equal_texts_are_no_false_match(spark):
    docs = spark.createDataFrame([(0, "ab", "", 0, 0), (1, "a b", "", 0, 0)], ROWS)
    assert x.false_matches(docs, fingerprints(docs)).collect() == []


def test_rows_that_stay(spark):
    docs = spark.createDataFrame(EDGE, ROWS)
    got = drop_exact_copies(docs)
    assert got.columns == docs.columns
    assert sorted((r.doc_id is None, r.doc_id or 0) for r in got.collect()) == [
        (False, 3), (False, 6), (False, 7), (False, 9), (False, 10), (False, 12), (False, 13),
    ]


def test_identical_rows_leave_one(spark):
    rows = [(8, "ab", "x", 1, 1), (8, "ab", "x", 1, 1), (9, "c", "x", 1, 1), (None, "d", None, None, None), (None, "d", None, None, None)]
    got = drop_exact_copies(spark.createDataFrame(rows, ROWS)).collect()
    assert sorted(str(r.doc_id) for r in got) == ["8", "9", "None"]
