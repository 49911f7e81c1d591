import random
from collections import Counter

import numpy as np
import pytest

from __spark_entry__ import SMOKE_DIR
from tidemark.llm import suffix_dedup
from tidemark.llm.common import table
from tidemark.llm.suffix_dedup import Anchors, merged, remove_repeats

DOCS = "doc_id bigint, text string, id string, spans string"


def brute(rows, length):
    texts = [(t or "").encode() for _, t, *_ in rows]
    counts = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for (key, *_), text in zip(rows, texts, strict=True):
        gone = bytearray(len(text))
        for i in range(len(text) - length + 1):
            if counts[text[i : i + length]] > 1:
                gone[i : i + length] = b"\1" * length
        n_spans = sum(gone[i] and not (i and gone[i - 1]) for i in range(len(text)))
        out.append((key, len(text), sum(gone), n_spans, bytes(c for c, g in zip(text, gone, strict=True) if not g)))
    return sorted(out, key=str)


def found(spark, rows, **options):
    docs = spark.createDataFrame(rows, DOCS).repartition(3)
    return sorted(((*tuple(r)[:4], bytes(r["kept"])) for r in remove_repeats(docs, **options).collect()), key=str)


def passages(seed, length, n=80):
    pick = random.Random(seed)
    common = ["".join(pick.choice("abcdé ") for _ in range(pick.randrange(length // 2, 3 * length))) for _ in range(8)]
    rows = []
    for i in range(n):
        parts = []
        for _ in range(pick.randrange(5)):
            text = pick.choice(common)
            if pick.random() < 0.3:
                text = text[pick.randrange(len(text)) :]
            if pick.random() < 0.2:
                text = text[: len(text) // 2] + "#" + text[len(text) // 2 + 1 :]
            parts += [text, "".join(pick.choice("xyz") for _ in range(pick.randrange(30)))]
        rows.append((i, "".join(parts), "x", "y"))
    return rows


EDGE = [
    (1, None, None, None), (2, "", "", ""), (3, "é" * 9, "x", "y"), (4, "é" * 10, "x", "y"), (None, "a" * 19, "x", "y"), (5, "a" * 50, "x", "y"),
    (6, "ab" * 30, "x", "y"), (7, "same text that is long enough", "x", "y"), (7, "same text that is long enough", "x", "y"),
    (8, "prefix same text that is long enough", "x", "y"), (8, "other text of this id and no more", "x", "y"), (9, "z\0" * 30, "x", "y"),
]


@pytest.mark.parametrize("options", [{}, {"shard": 1, "limit": 20}])
def test_edge_cases(spark, options):
    assert found(spark, EDGE, length=20, **options) == brute(EDGE, 20)


@pytest.mark.parametrize("seed", [1, 2])
@pytest.mark.parametrize("length, options", [(20, {}), (40, {"shard": 300, "limit": 100}), (200, {})])
def test_passages(spark, seed, length, options):
    rows = passages(seed, length)
    got, expected = found(spark, rows, length=length, **options), brute(rows, length)
    assert got == expected
    assert any(n_spans > 1 for *_, n_spans, _ in got) and any(0 < gone < n for _, n, gone, *_ in got)


def test_given_documents(spark):
    docs = table(spark, SMOKE_DIR, "documents")
    rows = [(r["doc_id"], r["text"]) for r in docs.select("doc_id", "text").collect()]
    got = sorted(((*tuple(r)[:4], bytes(r["kept"])) for r in remove_repeats(docs).collect()), key=str)
    assert got == brute(rows, 200)


def test_long_texts_are_read_in_parts():
    pick = random.Random(5)
    texts = [bytes(pick.choice(b"abc") for _ in range(n)) for n in (0, 7, 39, 40, 41, 500, 3)]
    texts.append(texts[5][100:300] * 3)
    whole = fragments(texts, 100_000)
    cut = fragments(texts, 64)
    assert {(t, s) for t, s, *_ in places(whole)} == {(t, s) for t, s, *_ in places(cut)}
    assert places(whole) == places(cut)


def fragments(texts, most):
    return list(suffix_dedup._fragments(texts, Anchors(40), most))


def places(parts):
    """(text, place, anchor's place, anchor) of each string; a part's end may cut a fragment in two."""
    return sorted(
        (int(t), int(s) + k, int(at), int(anchor))
        for number, start, counts, at_, anchors, _ in parts
        for t, s, n, at, anchor in zip(number, start, counts, at_, anchors, strict=True)
        for k in range(n)
    )


def test_equal_strings_have_equal_anchors():
    pick = random.Random(6)
    text = bytes(pick.choice(b"ab") for _ in range(40))
    texts = [bytes(pick.choice(b"ab") for _ in range(pick.randrange(90))) + text + bytes(pick.choice(b"ab") for _ in range(pick.randrange(90))) for _ in range(50)]
    found = set()
    for (t, s, at, anchor) in places(fragments(texts, 10_000)):
        if texts[t][s : s + 40] == text:
            found.add((at - s, anchor))
    assert len(found) == 1


def test_ranges():
    starts, ends = merged(np.array([5, 0, 3, 20, 9]), np.array([9, 2, 8, 30, 10]))
    assert (starts.tolist(), ends.tolist()) == ([0, 3, 20], [2, 10, 30])


def test_empty_table(spark):
    assert found(spark, []) == []
