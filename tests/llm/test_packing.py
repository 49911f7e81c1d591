import random
import zlib
from collections import Counter
from itertools import combinations

import numpy as np
import public_tokenizers
import pytest
from tokenizers import Tokenizer

from tidemark.llm import packing
from tidemark.llm.packing import ByteEncoder, best_fit, pack, pack_documents, plan, reduce_by_dominance

TOKENIZER = public_tokenizers.path("byte_bpe_50k.json")


def fewest(lengths, capacity):
    """Fewest sequences, by trying all sets with the longest piece."""
    if not lengths:
        return 0
    first, rest = lengths[-1], lengths[:-1]
    best = len(lengths)
    for k in range(len(rest) + 1):
        for others in combinations(range(len(rest)), k):
            if first + sum(rest[i] for i in others) <= capacity:
                best = min(best, 1 + fewest([x for i, x in enumerate(rest) if i not in others], capacity))
    return best


def check(runs, counts, capacity):
    held = Counter()
    for run in runs:
        assert run.times > 0
        assert sum(length * n for length, n in run.holds.items()) <= capacity
        held.update({length: n * run.times for length, n in run.holds.items()})
    assert held == Counter(counts)
    return sum(run.times for run in runs)


def test_reduction_keeps_the_optimum():
    """What is fixed and the best packing of the rest make a best packing."""
    pick = random.Random(7)
    reduced = 0
    for _ in range(300):
        lengths = sorted(pick.randint(1, 12) for _ in range(pick.randint(1, 7)))
        rest = dict(Counter(lengths))
        runs = reduce_by_dominance(rest, 12)
        fixed = Counter(lengths) - Counter(rest)
        assert check(runs, fixed, 12) + fewest(sorted(Counter(rest).elements()), 12) == fewest(lengths, 12)
        reduced += bool(runs)
    assert reduced > 200


def test_best_fit_in_bulk_equals_piece_by_piece():
    pick = random.Random(8)
    for _ in range(300):
        counts = Counter(pick.randint(1, 30) for _ in range(pick.randint(1, 60)))
        rooms = []
        for length in sorted(counts.elements(), reverse=True):
            fitting = [r for r in rooms if r >= length]
            if fitting:
                rooms.remove(min(fitting))
                rooms.append(min(fitting) - length)
            else:
                rooms.append(30 - length)
        assert check(best_fit(dict(counts), 30), counts, 30) == len(rooms)


def test_plan_is_near_the_bound():
    pick = random.Random(9)
    counts = Counter(min(2048, int(pick.lognormvariate(6, 1)) + 1) for _ in range(20_000))
    used = check(plan(dict(counts), 2048), counts, 2048)
    bound = -(-sum(length * n for length, n in counts.items()) // 2048)
    assert used <= bound + 3
    assert plan({}, 2048) == []


def test_ids_equal_the_library(monkeypatch):
    exact = Tokenizer.from_file(TOKENIZER)
    pick = random.Random(3)
    letters = [chr(c) for c in range(0x250)] + list("漢😀한  �")
    batch = ["", " ", "\n\n x", "a<|endoftext|>b", "x" * 5000]
    batch += ["".join(pick.choice(letters) if pick.random() < 0.4 else pick.choice("etaoin   \n\n's  12") for _ in range(60)) for _ in range(600)]
    for at_once in (packing.AT_ONCE, 7):
        monkeypatch.setattr(packing, "AT_ONCE", at_once)
        encode = ByteEncoder(TOKENIZER)
        for text in batch:
            assert encode(text).tolist() == exact.encode(text, add_special_tokens=False).ids


def sequences(rows):
    """Each sequence is filled without gaps."""
    by = {}
    for r in rows:
        by.setdefault(r["sequence_id"], []).append((r["offset"], r["length"]))
    for held in by.values():
        end = 0
        for offset, length in sorted(held):
            assert offset == end
            end += length
        assert end <= 2048
    return len(by)


def test_documents(spark):
    pick = random.Random(4)
    words = ["alpha", "be", "gam", "ma\n", "é", "漢"]
    rows = [(i, " ".join(pick.choice(words) for _ in range(pick.choice([0, 1, 5, 300, 2500]))), "x", 1) for i in range(120)]
    rows += [(None, None, None, None), (None, "", "x", 1), (5, "same", "x", 1), (5, "same", "x", 1), (200, "word " * 6000, "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, id string, length int")
    got = pack_documents(docs, TOKENIZER).collect()
    sequences(got)
    exact = Tokenizer.from_file(TOKENIZER)
    expected = []
    for key, text, *_ in rows:
        ids = np.array([*exact.encode(text or "", add_special_tokens=False).ids, 0], "<u4")
        first = len(ids) % 2048 or 2048
        for piece, (start, end) in enumerate(zip([0, *range(first, len(ids), 2048)], range(first, len(ids) + 1, 2048), strict=True)):
            expected.append((key, piece, start, end - start, zlib.crc32(ids[start:end].tobytes())))
    assert sorted((tuple(r)[:5] for r in got), key=str) == sorted(expected, key=str)


def test_one_length_for_most(spark):
    pieces = spark.range(3000).selectExpr("id", "0 as piece", "0L as start", "if(id % 3 = 0, 700L, 1L + id % 2048) as length", "id as ids_crc32")
    got = pack(pieces).collect()
    assert len(got) == 3000 and len({(r["sequence_id"], r["offset"]) for r in got}) == 3000
    sequences(got)


def test_empty_table_and_wrong_lengths(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert pack_documents(docs, TOKENIZER).collect() == []
    with pytest.raises(ValueError):
        pack(spark.range(1).selectExpr("id", "0 as piece", "0L as start", "2049L as length", "id as ids_crc32"))


def test_special_tokens_in_texts_are_tokens(spark):
    exact = Tokenizer.from_file(TOKENIZER)
    cases = ["a <|endoftext|> b", "<|endoftext|>", "x<|endoftext|>y <|endoftext|", " é<|endoftext|>  <|endoftext|>", "<|endoftext|> " * 90]
    encode = ByteEncoder(TOKENIZER)
    for text in cases:
        assert encode(text).tolist() == exact.encode(text, add_special_tokens=False).ids
    assert encode(cases[0]).tolist() == [64, 220, 50256, 275]
    rows = spark.createDataFrame(list(enumerate(cases)), "doc_id bigint, text string")
    packed = {r["id"]: r for r in pack_documents(rows, TOKENIZER).collect()}
    for key, text in enumerate(cases):
        ids = np.array([*exact.encode(text, add_special_tokens=False).ids, 0], "<u4")
        assert packed[key]["length"] == len(ids) and packed[key]["ids_crc32"] == zlib.crc32(ids.tobytes())


def test_cuts_leave_special_tokens_whole(monkeypatch):
    monkeypatch.setattr(packing, "AT_ONCE", 5)
    encode, exact = ByteEncoder(TOKENIZER), Tokenizer.from_file(TOKENIZER)
    for text in ("word <|endoftext|> word <|endoftext|>word", "ab cd<|endoftext|> ef gh " * 5):
        assert encode(text).tolist() == exact.encode(text, add_special_tokens=False).ids
