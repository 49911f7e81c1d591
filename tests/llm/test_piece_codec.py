import hashlib
import random
from itertools import chain

import public_tokenizers
import pytest

from tidemark.llm import piece_codec
from tidemark.llm.piece_codec import PieceCodec, encode_documents, sections

MODEL = public_tokenizers.path("piece_bpe_32k.model")
HARD = [
    "", " ", "  ", "a  b", "a ", " a", "▁", "▁▁a", "\0", "a\nb", " ", "😀 x", "x" * 1000, "abc" * 500, " " * 100, "한국어 텍스트",
    "<s> </s> <unk> <0x0A>", "a" * 39, "a" * 40, "a" * 41, "the\tthe", "é" * 45, "�", "a▁b", "die Verständigungsschwierigkeiten",
]


@pytest.fixture(scope="module")
def codec():
    return PieceCodec(MODEL)


def random_texts(seed, n):
    pick = random.Random(seed)
    return ["".join(pick.choice("abcdeest  \nthin,éß漢😀ng▁") for _ in range(pick.randrange(90))) for _ in range(n)]


def test_ids_equal_the_library(codec):
    batch = HARD + random_texts(1, 1500)
    expected = codec.library.encode(batch)
    assert codec.encode(batch) == expected
    assert [codec.encode([t])[0] for t in batch[:60]] == expected[:60]


def test_heap_and_matrix_agree(codec):
    for text in HARD + random_texts(2, 500):
        words = codec.words(text)
        assert list(chain.from_iterable(map(codec._agenda, words))) == codec.encode([text])[0]


def test_sections_give_the_ids_of_the_whole(codec):
    for text in HARD + random_texts(3, 500):
        parts = list(sections(text, 8))
        ids = codec.encode(parts)
        assert list(chain.from_iterable(ids)) == codec.encode([text])[0]
        assert " ".join(codec.library.decode(ids)) == codec.library.decode([list(chain.from_iterable(ids))])[0]


def test_full_memory_starts_anew(codec, monkeypatch):
    monkeypatch.setattr(piece_codec, "REMEMBERED", 20)
    fresh = PieceCodec(MODEL)
    batch = random_texts(4, 80)
    assert [fresh.encode([t])[0] for t in batch] == codec.encode(batch)
    assert len(fresh._numbers) < 60


def test_wrong_ids_are_seen(monkeypatch):
    fresh = PieceCodec(MODEL)
    monkeypatch.setattr(fresh.merges, "rank", fresh.merges.rank.max() - fresh.merges.rank)
    with pytest.raises(ValueError):
        fresh.encode(["the weather station"])


@pytest.mark.parametrize("at_once", [piece_codec.AT_ONCE, 40])
def test_documents(spark, codec, at_once):
    rows = [(i, t, "x", i) for i, t in enumerate([*HARD, *random_texts(5, 40), "word " * 500])]
    rows += [(None, None, None, None), (1, None, "x", 1), (1, "a  b", "x", 1), (1, "a  b", "x", 1)]
    docs = spark.createDataFrame(rows, "doc_id bigint, text string, id string, n_tokens int").coalesce(2)
    got = sorted(map(tuple, encode_documents(docs, MODEL, at_once=at_once).collect()), key=str)
    expected = []
    for key, text, *_ in rows:
        ids = codec.library.encode(text or "")
        sha = [hashlib.sha256(s.encode()).hexdigest() for s in (",".join(map(str, ids)), codec.library.decode(ids))]
        expected.append((key, len(ids), *sha))
    assert got == sorted(expected, key=str)


def test_empty_table(spark):
    docs = spark.createDataFrame([], "doc_id bigint, text string")
    assert encode_documents(docs, MODEL).collect() == []
