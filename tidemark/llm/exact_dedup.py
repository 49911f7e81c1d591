"""Exact duplicates by composable polynomial fingerprints.

A text, without white space, is read as the digits of a number in base B modulo a prime. The number of
a concatenation follows from those of its parts: ``f(ab) = f(a) * B ** len(b) + f(b)``. So the parts of a
huge document are hashed by different tasks and put together afterwards. Four bases modulo 2**31 - 1 make a
fingerprint of 124 bits. Rows with equal fingerprints and lengths are then compared part by part.

Nulls count as empty texts, and empty texts are equal. Rows that agree in id and text are separate members of
their group, of which one stays. A null id comes after all others. Other columns are not looked at.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_parts, known_rows, rows_that_stay, saved, utf8

PRIME = (1 << 31) - 1
BASES = (1_000_003_019, 1_234_567_891, 1_690_911_347, 2_038_074_743)
#: Bytes hashed at a time. The sum of CHUNK products below 2**39 stays below 2**64.
CHUNK = 1 << 16
#: Documents with more characters than this are hashed in parts by several tasks.
HUGE = 1 << 22
SPACE = bytes([32, *range(9, 14)])
_SPACE_CLASS = r"[\x20\x09-\x0D]"

Print = tuple[int, int, int, int]


def _powers() -> np.ndarray:
    powers = np.empty((len(BASES), CHUNK), np.uint64)
    for row, base in zip(powers, BASES, strict=True):
        value = 1
        for i in range(CHUNK):
            row[CHUNK - 1 - i] = value
            value = value * base % PRIME
    return powers


def combine(left: Print, right: Print, right_bytes: int) -> Print:
    """The fingerprint of a text from those of its two parts."""
    return tuple(
        (a * pow(base, right_bytes, PRIME) + b) % PRIME for a, b, base in zip(left, right, BASES, strict=True)
    )


class Fingerprinter:
    def __init__(self) -> None:
        self._powers = _powers()

    def __call__(self, data: bytes) -> Print:
        """Chunk by chunk; each chunk is hashed as a whole, then appended.

        Bytes count from 1, so that leading zero bytes matter.
        """
        digits = np.frombuffer(data, np.uint8)
        value: Print = (0,) * len(BASES)
        for start in range(0, len(digits), CHUNK):
            part = digits[start : start + CHUNK].astype(np.uint64) + 1
            hashed = self._powers[:, CHUNK - len(part) :] @ part % PRIME
            value = combine(value, tuple(map(int, hashed)), len(part))
        return value


_KEY = ["id", "n_chars", "mark", "sha"]
_KEY_TYPES = "id bigint, n_chars bigint, mark bigint, sha string"
_KEY_FIELDS = [*((c, pa.int64()) for c in _KEY[:3]), ("sha", pa.string())]
_PRINT = "fa bigint, fb bigint, n_bytes bigint"
_PRINT_FIELDS = [pa.field(c, pa.int64()) for c in ("fa", "fb", "n_bytes")]


def _packed(value: Print, n_bytes: int) -> tuple[int, int, int]:
    return value[0] << 31 | value[1], value[2] << 31 | value[3], n_bytes


def _unpacked(fa: int, fb: int) -> Print:
    return fa >> 31, fa & PRIME, fb >> 31, fb & PRIME


def _hash_texts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = pa.schema([*_KEY_FIELDS, *_PRINT_FIELDS])
    hashed = Fingerprinter()

    def rows() -> Iterator[tuple]:
        for batch in batches:
            keys = zip(*(batch[c].to_pylist() for c in ("id", "n_chars", "mark")), strict=True)
            for key, text in zip(keys, utf8(batch["text"]), strict=True):
                text = text.translate(None, SPACE)
                yield *key, hashlib.sha256(text).hexdigest(), *_packed(hashed(text), len(text))

    yield from in_parts(rows(), out)


def _hash_parts(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = pa.schema([*_KEY_FIELDS, ("part", pa.int32()), *_PRINT_FIELDS])
    hashed = Fingerprinter()

    def rows() -> Iterator[tuple]:
        for batch in batches:
            keys = zip(*(batch[c].to_pylist() for c in (*_KEY, "part")), strict=True)
            for key, text in zip(keys, utf8(batch["text"]), strict=True):
                yield *key, *_packed(hashed(text), len(text))

    yield from in_parts(rows(), out)


def _join_parts(key, parts):
    """One document's part fingerprints, as many as it has parts, in order."""
    value: Print = (0,) * len(BASES)
    total = 0
    for row in parts.sort_values("part").itertuples():
        value = combine(value, _unpacked(row.fa, row.fb), row.n_bytes)
        total += row.n_bytes
    whole = parts.iloc[:1][_KEY].copy()
    whole["fa"], whole["fb"], whole["n_bytes"] = _packed(value, total)
    return whole


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", huge: int = HUGE) -> DataFrame:
    """Rows (id, n_chars, mark, sha, fa, fb, n_bytes), one for each row of ``docs``."""
    rows = known_rows(docs, id_col, text_col)
    schema = f"{_KEY_TYPES}, {_PRINT}"
    usual = rows.where(F.col("n_chars") <= huge).mapInArrow(_hash_texts, schema)

    bare = F.regexp_replace("text", _SPACE_CLASS, "")
    last = F.expr(f"cast(length(bare) div {huge} as int)")
    parts = (
        rows.where(F.col("n_chars") > huge)
        .withColumn("bare", bare)
        .withColumn("sha", F.sha2("bare", 256))
        .select(*_KEY, "bare", F.explode(F.sequence(F.lit(0), last)).alias("part"))
        .select(*_KEY, "part", F.substring("bare", F.col("part") * huge + 1, F.lit(huge)).alias("text"))
        .repartition(*_KEY, "part")
    )
    hashed = parts.mapInArrow(_hash_parts, f"{_KEY_TYPES}, part int, {_PRINT}")
    # Rows that agree in id and text have the same parts: put these together once and count them.
    once = hashed.groupBy(*_KEY, "part", "fa", "fb", "n_bytes").agg(F.count("*").alias("copies"))
    copies = once.where("part = 0").select(*_KEY, "copies")
    whole = once.groupBy(*_KEY).applyInPandas(_join_parts, schema)
    same = F.expr(" and ".join(f"w.{c} <=> c.{c}" for c in _KEY))
    split = whole.alias("w").join(copies.alias("c"), same)
    return usual.unionByName(split.select("w.*", F.expr("explode(array_repeat(0, int(copies)))").alias("_")).drop("_"))


def _chunks(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = pa.schema([*_PRINT_FIELDS, ("part", pa.int64()), ("data", pa.binary())])
    hashed = Fingerprinter()

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for text in utf8(batch["text"]):
                text = text.translate(None, SPACE)
                found = _packed(hashed(text), len(text))
                for start in range(0, len(text), CHUNK):
                    yield *found, start, text[start : start + CHUNK]

    yield from in_parts(rows(), out, 256)


def false_matches(docs: DataFrame, wanted: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The fingerprints (fa, fb, n_bytes) that texts with different bytes share; hardly ever any.

    The chunks that stand at one place in the texts of a group are all equal if and only if the smallest equals
    the largest. Both are found while the chunks stream by, in each task before the shuffle, so a
    group with a third of all rows sends one pair of chunks per task and place. ``wanted`` (id)
    are the rows that share a fingerprint with another.
    """
    rows = known_rows(docs, id_col, text_col).select("id", "text")
    members = rows.join(wanted.select(F.col("id").alias("_id")).distinct(), F.expr("id <=> _id"), "left_semi")
    chunks = members.select("text").mapInArrow(_chunks, f"{_PRINT}, part bigint, data binary")
    spans = chunks.groupBy("fa", "fb", "n_bytes", "part").agg(F.min("data").alias("low"), F.max("data").alias("high"))
    return spans.where("low <> high").select("fa", "fb", "n_bytes").distinct()


def exact_groups(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", huge: int = HUGE) -> DataFrame:
    """Rows (id, keep_id, group_size, kept, sha, n_chars, mark): one for each row of ``docs``.

    Of texts equal without white space stays the one with the most characters, then the smallest id.
    """
    prints = saved(fingerprints(docs, id_col, text_col, huge), "fingerprints")
    same_print = ["fa", "fb", "n_bytes"]
    shared = prints.groupBy(*same_print).agg(F.count("*").alias("n")).where("n > 1 and n_bytes > 0")
    # Stored sums meet the rows in joins whose large partitions Spark can split.
    wanted = prints.join(saved(shared, "shared-prints"), same_print, "left_semi")
    wrong = saved(false_matches(docs, wanted, id_col, text_col), "false-matches")
    return settle(prints, wrong)


def settle(prints: DataFrame, wrong: DataFrame) -> DataFrame:
    """Who stays, from the fingerprints and those among them that different texts share.

    The latter texts are told apart by their SHA-256.
    """
    same_print = ["fa", "fb", "n_bytes"]
    rows = prints.join(wrong.withColumn("wrong", F.lit(True)), same_print, "left").withColumn(
        "variant", F.when(F.col("wrong"), F.col("sha"))
    )
    key = [*same_print, "variant"]
    members = rows.groupBy(*key, *_KEY).agg(F.count("*").alias("copies"))
    # Most characters, then the smallest id, a null id last.
    best = F.max(F.struct("n_chars", F.col("id").isNotNull().alias("known"), F.bitwise_not("id").alias("down"), "mark"))
    groups = saved(members.groupBy(*key).agg(F.sum("copies").alias("group_size"), best.alias("best")), "groups")
    same = F.expr(" and ".join(f"m.{c} <=> g.{c}" for c in key))
    joined = members.alias("m").join(groups.alias("g"), same).select(
        *(f"m.{c}" for c in _KEY), F.bitwise_not("g.best.down").alias("keep_id"), "g.group_size", "g.best", "m.copies"
    )
    kept = F.expr("id <=> keep_id and n_chars = best.n_chars and mark = best.mark and copy = 0")
    return joined.select("*", F.expr("explode(sequence(0, int(copies) - 1))").alias("copy")).select(
        "id", "keep_id", "group_size", kept.alias("kept"), "sha", "n_chars", "mark"
    )


def drop_exact_copies(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The rows of ``docs`` that stay, with all their columns."""
    return rows_that_stay(docs, saved(exact_groups(docs, id_col, text_col), "exact-groups"), id_col, text_col)
