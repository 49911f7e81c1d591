"""Packing tokenised documents into sequences of fixed length.

What a packing depends on is only how many pieces have which length: at most ``capacity`` numbers, whatever the
corpus. On these, the driver first applies the reduction of Martello and Toth: a small set of
lengths that holds length j and into which the rest of any other set with j could be exchanged is fixed for good. The
instance that remains is packed by best fit, longest first. Both work on all pieces of a length at once.
The result is a table of runs: so many sequences, each holding so many pieces of certain lengths. Spark
numbers the pieces of each length and looks up their run, so no task and no driver sees them all.

Null counts as an empty text, which still has its end id. Rows may repeat, and each is packed. Other columns are not
looked at. An empty table gives no pieces.
"""

from __future__ import annotations

import json
import re
import zlib
from bisect import bisect_left, bisect_right, insort
from collections.abc import Iterable, Iterator, Sequence
from dataclasses import dataclass, field
from math import isqrt

import numpy as np
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from tokenizers import Tokenizer
from tokenizers.pre_tokenizers import ByteLevel

from tidemark.llm.common import in_parts, saved, texts

CAPACITY = 2048
END_ID = 0
#: Characters encoded at a time.
AT_ONCE = 1_000_000
#: Splits text as the vocabulary's own pre-tokenizer does (a fixed value of this vocabulary family).
PATTERN = r"'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"
#: Where this pattern cannot join what stands on both sides.
_CUT = re.compile(r"(?<=\S) (?=\S)")
#: Characters whose classes are the same in every release of Unicode the two libraries may follow.
_PLAIN = re.compile("[\0-ɏ]*")


class ByteEncoder:
    """Ids of a byte-level vocabulary file, as ``tokenizers`` gives them without adding special tokens.

    The string of a special token in a text is that token. Plain texts go through ``tiktoken`` over the ranks in
    the file, several times faster and with the same ids; texts with other characters or with special tokens
    go through ``tokenizers``.
    """

    def __init__(self, path: str) -> None:
        self.exact = Tokenizer.from_file(path)
        with open(path, encoding="utf-8") as file:
            model = json.load(file)["model"]
        special = self.exact.get_added_tokens_decoder()
        self.special = [token.content for token in special.values()]
        if any(_CUT.search(content) for content in self.special):
            raise ValueError("texts are cut at blanks, so special tokens must not hold any")
        letters = {c: b for b, c in _byte_letters().items()}
        ranks = {bytes(letters[c] for c in piece): i for piece, i in model["vocab"].items() if i not in special}
        self.fast = tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})

    def __call__(self, text: str) -> np.ndarray:
        """The ids, section by section: memory holds the ids and one section's strings."""
        parts = []
        start = 0
        while start < len(text) or not parts:
            cut = _CUT.search(text, start + AT_ONCE) if len(text) - start > AT_ONCE else None
            end = cut.start() if cut else len(text)
            part = text[start:end]
            if _PLAIN.fullmatch(part) and not any(content in part for content in self.special):
                ids = self.fast.encode_ordinary(part)
            else:
                ids = self.exact.encode(part, add_special_tokens=False).ids
            parts.append(np.array(ids, np.uint32))
            start = end
        return np.concatenate(parts)


def _byte_letters() -> dict[int, str]:
    """The letter by which such files show each byte: itself if it can be seen, else the next unused one."""
    shown = [b for b in range(256) if 33 <= b <= 126 or 161 <= b <= 172 or 174 <= b <= 255]
    hidden = [b for b in range(256) if b not in shown]
    letters = {b: chr(b) for b in shown} | {b: chr(256 + k) for k, b in enumerate(hidden)}
    assert set(letters.values()) == set(ByteLevel.alphabet())
    return letters


def token_pieces(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows (id, piece, start, length, ids_crc32): every document, closed by END_ID, in pieces.

    Only documents longer than ``capacity`` are cut; all pieces but the first are then full.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = pa.schema(
            [("id", pa.int64()), ("piece", pa.int32()), *((c, pa.int64()) for c in ("start", "length", "ids_crc32"))]
        )
        encode = ByteEncoder(tokenizer)

        def rows() -> Iterator[tuple]:
            for batch in batches:
                for key, text in zip(batch["id"].to_pylist(), texts(batch["text"]), strict=True):
                    ids = np.append(encode(text), np.uint32(END_ID)).astype("<u4")
                    first = len(ids) % capacity or capacity
                    for piece, end in enumerate(range(first, len(ids) + 1, capacity)):
                        start = max(0, end - capacity)
                        yield key, piece, start, end - start, zlib.crc32(ids[start:end].tobytes())

        yield from in_parts(rows(), out)

    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, "id bigint, piece int, start bigint, length bigint, ids_crc32 bigint")


@dataclass
class Run:
    """``times`` sequences, each with these numbers of pieces by length."""

    times: int
    holds: dict[int, int] = field(default_factory=dict)


def reduce_by_dominance(counts: dict[int, int], capacity: int) -> list[Run]:
    """Fix sets that dominate; ``counts`` keeps the rest.

    For a length j and the room left beside it, k is the longest that fits. {j} dominates if nothing fits. {j, k}
    dominates if k fills the room or no two pieces fit together: whatever else stood beside j could take k's
    place. {j, k, b}, with b the longest beside j and k, dominates if no three more pieces fit and
    of any two that do, the shorter is at most b, for the longer is at most k.
    """
    fixed: list[Run] = []
    lengths = sorted(counts)

    def take(*chosen: int) -> bool:
        need: dict[int, int] = {}
        for length in chosen:
            need[length] = need.get(length, 0) + 1
        times = min(counts[length] // n for length, n in need.items())
        if times:
            fixed.append(Run(times, need))
            for length, n in need.items():
                counts[length] -= n * times
                if not counts[length]:
                    del counts[length]
                    lengths.remove(length)
        return bool(times)

    def longest(room: int, *used: int) -> int | None:
        """The longest length up to ``room`` that still has a piece beside the used ones."""
        for i in range(bisect_right(lengths, room) - 1, -1, -1):
            if counts[lengths[i]] > used.count(lengths[i]):
                return lengths[i]
        return None

    def shortest(n: int, *used: int) -> int:
        """The sum of the n shortest pieces beside the used ones; more than any room if there are fewer."""
        total = 0
        for length in lengths:
            some = min(n, counts[length] - used.count(length))
            total, n = total + some * length, n - some
            if not n:
                return total
        return capacity + 1

    def two_over(b: int, room: int, j: int) -> bool:
        """Whether two pieces longer than b fit into the room together."""
        first = bisect_right(lengths, b)
        over = [x for x in lengths[first : first + 3] for _ in range(min(2, counts[x] - (x == j)))]
        return len(over) > 1 and over[0] + over[1] <= room

    def fix(j: int) -> bool:
        room = capacity - j
        k = longest(room, j)
        if k is None:
            return take(j)
        if k == room or shortest(2, j) > room:
            return take(j, k)
        b = longest(room - k, j, k)
        if b is not None and shortest(3, j) > room and not two_over(b, room, j):
            return take(j, k, b)
        return False

    again = True
    while again:
        again = False
        for j in sorted(counts, reverse=True):
            while j in counts and fix(j):
                again = True
    return fixed


def best_fit(counts: dict[int, int], capacity: int) -> list[Run]:
    """Longest first, each piece into the fullest sequence that still holds it."""
    open_: dict[int, list[Run]] = {}
    rooms: list[int] = []

    def put(room: int, run: Run) -> None:
        if not run.times:
            return
        if room not in open_:
            open_[room] = []
            insort(rooms, room)
        open_[room].append(run)

    def fill(room: int, run: Run, length: int, left: int) -> int:
        """Put pieces into these sequences, one after another; returns how many are left."""
        each = room // length
        full = min(run.times, left // each)
        put(room - each * length, Run(full, run.holds | {length: each}))
        left -= full * each
        rest = run.times - full
        if rest and left:
            put(room - left * length, Run(1, run.holds | {length: left}))
            left, rest = 0, rest - 1
        put(room, Run(rest, run.holds))
        return left

    for length in sorted(counts, reverse=True):
        left = counts[length]
        while left:
            i = bisect_left(rooms, length)
            if i == len(rooms):
                each = capacity // length
                left = fill(capacity, Run(-(-left // each)), length, left)
                continue
            room = rooms[i]
            run = open_[room].pop()
            if not open_[room]:
                del open_[room]
                rooms.pop(i)
            left = fill(room, run, length, left)
    return [run for runs in open_.values() for run in runs]


def plan(counts: dict[int, int], capacity: int) -> list[Run]:
    """A packing of that many pieces of each length."""
    counts = {length: n for length, n in counts.items() if n}
    return reduce_by_dominance(counts, capacity) + best_fit(counts, capacity)


def pack(
    pieces: DataFrame, capacity: int = CAPACITY, order: Sequence[str] = ("id", "piece", "start", "ids_crc32")
) -> DataFrame:
    """Adds ``sequence_id`` and ``offset`` to rows with a ``length`` of 1 to ``capacity``.

    The pieces must come from stored rows, for they are read three times.
    """
    counts = {r["length"]: r["n"] for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    if any(not 1 <= length <= capacity for length in counts):
        raise ValueError(f"every length must be from 1 to {capacity}")
    total = sum(counts.values())
    by_length = sorted(counts)
    ends = np.cumsum([0] + [counts.get(length, 0) for length in range(capacity + 1)])

    # Runs as intervals of the places that the pieces have when ordered by length.
    intervals = []
    used = dict.fromkeys(by_length, 0)
    sequence = 0
    for run in plan(counts, capacity):
        offset = 0
        for length, each in run.holds.items():
            intervals.append((int(ends[length]) + used[length], sequence, each, offset, length))
            used[length] += run.times * each
            offset += each * length
        sequence += run.times
    assert used == counts
    table = np.array(sorted(intervals), np.int64).reshape(-1, 5)

    # Pieces of one length are numbered in two steps, so that a frequent length is spread over many groups.
    parts = isqrt(total) + 1
    keyed = pieces.withColumn("_part", F.pmod(F.xxhash64(*order), F.lit(parts)))
    sizes = keyed.groupBy("length", "_part").agg(F.count("*").alias("_n"))
    ahead = F.sum("_n").over(Window.partitionBy("length").orderBy("_part")) - F.col("_n")
    sizes = sizes.select("length", "_part", ahead.alias("_ahead"))
    own = F.row_number().over(Window.partitionBy("length", "_part").orderBy(*order)) - 1
    numbered = keyed.withColumn("_own", own).join(sizes, ["length", "_part"])
    placed = numbered.withColumn("_place", F.col("_own") + F.col("_ahead"))

    def look_up(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            lengths, place = (batch[c].to_numpy(zero_copy_only=False).astype(np.int64) for c in ("length", "_place"))
            place += ends[lengths]
            at = np.searchsorted(table[:, 0], place, "right") - 1
            start, base, each, offset, length = table[at].T
            k = place - start
            found = [base + k // each, offset + k % each * length]
            kept = [i for i, name in enumerate(batch.schema.names) if name != "_place"]
            columns = [batch.column(i) for i in kept] + list(map(pa.array, found))
            names = [batch.schema.names[i] for i in kept] + ["sequence_id", "offset"]
            yield pa.RecordBatch.from_arrays(columns, names=names)

    kept = [f"`{c}`" for c in pieces.columns]
    schema = ", ".join(f"`{c}` {t}" for c, t in pieces.dtypes)
    return placed.select(*kept, "_place").mapInArrow(look_up, f"{schema}, sequence_id bigint, offset bigint")


def pack_documents(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows (id, piece, start, length, ids_crc32, sequence_id, offset), one for each piece."""
    return pack(saved(token_pieces(docs, tokenizer, capacity, id_col, text_col), "pieces"), capacity)
