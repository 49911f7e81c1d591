"""Encoding and decoding with merge-type SentencePiece vocabularies.

A text starts as single characters. All adjacent pairs whose concatenation is a piece stand in an agenda; the pair
with the best score, and of these the leftmost, is merged, which takes out its neighbours' pairs and puts in new
ones, until the agenda is empty. Characters outside the vocabulary become byte pieces.

Where no piece has a space mark after another character, no merge crosses the start of a word, so words
are encoded one by one and frequent ones remembered. The agendas of short words of one length are rows of
a matrix and are worked off together; longer words use a heap.

Null counts as an empty text, which has no ids. Other columns are not looked at; rows may repeat.
"""

from __future__ import annotations

import hashlib
import heapq
import re
from collections.abc import Iterable, Iterator, Sequence
from itertools import chain, pairwise

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_parts, texts

SPACE = "▁"
#: Longer words are encoded with a heap.
LONG_WORD = 40
#: Words remembered between batches; beyond that the memory starts anew.
REMEMBERED = 400_000
#: Characters encoded at a time.
AT_ONCE = 3_000_000
_WORD = re.compile(f"{SPACE}*[^{SPACE}]+|{SPACE}+")
#: The first space of a run of spaces; the section after it must not be empty, for then it would have no mark.
_CUT = re.compile(f"(?<=[^ {SPACE}]) (?!\\Z)")
_NEVER = np.iinfo(np.int32).max


class Merges:
    """The pairs of symbols that make a piece, and the order of the pieces."""

    def __init__(self, library: sentencepiece.SentencePieceProcessor) -> None:
        size = library.get_piece_size()
        normal = [
            i for i in range(size)
            if not (library.is_control(i) or library.is_unknown(i) or library.is_byte(i) or library.is_unused(i))
        ]
        self.pieces = {library.id_to_piece(i): i for i in normal}
        if any(SPACE in piece.lstrip(SPACE) for piece in self.pieces):
            raise ValueError("pieces that reach over the start of a word are not supported")
        self.bytes = [library.piece_to_id(f"<0x{b:02X}>") for b in range(256)]
        if any(not library.is_byte(i) for i in self.bytes):
            raise ValueError("a vocabulary with byte pieces is needed")
        scores = {i: library.get_score(i) for i in normal}
        order = {s: k for k, s in enumerate(sorted(set(scores.values()), reverse=True))}
        # Characters that are no piece themselves may still be part of one.
        self.symbols = dict(self.pieces)
        for piece in self.pieces:
            for character in piece:
                self.symbols.setdefault(character, size + len(self.symbols) - len(self.pieces))
        self.none = size + len(self.symbols)
        self.rank = np.full(self.none + 1, _NEVER, np.int32)
        for i, score in scores.items():
            self.rank[i] = order[score]
        merged = {}
        for piece, i in self.pieces.items():
            for cut in range(1, len(piece)):
                left, right = self.symbols.get(piece[:cut]), self.symbols.get(piece[cut:])
                if left is not None and right is not None:
                    merged[left, right] = i
        self.merged = merged
        self._fill({left << 32 | right: i for (left, right), i in merged.items()})

    def _fill(self, pairs: dict[int, int]) -> None:
        """A table with open addressing, kept so empty that few probes find any pair."""
        self._bits = max(8, (len(pairs) * 8).bit_length())
        self._keys = np.full(1 << self._bits, -1, np.int64)
        self._values = np.full(1 << self._bits, self.none, np.int64)
        self._probes = 1
        for key, value in pairs.items():
            slot, probes = int(self._slots(np.array([key]))[0]), 1
            while self._keys[slot] >= 0:
                slot, probes = (slot + 1) & (1 << self._bits) - 1, probes + 1
            self._keys[slot], self._values[slot] = key, value
            self._probes = max(self._probes, probes)

    def _slots(self, keys: np.ndarray) -> np.ndarray:
        return ((keys.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self._bits)).astype(np.int64)

    def of(self, left: np.ndarray, right: np.ndarray) -> np.ndarray:
        """The piece that each pair makes, or ``none``."""
        keys = left.astype(np.int64) << 32 | right
        slots = self._slots(keys)
        there = self._keys[slots]
        found = np.where(there == keys, self._values[slots], self.none)
        open_ = np.flatnonzero((there != keys) & (there >= 0))
        for _ in range(self._probes - 1):
            if not len(open_):
                break
            slots[open_] = (slots[open_] + 1) & ((1 << self._bits) - 1)
            there = self._keys[slots[open_]]
            hit = there == keys[open_]
            found[open_[hit]] = self._values[slots[open_[hit]]]
            open_ = open_[~hit & (there >= 0)]
        return found


class PieceCodec:
    """Ids by the agenda; with ``check``, each newly encoded word is held against the library's ids."""

    def __init__(self, model: str, check: bool = True) -> None:
        self._check = check
        self.library = sentencepiece.SentencePieceProcessor(model_file=model)
        self.merges = Merges(self.library)
        self._lengths = {i: len(piece) for piece, i in self.merges.pieces.items()}
        if not self.library.normalize("a").startswith(SPACE):
            raise ValueError("a vocabulary that puts a space mark before a text is needed")
        self._numbers: dict[str, int] = {}
        self._flat = np.empty(0, np.int32)
        self._start = np.zeros(1, np.int64)

    def words(self, text: str) -> list[str]:
        """The normalised text in words, each with the space marks before it."""
        return _WORD.findall(self.library.normalize(text))

    def _split(self, batch: Sequence[str]) -> tuple[pa.Array, np.ndarray]:
        """The words of all texts one after another, and where each text's words end."""
        parted = []
        for text in batch:
            text = self.library.normalize(text)
            if SPACE + SPACE in text or text.endswith(SPACE):
                parted.append(" " + " ".join(_WORD.findall(text)))
            else:  # the words begin where the marks are
                parted.append(text.replace(SPACE, " " + SPACE))
        lists = pc.split_pattern(pa.array(parted, pa.large_string()), " ")
        words, bounds = lists.flatten(), lists.offsets.to_numpy().astype(np.int64)
        # Nothing stands before the first blank of a text.
        real = np.ones(len(words), bool)
        real[bounds[:-1]] = False
        return words.filter(pa.array(real)), bounds[1:] - np.arange(1, len(bounds))

    def _learn(self, words: list[str]) -> np.ndarray:
        """The numbers of these different words in memory."""
        if len(self._numbers) > REMEMBERED:
            self._numbers, self._flat, self._start = {}, np.empty(0, np.int32), np.zeros(1, np.int64)
        numbers = self._numbers
        new = sorted((word for word in words if word not in numbers), key=len)
        ids = self._encode_words(new)
        if self._check and ids != self._by_library(new):
            raise ValueError("the ids differ from those of the sentencepiece library")
        lengths = np.fromiter(map(len, ids), np.int64, len(ids))
        more = np.fromiter(chain.from_iterable(ids), np.int32, int(lengths.sum()))
        numbers.update(zip(new, range(len(numbers), len(numbers) + len(new)), strict=True))
        self._start = np.concatenate([self._start, self._start[-1] + np.cumsum(lengths)])
        self._flat = np.concatenate([self._flat, more])
        return np.fromiter(map(numbers.__getitem__, words), np.int64, len(words))

    def encode_flat(self, batch: Sequence[str]) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts one after another, and where those of each text begin, with the end of the last."""
        words, ends = self._split(batch)
        coded = words.dictionary_encode()
        numbers = self._learn(coded.dictionary.to_pylist())[coded.indices.to_numpy()]
        lengths = self._start[numbers + 1] - self._start[numbers]
        reach = np.concatenate([[0], np.cumsum(lengths)])
        at = np.arange(reach[-1]) + np.repeat(self._start[numbers] - reach[:-1], lengths)
        return self._flat[at], reach[np.concatenate([[0], ends]).astype(np.int64)]

    def encode(self, batch: Sequence[str]) -> list[list[int]]:
        """The ids of each text."""
        ids, bounds = self.encode_flat(batch)
        return [ids[a:b].tolist() for a, b in pairwise(bounds.tolist())]

    def _by_library(self, words: list[str]) -> list[tuple[int, ...]]:
        """The first mark of a word is the one that the library puts before a text."""
        found = list(map(tuple, self.library.encode([word[1:] for word in words], num_threads=1)))
        if SPACE in words:  # an empty text gets no mark
            found[words.index(SPACE)] = (self.merges.pieces[SPACE],)
        return found

    def _encode_words(self, words: list[str]) -> list[tuple[int, ...]]:
        out: list[tuple[int, ...]] = [()] * len(words)
        by_length: dict[int, list[int]] = {}
        for i, word in enumerate(words):
            by_length.setdefault(len(word), []).append(i)
        for length, members in by_length.items():
            if length > LONG_WORD:
                for i in members:
                    out[i] = self._agenda(words[i])
            else:
                for i, ids in zip(members, self._agendas([words[i] for i in members], length), strict=True):
                    out[i] = ids
        return out

    def _with_bytes(self, symbols: Iterable[int], word: str) -> tuple[int, ...]:
        """Piece ids; symbols outside the vocabulary are single characters and become byte pieces."""
        out: list[int] = []
        at = 0
        for symbol in symbols:
            if symbol in self._lengths:
                out.append(symbol)
                at += self._lengths[symbol]
            else:
                out.extend(self.merges.bytes[b] for b in word[at].encode())
                at += 1
        return tuple(out)

    def _agendas(self, words: list[str], length: int) -> list[tuple[int, ...]]:
        """Words of one length: each round merges the best pair of every word that has one."""
        merges = self.merges
        codes = np.frombuffer("".join(words).encode("utf-32-le"), np.uint32)
        kinds, inverse = np.unique(codes, return_inverse=True)
        symbol = np.array([merges.symbols.get(chr(c), merges.none) for c in kinds], np.int64)
        rows = symbol[inverse].reshape(len(words), length)
        out: list[tuple[int, ...]] = [()] * len(words)
        place = np.arange(len(words))
        ranks = merges.rank[merges.of(rows[:, :-1].ravel(), rows[:, 1:].ravel())].reshape(len(words), length - 1)

        def finish(which: np.ndarray) -> None:
            whole = (rows[which] < merges.none) & (merges.rank[np.minimum(rows[which], merges.none)] != _NEVER)
            ended = zip(place[which].tolist(), rows[which].tolist(), whole.all(1).tolist(), strict=True)
            for i, symbols, simple in ended:
                out[i] = tuple(symbols) if simple else self._with_bytes(symbols, words[i])

        while len(rows):
            if not ranks.shape[1]:
                finish(np.arange(len(rows)))
                break
            at = ranks.argmin(1)
            every = np.arange(len(rows))
            ended = ranks[every, at] == _NEVER
            if ended.any():
                finish(np.flatnonzero(ended))
                going = ~ended
                rows, ranks, place, at = rows[going], ranks[going], place[going], at[going]
                every = np.arange(len(rows))
                if not len(rows):
                    break
            piece = merges.of(rows[every, at], rows[every, at + 1])
            width = rows.shape[1] - 1
            column = np.arange(width)
            # The symbol after the pair's left one goes; so does the pair itself.
            rows = np.take_along_axis(rows, column + (column > at[:, None]), 1)
            rows[every, at] = piece
            column = column[: width - 1]
            ranks = np.take_along_axis(ranks, column + (column >= at[:, None]), 1)
            if width > 1:
                has = at > 0
                ranks[every[has], at[has] - 1] = merges.rank[merges.of(rows[every[has], at[has] - 1], piece[has])]
                has = at < width - 1
                ranks[every[has], at[has]] = merges.rank[merges.of(piece[has], rows[every[has], at[has] + 1])]
        return out

    def _agenda(self, word: str) -> tuple[int, ...]:
        """One word of any length, with a heap of (rank, place)."""
        merges = self.merges
        symbols = [merges.symbols.get(c, merges.none) for c in word]
        after = list(range(1, len(word) + 1))
        before = list(range(-1, len(word) - 1))
        heap: list[tuple[int, int, int, int]] = []

        def put(left: int) -> None:
            right = after[left]
            if right < len(symbols):
                piece = merges.merged.get((symbols[left], symbols[right]))
                if piece is not None:
                    heapq.heappush(heap, (int(merges.rank[piece]), left, symbols[left], symbols[right]))

        for i in range(len(word) - 1):
            put(i)
        while heap:
            _, left, a, b = heapq.heappop(heap)
            right = after[left]
            if symbols[left] != a or right >= len(symbols) or symbols[right] != b:
                continue  # one of the two was merged meanwhile
            symbols[left], symbols[right] = merges.merged[a, b], -1
            after[left] = after[right]
            if after[right] < len(symbols):
                before[after[right]] = left
            put(left)
            if before[left] >= 0:
                put(before[left])
        return self._with_bytes((s for s in symbols if s >= 0), word)

    def decode(self, batch: Sequence[Sequence[int]]) -> list[str]:
        return self.library.decode(list(batch))


def _joined(ids: np.ndarray, bounds: np.ndarray) -> Iterator[bytes | pa.Buffer]:
    """The ids of each text in decimal digits, joined by commas."""
    if len(ids) > 100_000_000:  # too many for one Arrow array of strings
        yield from (",".join(map(str, ids[a:b].tolist())).encode() for a, b in pairwise(bounds.tolist()))
        return
    lists = pa.ListArray.from_arrays(pa.array(bounds, pa.int32()), pa.array(ids).cast(pa.string()))
    yield from (text.as_buffer() for text in pc.binary_join(lists, ","))


def sections(text: str, most: int) -> Iterator[str]:
    """A text in sections that give its ids one after another: it is cut at spaces, each of which is dropped.

    The mark that every section gets in front stands for that space.
    """
    start = 0
    while len(text) - start > most:
        cut = _CUT.search(text, start + most)
        if not cut:
            break
        yield text[start : cut.start()]
        start = cut.end()
    yield text[start:]


def encode_documents(
    docs: DataFrame, model: str, id_col: str = "doc_id", text_col: str = "text", at_once: int = AT_ONCE
) -> DataFrame:
    """Rows (id, n_tokens, ids_sha256, decoded_sha256), one for each row of ``docs``.

    ``model`` is a path that exists on every executor. Sections of long texts are encoded one after another, so
    that memory holds about ``at_once`` characters and the words and ids made of them.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = pa.schema(
            [("id", pa.int64()), ("n_tokens", pa.int64()), ("ids_sha256", pa.string()), ("decoded_sha256", pa.string())]
        )
        codec = PieceCodec(model)

        def jobs() -> Iterator[tuple[int | None, int, str]]:
            """(id, number of the section, section)."""
            for batch in batches:
                for key, text in zip(batch["id"].to_pylist(), texts(batch["text"]), strict=True):
                    yield from ((key, k, part) for k, part in enumerate(sections(text, at_once)))

        def groups() -> Iterator[list[tuple[int | None, int, str]]]:
            group, size = [], 0
            for job in jobs():
                if group and size + len(job[2]) > at_once:
                    yield group
                    group, size = [], 0
                group.append(job)
                size += len(job[2])
            if group:
                yield group

        def rows() -> Iterator[tuple]:
            open_: list | None = None
            for group in groups():
                flat, bounds = codec.encode_flat([part for _, _, part in group])
                digits = _joined(flat, bounds)
                for (key, k, _), begin, end, joined in zip(group, bounds[:-1], bounds[1:], digits, strict=True):
                    text = codec.library.decode(flat[begin:end].tolist())
                    n = int(end - begin)
                    if k == 0:
                        if open_:
                            yield open_[0], open_[1], open_[2].hexdigest(), open_[3].hexdigest()
                        open_ = [key, 0, hashlib.sha256(), hashlib.sha256()]
                    if open_[1] and n:
                        open_[2].update(b",")
                    open_[1] += n
                    open_[2].update(joined)
                    open_[3].update(((" " if k else "") + text).encode())
            if open_:
                yield open_[0], open_[1], open_[2].hexdigest(), open_[3].hexdigest()

        yield from in_parts(rows(), out)

    rows = docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))
    return rows.mapInArrow(run, "id bigint, n_tokens bigint, ids_sha256 string, decoded_sha256 string")
