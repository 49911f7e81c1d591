"""The order of all suffixes of a byte string by induced sorting, with queues that go to disk.

A suffix is of type S if it is smaller than the one that begins a byte later, else L. The S suffixes after an L suffix
(leftmost S) split the string. Once they are in order, all others follow: a suffix is put into the queue of its first
byte when the suffix a byte later is read, and the queues, read by byte and then by age, are the priority queue of
the method. The leftmost S suffixes are ordered the same way: induction sorts the parts between them, equal parts get
equal names, and the string of names is a third as long at most half. Its suffixes are ordered by doubling the number
of names looked at, for names are too many for a queue each; names that reach over ``depth`` bytes
are enough, because nobody asks for longer common prefixes.

A queue holds positions in memory up to a limit and then in an unnamed temporary file of the task, so
that a string may be far longer than what its positions take in memory.
"""

from __future__ import annotations

import tempfile
from collections.abc import Iterator

import numpy as np

#: Positions that all queues of a string keep in memory.
IN_MEMORY = 8_000_000
CHUNK = 1 << 18


class Store:
    """Counts what queues keep in memory, and has the file they go to beyond the limit."""

    def __init__(self, limit: int = IN_MEMORY) -> None:
        self.limit = limit
        self.kept = 0
        self._file = None

    def write(self, values: np.ndarray) -> int:
        if self._file is None:
            self._file = tempfile.TemporaryFile()
        at = self._file.seek(0, 2)
        self._file.write(values.tobytes())
        return at

    def read(self, at: int, n: int) -> np.ndarray:
        self._file.seek(at)
        return np.frombuffer(self._file.read(8 * n), np.int64)

    def close(self) -> None:
        if self._file is not None:
            self._file.close()


class Queue:
    """Positions, first in first out; may be read more than once and in either direction."""

    def __init__(self, store: Store) -> None:
        self._store = store
        self._parts: list[np.ndarray | tuple[int, int]] = []

    def put(self, values: np.ndarray) -> None:
        if not len(values):
            return
        if self._store.kept + len(values) > self._store.limit:
            self._parts.append((self._store.write(values), len(values)))
        else:
            self._store.kept += len(values)
            self._parts.append(values)

    def _part(self, i: int) -> np.ndarray:
        part = self._parts[i]
        return part if isinstance(part, np.ndarray) else self._store.read(*part)

    def _joined(self, first: int, step: int) -> tuple[np.ndarray, int]:
        """Parts from one on, or back, together about CHUNK positions; and the part after them."""
        parts, size = [], 0
        while 0 <= first < len(self._parts) and size < CHUNK:
            parts.append(self._part(first)[::step])
            size += len(parts[-1])
            first += step
        return np.concatenate(parts), first

    def __iter__(self) -> Iterator[np.ndarray]:
        """All positions, those included that are put in meanwhile."""
        i = 0
        while i < len(self._parts):
            part, i = self._joined(i, 1)
            yield part

    def backwards(self) -> Iterator[np.ndarray]:
        i = len(self._parts) - 1
        while i >= 0:
            part, i = self._joined(i, -1)
            yield part


def types(text: np.ndarray) -> np.ndarray:
    """Whether each suffix is of type S; the last is not, for the empty suffix is the smallest."""
    n = len(text)
    ends = np.flatnonzero(np.append(text[1:] != text[:-1], True))
    # A run of equal bytes has the type of its last one.
    rises = np.append(text[ends[:-1] + 1] > text[ends[:-1]], False)
    return np.repeat(rises, np.diff(np.concatenate([[-1], ends])))[:n]


def _deal(queues: list[Queue], text: np.ndarray, positions: np.ndarray) -> None:
    """Put each position into the queue of its byte, in the given order."""
    if not len(positions):
        return
    first = text[positions]
    order = np.argsort(first, kind="stable")
    positions, first = positions[order], first[order]
    cuts = np.flatnonzero(first[1:] != first[:-1]) + 1
    for part in np.split(positions, cuts):
        queues[int(text[part[0]])].put(part)


def _chunks(values: np.ndarray) -> Iterator[np.ndarray]:
    for start in range(0, len(values), CHUNK):
        yield values[start : start + CHUNK]


def induce(text: np.ndarray, small: np.ndarray, seeds: np.ndarray, store: Store) -> tuple[list[Queue], list[Queue]]:
    """From leftmost S suffixes in order: the L suffixes of each first byte in order, the S suffixes in reverse."""
    larger, smaller = [Queue(store) for _ in range(256)], [Queue(store) for _ in range(256)]
    bounds = np.searchsorted(text[seeds], np.arange(257)) if len(seeds) else np.zeros(257, np.int64)

    def before(part: np.ndarray, wanted: bool) -> np.ndarray:
        part = part[part > 0] - 1
        return part[small[part] == wanted]

    if len(text):
        larger[int(text[-1])].put(np.array([len(text) - 1], np.int64))
    for byte in range(256):
        for part in larger[byte]:
            _deal(larger, text, before(part, False))
        for part in _chunks(seeds[bounds[byte] : bounds[byte + 1]]):
            _deal(larger, text, before(part, False))
    for byte in range(255, -1, -1):
        for part in smaller[byte]:
            _deal(smaller, text, before(part, True))
        for part in larger[byte].backwards():
            _deal(smaller, text, before(part, True))
    return larger, smaller


def _ranks(different: np.ndarray) -> np.ndarray:
    return np.cumsum(different, dtype=np.int64) - 1


def _order_of_seeds(text: np.ndarray, small: np.ndarray, depth: int, store: Store) -> np.ndarray:
    """The leftmost S positions in the order of their suffixes, as far as ``depth`` bytes tell."""
    left = np.flatnonzero(small[1:] & ~small[:-1]) + 1
    if len(left) < 2:
        return left
    first = left[np.argsort(text[left], kind="stable")]
    _, smaller = induce(text, small, first, store)
    is_left = np.zeros(len(text), bool)
    is_left[left] = True
    parts = [part[is_left[part]] for byte in range(256) for part in smaller[byte].backwards()]
    ordered = np.concatenate(parts)
    # Neighbours in this order with equal parts up to the next leftmost S get one name.
    number = np.zeros(len(text), np.int64)
    number[left] = np.arange(len(left))
    after = np.append(left[1:], len(text))
    lengths = after - left + 1
    at = number[ordered]
    same = np.zeros(len(ordered), bool)
    same[1:] = (lengths[at[1:]] == lengths[at[:-1]]) & (at[1:] != len(left) - 1) & (at[:-1] != len(left) - 1)
    same[same] = _equal(text, ordered[:-1][same[1:]], ordered[1:][same[1:]], lengths[at[1:]][same[1:]])
    rank = np.empty(len(left), np.int64)
    rank[at] = _ranks(~same)
    # Double the names looked at until all differ or what they cover is deep enough.
    step, least = 1, left
    while rank.max() < len(left) - 1:
        reach = np.append(left, len(text))[np.minimum(np.arange(len(left)) + step, len(left))] - least
        if reach[: max(1, len(left) - step)].min() >= depth:
            break
        following = np.full(len(left), -1, np.int64)
        following[: len(left) - step] = rank[step:]
        order = np.lexsort((following, rank))
        fresh = np.ones(len(order), bool)
        fresh[1:] = (rank[order[1:]] != rank[order[:-1]]) | (following[order[1:]] != following[order[:-1]])
        rank = np.empty(len(left), np.int64)
        rank[order] = _ranks(fresh)
        step *= 2
        if step >= len(left):
            break
    return left[np.argsort(rank, kind="stable")]


def _equal(text: np.ndarray, a: np.ndarray, b: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Whether the ``length`` bytes from each a equal those from each b."""
    out = np.ones(len(a), bool)
    at = np.arange(len(a))
    offset = 0
    while len(at):
        alike = text[np.minimum(a[at] + offset, len(text) - 1)] == text[np.minimum(b[at] + offset, len(text) - 1)]
        out[at[~alike]] = False
        offset += 1
        at = at[alike & (length[at] > offset)]
    return out


def suffix_order(text: np.ndarray, depth: int, limit: int = IN_MEMORY) -> Iterator[np.ndarray]:
    """All positions, in chunks, in the order of their suffixes.

    Suffixes that agree in ``depth`` bytes stand together.
    """
    if not len(text):
        return
    store = Store(limit)
    try:
        small = types(text)
        seeds = _order_of_seeds(text, small, depth, store)
        larger, smaller = induce(text, small, seeds, store)
        for byte in range(256):
            yield from larger[byte]
            yield from smaller[byte].backwards()
    finally:
        store.close()


class Prefixes:
    """Common prefixes of suffixes, up to ``most`` bytes, eight bytes at a time."""

    def __init__(self, text: np.ndarray, most: int) -> None:
        padded = np.concatenate([text, np.zeros(most + 16, np.uint8)])
        self._length, self._most = len(text), most
        self._words = np.ndarray(len(padded) - 7, "<u8", padded, strides=(1,))

    def __call__(self, order: np.ndarray) -> np.ndarray:
        """For neighbours in an order of positions, the length of what they share."""
        a, b = order[:-1], order[1:]
        out = np.full(len(a), self._most, np.int64)
        at = np.arange(len(a))
        for done in range(0, self._most, 8):
            differing = self._words[a[at] + done] ^ self._words[b[at] + done]
            ends = differing != 0
            if ends.any():
                first = differing[ends]
                # Bits below the lowest one that differs, in whole bytes.
                below = (first & (~first + np.uint64(1))) - np.uint64(1)
                out[at[ends]] = done + np.bitwise_count(below).astype(np.int64) // 8
                at = at[~ends]
                if not len(at):
                    break
        # What lies behind the end is no common prefix.
        return np.minimum(np.minimum(out, self._most), self._length - np.maximum(a, b))
