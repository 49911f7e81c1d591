"""Sets of word shingles, and the keys that similar sets share.

The universe of shingles is cut by a hash into segments, as many as fit the size of a set. Two sets of Jaccard
similarity d or more with sizes a and b differ in at most (a + b) * (1 - d) / (1 + d) elements, so
if the segments outnumber these, some segment is equal (pigeonhole). A segment taken with its one-deletion
neighbourhood still meets its counterpart when one element differs and so is worth two.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache
from math import ceil, exp, floor, sqrt

import numpy as np

from tidemark.llm.words import Words, grouped, mixed, powers, sections, split_words

#: Similarity in hundredths, so that the test is exact.
PERCENT = 85
WORDS = 4
#: Bytes of a word beyond which its hash is a cryptographic one.
LONG_WORD = 256


def word_hashes(words: Words) -> np.ndarray:
    """A 64-bit hash of each word: a polynomial in its bytes, from running sums, then scrambled.

    Modulo a power of two such polynomials agree for certain pairs of long words, whatever the base, so long words get
    a cryptographic hash.
    """
    n = 1 << max(16, int(len(words.data)).bit_length())
    up, down = powers(n)
    terms = _BYTES[words.data] * up[: len(words.data)]
    sums = np.concatenate([[np.uint64(0)], np.cumsum(terms, dtype=np.uint64)])
    values = (sums[words.end] - sums[words.start]) * down[words.start]
    hashes = mixed(values + (words.end - words.start).astype(np.uint64))
    for i in np.flatnonzero(words.end - words.start > LONG_WORD).tolist():
        digest = hashlib.blake2b(words.data[words.start[i] : words.end[i]].tobytes(), digest_size=8).digest()
        hashes[i] = int.from_bytes(digest, "little")
    return hashes


_BYTES = mixed(np.arange(1, 257))


def shingle_sets(
    items: Iterable[tuple[object, bytes]], n_words: int = WORDS, seed: int = 0
) -> Iterator[tuple[object, np.ndarray]]:
    """Each text with the sorted different hashes of its shingles.

    A text with fewer words has one shingle, the whole sequence; one without words has none. Long texts are
    read in sections, whose last words are carried into the next.
    """

    def parts() -> Iterator[tuple[tuple[object, bool], bytes]]:
        for key, text in items:
            open_ = None
            for part in sections(text):
                if open_ is not None:
                    yield (key, False), open_
                open_ = part
            yield (key, True), open_

    salt = np.uint64(0x632BE59BD9B4E019 * (seed + 1) & (1 << 64) - 1)
    carried = np.empty(0, np.uint64)
    rest: list[np.ndarray] = []
    for group in grouped(parts()):
        words = split_words([part for _, part in group])
        hashes = word_hashes(words)
        bounds = np.searchsorted(words.text, np.arange(len(group) + 1))
        for i, ((key, last), _) in enumerate(group):
            own = hashes[bounds[i] : bounds[i + 1]]
            if len(carried):
                own = np.concatenate([carried, own])
            if len(own) >= n_words:
                sets = np.unique(_joined(own, n_words, salt))
            elif last and not rest and len(own):
                sets = _joined(own, len(own), salt)
            else:
                sets = np.empty(0, np.uint64)
            if not last:
                carried = own[len(own) - min(len(own), n_words - 1) :]
                if len(sets):
                    rest = [np.unique(np.concatenate([*rest, sets]))]
                continue
            if rest:
                sets = np.unique(np.concatenate([*rest, sets]))
            carried, rest = np.empty(0, np.uint64), []
            yield key, sets


def _joined(words: np.ndarray, n: int, salt: np.uint64) -> np.ndarray:
    """A hash of every n words in a row."""
    out = np.full(len(words) - n + 1, salt ^ np.uint64(n), np.uint64)
    for k in range(n):
        out = mixed(out + words[k : len(words) - n + 1 + k])
    return out


def set_hashes(shingles: np.ndarray) -> tuple[int, int]:
    """128 bits that know a set: two sums over its elements, as signed numbers."""
    first = mixed(shingles ^ np.uint64(0xA5A5A5A5A5A5A5A5)).sum(dtype=np.uint64)
    second = mixed(shingles + np.uint64(0x5BD1E995)).sum(dtype=np.uint64)
    ends = mixed(np.array([first + np.uint64(len(shingles)), second], np.uint64)).view(np.int64)
    return int(ends[0]), int(ends[1])


@dataclass(frozen=True)
class Plan:
    """``segments`` of which the first ``deleted`` are taken with their neighbourhoods.

    ``spare`` equal segments remain beyond the one that the pigeonhole needs; so many may be left out.
    """

    segments: int
    deleted: int
    spare: int


def largest_difference(a: int, b: int, percent: int = PERCENT) -> int:
    """Elements in which two linked sets of these sizes may differ at most."""
    shared = -(-percent * (a + b) // (100 + percent))
    return a + b - 2 * shared


def _next(low: int, percent: int) -> int:
    """The first size of the band after the one that begins with ``low``: linked sets lie in one band or in two
    neighbouring ones."""
    return low * 100 // percent + 1


@cache
def bounds(percent: int, bands: int = 400) -> list[int]:
    """The first size of each band."""
    out = [1]
    while len(out) <= bands and out[-1] < 1 << 40:
        out.append(_next(out[-1], percent))
    return out


@cache
def allocate(band: int, percent: int) -> Plan:
    """The cheapest plan for pairs whose larger set is in this band.

    Cost counts the keys of a set, and more for segments so short that many sets have none or the same elements there.
    """
    low, high = bounds(percent)[band], bounds(percent)[band + 1] - 1
    # The bound grows with both sizes but for rounding, so the largest pairs show the most.
    worst = max(largest_difference(a, high, percent) for a in range(max(1, high - 300), high + 1))
    size = (low + high) / 2
    need = worst + 1
    least = ceil(need / 2)
    halves = Plan(least, need - least, 0)
    plain = need
    for _ in range(20):
        empty = plain * exp(-size / plain)
        plain = need + ceil(empty + 4 * sqrt(empty) + 0.05 * worst)
    wholes = Plan(plain, 0, plain - need)

    def cost(plan: Plan) -> float:
        each = size / plan.segments
        return plan.segments + plan.deleted * each + 20 * plan.segments * exp(-each)

    return min(halves, wholes, key=cost)


def keys(shingles: np.ndarray, percent: int = PERCENT) -> tuple[np.ndarray, np.ndarray]:
    """(key, spare) pairs of a set: sets that link share a key.

    A set has keys in its own band and in the next, where it may be the smaller of a pair. Empty segments are left
    out if there are spares for all of them; what spares are left stands beside each key of a whole
    segment (-1: the key may not be left out).
    """
    if not len(shingles):
        return np.empty(0, np.int64), np.empty(0, np.int32)
    found, spares = [], []
    own = int(np.searchsorted(bounds(percent), len(shingles), "right")) - 1
    for band in (own, own + 1):
        plan = allocate(band, percent)
        element = mixed(shingles ^ np.uint64(band + 1))
        segment = (element % np.uint64(plan.segments)).astype(np.int64)
        value = mixed(element)
        order = np.argsort(segment, kind="stable")
        sums = np.concatenate([[np.uint64(0)], np.cumsum(value[order], dtype=np.uint64)])
        ends = np.searchsorted(segment[order], np.arange(plan.segments + 1))
        totals = sums[ends[1:]] - sums[ends[:-1]]
        names = mixed(np.arange(plan.segments, dtype=np.uint64) + np.uint64(band << 32 | 1 << 62))
        whole = mixed(totals ^ names)
        empty = ends[1:] == ends[:-1]
        n_empty = int(empty[plan.deleted :].sum())
        left = max(0, plan.spare - n_empty)
        emitted = np.ones(plan.segments, bool)
        if n_empty <= plan.spare:
            emitted[plan.deleted :] = ~empty[plan.deleted :]
        found.append(whole[emitted])
        spare = np.full(plan.segments, left, np.int32)
        spare[: plan.deleted] = -1
        spares.append(spare[emitted])
        if plan.deleted:
            near = segment < plan.deleted
            found.append(mixed((totals[segment[near]] - value[near]) ^ names[segment[near]]))
            spares.append(np.full(int(near.sum()), -1, np.int32))
    return np.concatenate(found).view(np.int64), np.concatenate(spares)


def sketch(shingles: np.ndarray, percent: int = PERCENT) -> bytes:
    """For each of some bits, whether an odd number of elements falls on it.

    Two sets differ in at least as many elements as their sketches in bits. The number of bits is a power of two
    and 16 times the largest difference, so that sketches of most sets that do not link differ in too many.
    """
    bits = 1 << max(6, (16 * largest_difference(len(shingles), len(shingles), percent)).bit_length())
    odd = np.bincount((mixed(shingles ^ np.uint64(0x3C6EF372)) % np.uint64(bits)).astype(np.int64), minlength=bits) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def folded(sketches: np.ndarray, words: int) -> np.ndarray:
    """Rows of 64-bit words, made as short as sketches with fewer bits."""
    while sketches.shape[1] > words:
        half = sketches.shape[1] // 2
        sketches = sketches[:, :half] ^ sketches[:, half:]
    return sketches


def may_link(
    a: np.ndarray, b: np.ndarray, size_a: np.ndarray, size_b: np.ndarray, percent: int = PERCENT
) -> np.ndarray:
    """For rows of equally long sketches, whether sizes and bits allow a link."""
    total = size_a + size_b
    most = total - 2 * -(-percent * total // (100 + percent))
    near = 100 * np.minimum(size_a, size_b) >= percent * np.maximum(size_a, size_b)
    return near & (np.bitwise_count(a ^ b).sum(-1) <= most)


def linked(a: np.ndarray, b: np.ndarray, percent: int = PERCENT) -> bool:
    """Whether two sets of sorted different elements are similar enough."""
    if min(len(a), len(b)) * 100 < percent * max(len(a), len(b)):
        return False
    both = np.concatenate([a, b])
    both.sort()
    shared = int((both[1:] == both[:-1]).sum())
    return 100 * shared >= percent * (len(a) + len(b) - shared)
