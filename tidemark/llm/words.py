"""Words of many texts at once, as positions in one array of bytes."""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from dataclasses import dataclass
from functools import cache

import numpy as np

#: White space between words: blank, tab, line feed, vertical tab, form feed, carriage return.
BLANKS = (32, *range(9, 14))
#: Bytes handled together.
AT_ONCE = 500_000

_IS_BLANK = np.zeros(256, bool)
_IS_BLANK[list(BLANKS)] = True
_LOWER = np.arange(256, dtype=np.uint8)
_LOWER[65:91] += 32


@dataclass
class Words:
    """``data`` in lower case (A-Z only), ``raw`` as given; word i is [start[i], end[i]) and belongs to text[i]."""

    raw: np.ndarray
    data: np.ndarray
    start: np.ndarray
    end: np.ndarray
    text: np.ndarray


def split_words(texts: list[bytes]) -> Words:
    raw = np.frombuffer(b" ".join(texts) + b" ", np.uint8)
    blank = _IS_BLANK[raw]
    edge = np.flatnonzero(blank[1:] != blank[:-1]) + 1
    if not blank[0]:
        edge = np.concatenate([[0], edge])
    start, end = edge[0::2], edge[1::2]
    lengths = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    text = np.searchsorted(np.cumsum(lengths), start, "right")
    return Words(raw, _LOWER[raw], start, end, text)


def grouped(items: Iterable[tuple[object, bytes]], at_once: int = AT_ONCE) -> Iterator[list[tuple[object, bytes]]]:
    """Keyed texts in groups of about ``at_once`` bytes."""
    group, size = [], 0
    for key, text in items:
        if group and size + len(text) > at_once:
            yield group
            group, size = [], 0
        group.append((key, text))
        size += len(text)
    if group:
        yield group


def sections(text: bytes, most: int = AT_ONCE) -> Iterator[bytes]:
    """A long text in parts that end where a word ends; at least one part."""
    start = 0
    while len(text) - start > most:
        cut = min((at for at in (text.find(bytes([b]), start + most) for b in BLANKS) if at >= 0), default=-1)
        if cut < 0:
            break
        yield text[start:cut]
        start = cut
    yield text[start:]


def mixed(values: np.ndarray) -> np.ndarray:
    """Scrambles 64-bit numbers one to one (the finalizer of SplitMix64, a fixed function)."""
    x = values.astype(np.uint64)
    x ^= x >> np.uint64(30)
    x *= np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


_ODD = 0x9E3779B97F4A7C15


@cache
def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """The first n powers of an odd number and of its inverse, modulo 2**64."""

    def run(base: int) -> np.ndarray:
        out = np.full(n, base, np.uint64)
        out[0] = 1
        return np.multiply.accumulate(out)

    return run(_ODD), run(pow(_ODD, -1, 1 << 64))
