"""Passages that occur more than once, by suffix arrays of what may repeat.

Every string of LENGTH bytes has an anchor: of all shorter strings in it the one with the smallest hash, the leftmost of
equals. Equal strings have equal anchors at the same place, so strings need to be compared only under one
anchor. A run of places with one anchor, with the bytes that its strings cover, is a fragment.

1. Fragments are known by hashes. An anchor that occurs once has no repeated string and goes no further.
   An anchor whose fragments are all equal repeats in all of its strings.
2. Where the fragments of an anchor differ, their bytes are gathered, equal ones once, and dealt by anchor to shards.
   The suffixes of a shard are ordered by external induced sorting (``suffixes``); strings that repeat are neighbours
   with a common prefix of LENGTH or more.
3. What the repeated strings cover is joined to the documents.

Texts are judged as they are given; null counts as empty; a document's matches may be in itself, and rows that agree
in id and text are different documents. Texts shorter than LENGTH bytes have no strings. Other columns are not
looked at. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_parts, known_rows, saved, utf8
from tidemark.llm.suffixes import CHUNK, Prefixes, suffix_order
from tidemark.llm.words import grouped, mixed, powers

LENGTH = 200
#: Bytes of fragments that are sorted together; an anchor with more is sorted alone, with its queues on disk.
SHARD = 2_000_000
_OFFSET_BITS = 24
_KEY = "id bigint, n_chars bigint, mark bigint"


class Anchors:
    """The fragments of texts: for each, its text, first place, places, anchor's place, and two hashes."""

    def __init__(self, length: int = LENGTH) -> None:
        self.length = length
        self.gram = max(1, length // 4)
        self._bytes = mixed(np.arange(1, 257) ^ 0x5EED)

    def __call__(self, texts: list[bytes]) -> tuple[np.ndarray, ...]:
        data = np.frombuffer(b"".join(texts), np.uint8)
        lengths = np.fromiter(map(len, texts), np.int64, len(texts))
        places = len(data) - self.length + 1
        none = (np.empty(0, np.int64),) * 4 + (np.empty(0, np.uint64),) * 2
        if places <= 0:
            return none
        up, down = powers(1 << max(16, (len(data) + 1).bit_length()))
        sums = np.concatenate([[np.uint64(0)], np.cumsum(self._bytes[data] * up[: len(data)], dtype=np.uint64)])
        grams = len(data) - self.gram + 1
        hashes = mixed((sums[self.gram :] - sums[:grams]) * down[:grams])
        # The upper bits order by hash, the lower ones by place.
        low = np.uint64((1 << _OFFSET_BITS) - 1)
        least = _sliding_least((hashes & ~low) | np.arange(grams, dtype=np.uint64), self.length - self.gram + 1)
        ends = np.cumsum(lengths)
        text = np.searchsorted(ends, np.arange(places), "right")
        valid = np.arange(places) + self.length <= ends[np.minimum(text, len(texts) - 1)]
        anchor = (least & low).astype(np.int64)
        fresh = np.ones(places, bool)
        fresh[1:] = (anchor[1:] != anchor[:-1]) | (valid[1:] != valid[:-1]) | (text[1:] != text[:-1])
        starts = np.flatnonzero(fresh)
        counts = np.diff(np.append(starts, places))
        real = valid[starts]
        starts, counts = starts[real], counts[real]
        at = anchor[starts]
        stop = starts + counts + self.length - 1
        shape = mixed(((at - starts).astype(np.uint64) << np.uint64(32)) | counts.astype(np.uint64))
        content = mixed((sums[stop] - sums[starts]) * down[starts] ^ shape)
        begin = ends[text[starts]] - lengths[text[starts]]
        return text[starts], starts - begin, counts, at - begin, hashes[at], content


def _sliding_least(values: np.ndarray, width: int) -> np.ndarray:
    """The least of each ``width`` neighbours, from running minima of blocks in both directions."""
    n = len(values) - width + 1
    blocks = -(-len(values) // width)
    padded = np.full(blocks * width, np.iinfo(np.uint64).max, np.uint64)
    padded[: len(values)] = values
    grid = padded.reshape(blocks, width)
    forth = np.minimum.accumulate(grid, axis=1).ravel()
    back = np.minimum.accumulate(grid[:, ::-1], axis=1)[:, ::-1].ravel()
    return np.minimum(back[:n], forth[width - 1 : width - 1 + n])


def _sections(texts: Iterable[bytes], length: int, most: int) -> Iterator[tuple[tuple[int, int], bytes]]:
    """((number of the text, offset), part): parts overlap so that each string is in one part."""
    for i, text in enumerate(texts):
        for start in range(0, max(1, len(text) - length + 1), most):
            yield (i, start), text[start : start + most + length - 1]


def _fragments(texts: Iterable[bytes], anchors: Anchors, most: int = 500_000) -> Iterator[tuple[np.ndarray, ...]]:
    """As ``Anchors``, with numbers of texts and places in whole texts."""
    for group in grouped(_sections(texts, anchors.length, most), most):
        part, start, counts, at, anchor, content = anchors([text for _, text in group])
        number, offset = (np.array([key[k] for key, _ in group], np.int64) for k in (0, 1))
        places = start + offset[part], counts, at + offset[part]
        yield number[part], *places, anchor.view(np.int64), content.view(np.int64)


def fragments(rows: DataFrame, length: int) -> DataFrame:
    """Rows (id, n_chars, mark, anchor, content, places, left, ats): the different fragments of each text.

    ``ats`` has the anchor's places and ``left`` the bytes from a fragment's start to them. A text that repeats
    itself thus has a fragment once.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors = Anchors(length)
        names = ["id", "n_chars", "mark", "anchor", "content", "places", "left", "ats"]
        for batch in batches:
            for number, start, counts, at, anchor, content in _fragments(utf8(batch["text"]), anchors):
                order = np.lexsort((at, content, anchor, number))
                number, start, counts, at, anchor, content = (
                    x[order] for x in (number, start, counts, at, anchor, content)
                )
                fresh = np.ones(len(at), bool)
                fresh[1:] = False
                for x in (number, anchor, content):
                    fresh[1:] |= x[1:] != x[:-1]
                first = np.flatnonzero(fresh)
                ats = pa.ListArray.from_arrays(pa.array(np.append(first, len(at)), pa.int32()), pa.array(at))
                own = [batch[c].take(pa.array(number[first])) for c in ("id", "n_chars", "mark")]
                columns = [pa.array(x[first]) for x in (anchor, content, counts, at - start)]
                yield pa.RecordBatch.from_arrays([*own, *columns, ats], names=names)

    schema = f"{_KEY}, anchor bigint, content bigint, places bigint, left bigint, ats array<bigint>"
    return rows.mapInArrow(run, schema)


def repeated_places(fragments: list[bytes], counts: list[int], length: int, limit: int) -> list[np.ndarray]:
    """For different fragments with their numbers of occurrences, whether the string at each place repeats."""
    places = [len(f) - length + 1 for f in fragments]
    text = np.frombuffer(b"".join(fragments), np.uint8)
    bounds = np.concatenate([[0], np.cumsum([len(f) for f in fragments])])
    wanted = np.zeros(len(text), bool)
    repeated = np.zeros(len(text), bool)
    for begin, n, occurrences in zip(bounds[:-1].tolist(), places, counts, strict=True):
        wanted[begin : begin + n] = True
        repeated[begin : begin + n] = occurrences > 1
    prefixes = Prefixes(text, length)
    held: list[np.ndarray] = []

    def compare() -> None:
        part = np.concatenate(held)
        shared = prefixes(part) >= length
        repeated[part[:-1][shared]] = True
        repeated[part[1:][shared]] = True
        held[:] = [part[-1:]]

    for part in suffix_order(text, length, limit):
        held.append(part[wanted[part]])
        if sum(map(len, held)) >= CHUNK:
            compare()
    if held:
        compare()
    return [repeated[begin : begin + n] for begin, n in zip(bounds[:-1].tolist(), places, strict=True)]


def _spans(flags: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray]:
    """[start, end) of what the strings at flagged places cover."""
    edge = np.flatnonzero(np.diff(np.concatenate([[0], flags.astype(np.int8), [0]])))
    return edge[0::2], edge[1::2] - 1 + length


def _sorted_shards(length: int, shard: int, limit: int):
    """From fragments ordered by anchor: the repeated spans of each, relative to the anchor's place."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = pa.schema([("content", pa.int64()), ("anchor", pa.int64()), ("from", pa.int64()), ("to", pa.int64())])

        def spans(group: list[tuple[int, int, int, int, bytes]]) -> Iterator[tuple]:
            flags = repeated_places([g[4] for g in group], [g[3] for g in group], length, limit)
            for (anchor, content, left, *_), own in zip(group, flags, strict=True):
                for start, end in zip(*(x.tolist() for x in _spans(own, length)), strict=True):
                    yield content, anchor, start - left, end - left

        def rows() -> Iterator[tuple]:
            group: list[tuple[int, int, int, int, bytes]] = []
            size = 0
            for batch in batches:
                columns = (batch[c].to_pylist() for c in ("anchor", "content", "left", "n"))
                for row in zip(*columns, utf8(batch["data"]), strict=True):
                    if size >= shard and row[0] != group[-1][0]:
                        yield from spans(group)
                        group, size = [], 0
                    group.append(row)
                    size += len(row[4])
            if group:
                yield from spans(group)

        yield from in_parts(rows(), out)

    return run


def _cut(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The bytes of the fragments wanted of each text."""
    out = pa.schema([(c, pa.int64()) for c in ("anchor", "content", "left", "n")] + [("data", pa.binary())])

    def rows() -> Iterator[tuple]:
        for batch in batches:
            for wanted, text in zip(batch["wanted"], utf8(batch["text"]), strict=True):
                for f in wanted.as_py():
                    yield f["anchor"], f["content"], f["left"], f["n"], text[f["start"] : f["stop"]]

    yield from in_parts(rows(), out, 2000)


def repeated_spans(rows: DataFrame, length: int = LENGTH, shard: int = SHARD, limit: int = 8_000_000) -> DataFrame:
    """Rows (id, n_chars, mark, spans): byte ranges (from, to) that repeated strings cover; they may overlap.

    ``rows`` has (id, n_chars, mark, text).
    """
    found = fragments(rows, length)
    kinds = found.groupBy("anchor", "content").agg(F.sum(F.size("ats")).alias("n"))
    anchors = kinds.groupBy("anchor").agg(F.sum("n").alias("all"), F.count("*").alias("kinds")).where("all > 1")
    # Stored, the anchors meet the fragments in a join whose large partitions Spark can split.
    anchors = saved(anchors.select("anchor", "kinds"), "anchors")
    repeats = saved(found.join(anchors, "anchor"), "repeated-anchors")
    owner = ["id", "n_chars", "mark"]

    def covered(start: Callable[[Column], Column], end: Callable[[Column], Column]) -> Column:
        return F.transform("ats", lambda at: F.struct(start(at).alias("from"), end(at).alias("to"))).alias("spans")

    whole = covered(lambda at: at - F.col("left"), lambda at: at - F.col("left") + F.col("places") + length - 1)
    uniform = repeats.where("kinds = 1").select(*owner, whole)

    # One occurrence of each different fragment gives its bytes.
    differing = repeats.where("kinds > 1")
    place = F.min(F.struct(*owner, F.get("ats", F.lit(0)).alias("at"), "places", "left"))
    one = differing.groupBy("anchor", "content").agg(place.alias("f"), F.sum(F.size("ats")).alias("n"))
    start = F.col("f.at") - F.col("f.left")
    wanted = one.select(
        F.col("f.id").alias("_id"), F.col("f.n_chars").alias("_chars"), F.col("f.mark").alias("_mark"),
        F.struct(
            "anchor", "content", "n", F.col("f.left").alias("left"), start.alias("start"),
            (start + F.col("f.places") + length - 1).alias("stop"),
        ).alias("w"),
    )
    wanted = wanted.groupBy("_id", "_chars", "_mark").agg(F.collect_list("w").alias("wanted"))
    same = F.expr("id <=> _id and n_chars = _chars and mark = _mark")
    texts = rows.join(wanted, same).select("wanted", "text")
    cut = texts.mapInArrow(_cut, "anchor bigint, content bigint, left bigint, n bigint, data binary")
    # Rows that agree in id and text give their fragments more than once.
    cut = cut.repartition("anchor").sortWithinPartitions("anchor", "content").dropDuplicates(["anchor", "content"])
    cut = cut.sortWithinPartitions("anchor", "content")
    schema = "content bigint, anchor bigint, `from` bigint, `to` bigint"
    sorted_ = cut.mapInArrow(_sorted_shards(length, shard, limit), schema)
    relative = saved(sorted_, "sorted-spans")
    part = covered(lambda at: at + F.col("from"), lambda at: at + F.col("to"))
    return uniform.unionByName(differing.join(relative, ["anchor", "content"]).select(*owner, part))


def merged(starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Overlapping and touching ranges as one, in order."""
    order = np.argsort(starts, kind="stable")
    starts, ends = starts[order], np.maximum.accumulate(ends[order])
    fresh = np.ones(len(starts), bool)
    fresh[1:] = starts[1:] > ends[:-1]
    first = np.flatnonzero(fresh)
    return starts[first], ends[np.append(first[1:] - 1, len(ends) - 1)]


def remove_repeats(
    docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = LENGTH, **options
) -> DataFrame:
    """Rows (id, n_bytes, n_removed, n_spans, kept), one for each row of ``docs``; ``kept`` is what is left, as bytes.

    Options are those of ``repeated_spans``.
    """
    rows = known_rows(docs, id_col, text_col)
    spans = repeated_spans(rows, length, **options)
    per_text = spans.groupBy("id", "n_chars", "mark").agg(F.flatten(F.collect_list("spans")).alias("spans"))
    renamed = {"id": "_id", "n_chars": "_chars", "mark": "_mark"}
    per_text = per_text.withColumnsRenamed(renamed)
    same = F.expr("id <=> _id and n_chars = _chars and mark = _mark")
    joined = rows.join(per_text, same, "left").select("id", "text", "spans")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = pa.schema([*((c, pa.int64()) for c in ("id", "n_bytes", "n_removed", "n_spans")), ("kept", pa.binary())])

        def found() -> Iterator[tuple]:
            for batch in batches:
                for key, ranges, text in zip(batch["id"], batch["spans"], utf8(batch["text"]), strict=True):
                    n_spans = 0
                    kept = text
                    if ranges.is_valid and len(ranges):
                        values = ranges.values
                        starts, ends = merged(*(values.field(k).to_numpy(zero_copy_only=False) for k in (0, 1)))
                        cuts = [0, *np.stack([starts, ends], 1).ravel().tolist(), len(text)]
                        kept = b"".join(text[a:b] for a, b in zip(cuts[0::2], cuts[1::2], strict=True))
                        n_spans = len(starts)
                    yield key.as_py(), len(text), len(text) - len(kept), n_spans, kept

        yield from in_parts(found(), out, 1000)

    return joined.mapInArrow(run, "id bigint, n_bytes bigint, n_removed bigint, n_spans bigint, kept binary")

