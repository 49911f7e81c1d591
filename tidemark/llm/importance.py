"""Selecting documents by importance resampling.

Two generative models of hashed n-grams are counted: one on labelled documents of the wanted kind (the
target), one on all documents (raw). A document's log weight is the log ratio of the two for its n-grams. With Gumbel
noise added to each weight, the k largest are a sample without replacement in proportion to the weights.

N-grams are the four bytes that begin and the four that end a word, and the shapes (case, digits, signs around, said
again) of two words in a row. A model holds, for each of 2**18 buckets, in how many documents one of
its n-grams occurs, so a repeated line counts once.

Two things differ from plain resampling, because this is a filter that must not lose clean documents or let length
outvote a few bad words. The log ratio is summed over all n-grams of each ``window`` words in a row, said again or
not, and a document weighs as its lowest window. The lowest of many windows is lower by chance: the log weight adds
``by_length`` for each factor e in the number of windows, the slope that the measured wanted documents
show, so that a long clean text weighs as a short one does. Counts are smoothed by documents of the target,
however few it has. Weights are raised to the power ``sharpness`` before the noise, and k is the number of
documents whose weight reaches the value that best parts wanted from unwanted labelled documents, of which the
target has not seen the half that is measured; of values whose errors differ by chance only, the lowest.

``fit`` without a window weighs by the ``worst`` lowest ratios of a document's different buckets (None: all), which
fall as a text grows, smooths by documents of all kinds and takes the value of fewest errors. ``select`` and
``keep_selected`` use windows.

Labels: wanted means quality 1 and toxic 0. Of several labels for one id the worst counts; null labels are ignored.
Without wanted or without unwanted labels every document is kept. A null text counts as empty; an empty text has weight
0. Rows may repeat and are judged alike; rows tied at rank k are all kept. Other columns are not looked at.
"""

from __future__ import annotations

import math
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_parts, saved, utf8
from tidemark.llm.words import Words, grouped, mixed, sections, split_words

BUCKETS = 1 << 18
#: Labelled documents used at most: those with the smallest hash of their id.
LABELLED = 200_000
WORST = 2
SHARPNESS = 20.0
#: Documents added to each bucket, so that one of few occurrences proves little.
SMOOTHING = 10.0
#: With windows: words in a row that are weighed together, and documents of the target added to each bucket.
WINDOW = 2
TARGET_SMOOTHING = 2.0
_TARGET, _GOOD, _BAD = 1, 2, 3

_LETTER = np.zeros(256, bool)
_LETTER[[*range(48, 58), *range(65, 91), *range(97, 123), *range(128, 256)]] = True


def _sums(flags: np.ndarray) -> np.ndarray:
    return np.concatenate([[0], np.cumsum(flags, dtype=np.int32)])


def _four(data: np.ndarray, first: np.ndarray, length: np.ndarray) -> np.ndarray:
    """Up to four bytes from each place, as one number."""
    out = np.zeros(len(first), np.uint64)
    last = len(data) - 1
    for j in range(4):
        byte = data[np.minimum(first + j, last)].astype(np.uint64) + np.uint64(1)
        out = out << np.uint64(9) | np.where(j < length, byte, 0)
    return out


def ngram_buckets(words: Words) -> tuple[np.ndarray, np.ndarray]:
    """(text, bucket) of all n-grams, three for each word."""
    raw, start, end, text = words.raw, words.start, words.end, words.text
    if not len(start):
        return text, text.astype(np.int64)
    letters = np.flatnonzero(_LETTER[raw])
    # The word without the signs around it; a word of signs stays as it is.
    first = np.searchsorted(letters, start)
    after = np.searchsorted(letters, end)
    has = first < after
    at = np.append(letters, 0)
    core = np.where(has, at[first], start)
    stop = np.where(has, at[after - 1] + 1, end)
    length = stop - core
    begins = _four(words.data, core, length)
    ends = _four(words.data, np.maximum(core, stop - 4), np.minimum(length, 4))

    upper, lower, digit = (_sums((raw >= a) & (raw <= b)) for a, b in ((65, 90), (97, 122), (48, 57)))
    n_upper, n_lower, n_digit = (s[stop] - s[core] for s in (upper, lower, digit))
    titled = (raw[core] >= 65) & (raw[core] <= 90)
    # 0: lower case, 1: a capital first, 2: capitals only, 3: capitals elsewhere.
    mixed_case = np.where(titled, np.where(n_upper > 1, 3, 1), np.where(n_upper > 0, 3, 0))
    case = np.where(n_lower > 0, mixed_case, np.where(n_upper > 1, 2, titled)).astype(np.uint64)
    before, behind = _four(raw, start, np.minimum(core - start, 2)), _four(raw, stop, np.minimum(end - stop, 4))
    signs = (case << np.uint64(40)) ^ ((n_digit > 0).astype(np.uint64) << np.uint64(44))
    shape = mixed(before ^ mixed(behind ^ signs))
    shape = np.where(has, shape, mixed(begins ^ np.uint64(7 << 50)))
    joined = np.zeros(len(text), bool)
    joined[1:] = text[1:] == text[:-1]
    again = np.zeros(len(text), bool)
    again[1:] = (begins[1:] == begins[:-1]) & (ends[1:] == ends[:-1]) & (length[1:] == length[:-1]) & joined[1:]
    previous = np.where(joined, np.concatenate([[np.uint64(0)], shape[:-1]]), np.uint64(0))
    pair = mixed(previous) ^ shape ^ again.astype(np.uint64)
    kinds = np.concatenate([mixed(x ^ np.uint64(kind << 60)) for kind, x in ((1, begins), (2, ends), (3, pair))])
    return np.tile(text, 3), (kinds % np.uint64(BUCKETS)).astype(np.int64)


def document_buckets(items: Iterable[tuple[object, bytes]]) -> Iterator[tuple[object, np.ndarray]]:
    """Each document with its different buckets. Long texts are read in sections."""

    def parts() -> Iterator[tuple[tuple[object, bool], bytes]]:
        for key, text in items:
            open_ = None
            for part in sections(text):
                if open_ is not None:
                    yield (key, False), open_
                open_ = part
            yield (key, True), open_

    rest: list[np.ndarray] = []
    for group in grouped(parts()):
        text, bucket = ngram_buckets(split_words([part for _, part in group]))
        pairs = np.unique(text * BUCKETS + bucket)
        bounds = np.searchsorted(pairs, np.arange(len(group) + 1) * BUCKETS)
        for i, ((key, last), _) in enumerate(group):
            own = pairs[bounds[i] : bounds[i + 1]] - i * BUCKETS
            if rest or not last:
                rest = [np.unique(np.concatenate([*rest, own]))]
                own = rest[0]
            if last:
                yield key, own
                rest = []


def _lowest(values: np.ndarray, window: int) -> float:
    """The lowest sum of so many values in a row (of all, if there are fewer); added in order, so that it is exact."""
    n = max(1, len(values) - window + 1)
    sums = values[:n].copy()
    for j in range(1, min(window, len(values))):
        sums += values[j : j + n]
    return float(sums.min())


def lowest_windows(
    items: Iterable[tuple[object, bytes]], ratios: np.ndarray, window: int
) -> Iterator[tuple[object, float, int]]:
    """Each document with its lowest window's log ratio (0 without words) and its number of windows, at least 1.

    Long texts are read in sections; windows go on over the cuts.
    """

    def parts() -> Iterator[tuple[tuple[object, bool], bytes]]:
        for key, text in items:
            open_ = None
            for part in sections(text):
                if open_ is not None:
                    yield (key, False), open_
                open_ = part
            yield (key, True), open_

    ending, lowest, n_words = np.zeros(0), math.inf, 0
    for group in grouped(parts()):
        text, bucket = ngram_buckets(split_words([part for _, part in group]))
        kinds = ratios[bucket].reshape(3, -1)
        values = kinds[0] + kinds[1] + kinds[2]
        own = text[: len(values)]
        bounds = np.searchsorted(own, np.arange(len(group) + 1))
        for i, ((key, last), _) in enumerate(group):
            n_words += int(bounds[i + 1] - bounds[i])
            here = np.concatenate([ending, values[bounds[i] : bounds[i + 1]]])
            if len(here) >= window or (last and n_words < window and len(here)):
                lowest = min(lowest, _lowest(here, window))
            if last:
                yield key, lowest if n_words else 0.0, max(1, n_words - window + 1)
                ending, lowest, n_words = ending[:0], math.inf, 0
            else:
                ending = here[max(0, len(here) - window + 1) :]


@dataclass
class Labels:
    """Ids in order, and what each is: for the target, or to measure by (good, bad)."""

    ids: np.ndarray
    kinds: np.ndarray

    def of(self, key: int | None) -> int:
        if key is None or not len(self.ids):
            return 0
        i = int(np.searchsorted(self.ids, key))
        return int(self.kinds[i]) if i < len(self.ids) and self.ids[i] == key else 0


def read_labels(labels: DataFrame, most: int = LABELLED) -> Labels:
    """At most ``most`` labelled documents; half of the wanted are for the target."""
    rows = labels.where("doc_id is not null and quality is not null and toxic is not null")
    rows = rows.groupBy("doc_id").agg((F.min("quality").eqNullSafe(1) & F.max("toxic").eqNullSafe(0)).alias("wanted"))
    rows = rows.withColumn("hash", F.xxhash64("doc_id")).orderBy("hash", "doc_id").limit(most).collect()
    kinds = {r["doc_id"]: (_TARGET if r["hash"] % 2 else _GOOD) if r["wanted"] else _BAD for r in rows}
    ids = np.array(sorted(kinds), np.int64)
    return Labels(ids, np.array([kinds[i] for i in ids.tolist()], np.int8))


def _rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    return docs.select(F.col(f"`{id_col}`").cast("bigint").alias("id"), F.col(f"`{text_col}`").alias("text"))


def _items(batches: Iterable[pa.RecordBatch]) -> Iterator[tuple[int | None, bytes]]:
    for batch in batches:
        yield from zip(batch["id"].to_pylist(), utf8(batch["text"]), strict=True)


def log_ratios(
    docs: DataFrame,
    labels: Labels,
    id_col: str = "doc_id",
    text_col: str = "text",
    target_smoothing: float | None = None,
) -> np.ndarray:
    """For each bucket, the log of its share in the target over its share in all documents.

    ``target_smoothing`` documents of the target are added to each bucket, and as many of all documents as the target
    is smaller; without it, ``SMOOTHING`` of all documents.

    Every task counts into two arrays and passes on the buckets it has met, so that what is shuffled is bounded by
    the number of buckets for each task.
    """

    def count(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = pa.schema([(c, pa.int64()) for c in ("bucket", "raw", "target")])
        raw, target = np.zeros(BUCKETS, np.int64), np.zeros(BUCKETS, np.int64)
        for key, buckets in document_buckets(_items(batches)):
            raw[buckets] += 1
            if labels.of(key) == _TARGET:
                target[buckets] += 1
        met = np.flatnonzero(raw)
        if len(met):
            yield pa.RecordBatch.from_arrays([pa.array(x) for x in (met, raw[met], target[met])], schema=out)

    counts = _rows(docs, id_col, text_col).mapInArrow(count, "bucket bigint, raw bigint, target bigint")
    sums = counts.groupBy("bucket").agg(F.sum("raw").alias("raw"), F.sum("target").alias("target"))
    found = sums.toArrow()
    raw, target = np.zeros(BUCKETS), np.zeros(BUCKETS)
    at = found["bucket"].to_numpy()
    raw[at], target[at] = found["raw"].to_numpy(), found["target"].to_numpy()
    if not target.any():
        return np.zeros(BUCKETS)
    share = target.sum() / raw.sum()
    added = SMOOTHING if target_smoothing is None else target_smoothing / share
    return np.log((target + added * share) / target.sum()) - np.log((raw + added) / raw.sum())


def gumbel(keys: np.ndarray, seed: int) -> np.ndarray:
    """Noise that depends on the id alone, so that a task run again draws the same."""
    drawn = mixed(mixed(keys.astype(np.int64).view(np.uint64) + np.uint64(seed)) + np.uint64(0x9E3779B97F4A7C15))
    uniform = ((drawn >> np.uint64(11)).astype(np.float64) + 0.5) / (1 << 53)
    return -np.log(-np.log(uniform))


@dataclass
class Weigher:
    """Log weights and noisy keys of documents."""

    ratios: np.ndarray
    worst: int | None = WORST
    sharpness: float = SHARPNESS
    seed: int = 17
    window: int | None = None
    by_length: float = 0.0

    def weight(self, buckets: np.ndarray) -> float:
        found = self.ratios[buckets]
        if self.worst is not None and len(found) > self.worst:
            found = np.partition(found, self.worst - 1)[: self.worst]
        return float(np.sort(found).sum())

    def parts(self, items: Iterable[tuple[int | None, bytes]]) -> Iterator[tuple[int | None, float, float, float]]:
        """(id, lowest window, log of the number of windows, noise)."""
        if self.window is None:
            found = ((key, self.weight(buckets), 1) for key, buckets in document_buckets(items))
        else:
            found = lowest_windows(items, self.ratios, self.window)
        for key, lowest, n in found:
            yield key, lowest, math.log(n), float(gumbel(np.array([-1 if key is None else key]), self.seed)[0])

    def weighed(self, lowest, spread, noise):
        """(log weight, key), of numbers or of columns: both give the same to the last bit."""
        weight = lowest + spread * self.by_length
        return weight, weight * self.sharpness + noise


def weighed(
    docs: DataFrame, weigher: Weigher, labels: Labels, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """Rows (id, lowest, spread, noise, label), one for each row of ``docs``; see ``Weigher.parts``."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        numbers = [(c, pa.float64()) for c in ("lowest", "spread", "noise")]
        out = pa.schema([("id", pa.int64()), *numbers, ("label", pa.int32())])
        yield from in_parts(((*row, labels.of(row[0])) for row in weigher.parts(_items(batches))), out)

    schema = "id bigint, lowest double, spread double, noise double, label int"
    return _rows(docs, id_col, text_col).mapInArrow(run, schema)


def fall_by_length(rows: DataFrame) -> float:
    """By how much the lowest window of measured wanted documents falls for each factor e in their windows."""
    slope = rows.where(f"label = {_GOOD}").agg(F.regr_slope("lowest", "spread")).first()[0]
    return max(0.0, -round(slope, 6)) if slope is not None else 0.0


def best_cut(rows: DataFrame, by_chance: bool = False) -> float:
    """The log weight that parts measured good from bad with the fewest errors; the lowest of equals.

    With ``by_chance`` all count as equal whose errors exceed the fewest by no more than these's square root, what
    another draw of labels may differ by. Weights are counted in steps of 1/64.
    """
    measured = rows.where(f"label in ({_GOOD}, {_BAD})")
    steps = measured.groupBy(F.floor(F.col("log_weight") * 64).alias("step"), "label").count()
    good: dict[int, int] = {}
    bad: dict[int, int] = {}
    for r in steps.collect():
        (good if r["label"] == _GOOD else bad)[r["step"]] = r["count"]
    if not good or not bad:
        return float("-inf")
    errors = sum(bad.values())  # with everything kept
    found = [(min([*good, *bad]), errors)]
    for step in sorted({*good, *bad}):
        errors += good.get(step, 0) - bad.get(step, 0)
        found.append((step + 1, errors))
    least = min(n for _, n in found)
    most = least + math.sqrt(least) if by_chance else least
    return next(cut for cut, n in found if n <= most) / 64


def kth_largest(rows: DataFrame, column: str, k: int) -> float:
    """The k-th largest value of a column of finite numbers, found by counting in ever narrower ranges."""
    low, high = rows.agg(F.min(column), F.max(column)).first()
    while low < high:
        inside = rows.where(F.col(column).between(low, high))
        width = (high - low) / 1024
        if low + width == low:
            return _kth_of(inside, column, k)
        step = F.least(F.floor((F.col(column) - low) / width), F.lit(1023)).alias("step")
        ends = F.min(column).alias("low"), F.max(column).alias("high")
        counts = inside.groupBy(step).agg(F.count("*").alias("n"), *ends)
        for r in sorted(counts.collect(), key=lambda r: -r["step"]):
            if k <= r["n"]:
                break
            k -= r["n"]
        if (low, high) == (r["low"], r["high"]):
            return _kth_of(inside, column, k)
        low, high = r["low"], r["high"]
    return low


def _kth_of(rows: DataFrame, column: str, k: int) -> float:
    """For a few neighbouring numbers, which steps cannot part: count each."""
    for r in sorted(rows.groupBy(column).count().collect(), key=lambda r: -r[0]):
        if k <= r["count"]:
            break
        k -= r["count"]
    return r[0]


@dataclass
class Selection:
    weigher: Weigher
    labels: Labels
    least_key: float
    rows: DataFrame


def fit(docs: DataFrame, labels: DataFrame, id_col: str = "doc_id", text_col: str = "text", **options) -> Selection:
    """Count the models over all documents, weigh them all, and find the key of rank k.

    ``rows`` has (id, log_weight, key, label), one for each row of ``docs``. Options are those of ``Weigher``.
    """
    known = read_labels(labels)
    smoothing = TARGET_SMOOTHING if options.get("window") is not None else None
    weigher = Weigher(log_ratios(docs, known, id_col, text_col, smoothing), **options)
    found = saved(weighed(docs, weigher, known, id_col, text_col), "weights")
    if weigher.window is not None:
        weigher.by_length = fall_by_length(found)
    weight, key = weigher.weighed(F.col("lowest"), F.col("spread"), F.col("noise"))
    rows = found.select("id", weight.alias("log_weight"), key.alias("key"), "label")
    cut = best_cut(rows, weigher.window is not None) if weigher.ratios.any() else float("-inf")
    k = rows.where(F.col("log_weight") >= cut).count()
    least = kth_largest(rows, "key", k) if k else float("inf")
    return Selection(weigher, known, least, rows)


def select(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int | None = WINDOW,
    **options,
) -> DataFrame:
    """Rows (id, log_weight, key, kept), one for each row of ``docs``."""
    found = fit(docs, labels, id_col, text_col, window=window, **options)
    return found.rows.select("id", "log_weight", "key", (F.col("key") >= found.least_key).alias("kept"))


def keep_selected(
    docs: DataFrame,
    labels: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    window: int | None = WINDOW,
    **options,
) -> DataFrame:
    """The rows of ``docs`` that are selected, with all their columns.

    The rows are weighed once more where they are read, which spares a shuffle of all texts.
    """
    found = fit(docs, labels, id_col, text_col, window=window, **options)
    weigher, least = found.weigher, found.least_key
    own_id, own_text = docs.columns.index(id_col), docs.columns.index(text_col)

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            items = zip(batch[own_id].cast(pa.int64()).to_pylist(), utf8(batch[own_text]), strict=True)
            kept = [weigher.weighed(*found)[1] >= least for _, *found in weigher.parts(items)]
            yield batch.filter(pa.array(kept, pa.bool_()))

    # Columns go by number, for a name may hold a dot.
    numbered = docs.toDF(*(f"c{i}" for i in range(len(docs.columns))))
    return numbered.mapInArrow(run, numbered.schema).toDF(*docs.columns)
