"""Groups of documents whose word shingles are similar: an exact set similarity join.

1. Documents with equal sets are one class; from here on there are classes only.
2. Each class has keys from its segments (``jaccard``). Keys are shuffled and sorted, and the runs of classes with one
   key are read in a stream.
3. A key of very many classes tells little. Classes whose spare segments do not make up for such keys get a second set
   of keys, their rarest shingles: so many that two linked sets must share one.
4. Of the classes of a key, the one with most shared keys is measured against all others. What links is joined to
   components. Then only classes of one key in different components are still open; a bound from sketches
   tells nearly all of these apart, block by block, and the rest is measured.

Each pair that might join two components is thus tested, while the many pairs inside a component are not.

A text without words, or null, has an empty set and links with nothing. Rows may repeat; a null id is never the
smallest. Other columns are not looked at. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm import jaccard
from tidemark.llm.common import in_parts, known_rows, rows_that_stay, saved, utf8, whole_groups
from tidemark.llm.components import connected_components
from tidemark.llm.jaccard import PERCENT, WORDS, shingle_sets

#: A key of more classes is frequent.
FREQUENT = 32
#: Classes compared with each other at a time.
BLOCK = 1024
#: Groups of shingles that are counted together to tell rare ones.
BUCKETS = 1 << 16
#: Keys handed on together.
KEYS_AT_ONCE = 200_000


def _sets(batches: Iterable[pa.RecordBatch], n_words: int, seed: int) -> Iterator[tuple[int, np.ndarray]]:
    """(row of its batch, set) of each text; sets come in the order of the rows."""
    for batch in batches:
        yield from shingle_sets(enumerate(utf8(batch["text"])), n_words, seed)


def _with_sets(rows: DataFrame, n_words: int, seed: int) -> DataFrame:
    """Rows (id, n_chars, mark, n, cid, check): the size of the set and 128 bits that know it."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            got = [(len(s), *jaccard.set_hashes(s)) for _, s in _sets([batch], n_words, seed)]
            columns = zip(*got, strict=True) if got else ([], [], [])
            kept = [batch[c] for c in ("id", "n_chars", "mark")]
            names = ["id", "n_chars", "mark", "n", "cid", "check"]
            yield pa.RecordBatch.from_arrays([*kept, *(pa.array(c, pa.int64()) for c in columns)], names=names)

    return rows.mapInArrow(run, "id bigint, n_chars bigint, mark bigint, n bigint, cid bigint, check bigint")


def _batch(parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]]) -> pa.RecordBatch:
    columns = (pa.array(np.concatenate(x)) for x in zip(*parts, strict=True))
    return pa.RecordBatch.from_arrays(list(columns), names=["key", "cid", "spare"])


def _keys(rows: DataFrame, n_words: int, seed: int, percent: int) -> DataFrame:
    """Rows (key, cid, spare) of all classes; each task gives the keys of a class once."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[int] = set()
        parts: list[tuple[np.ndarray, np.ndarray, np.ndarray]] = []
        size = 0
        for _, s in _sets(batches, n_words, seed):
            cid = jaccard.set_hashes(s)[0]
            if not len(s) or cid in seen:
                continue
            seen.add(cid)
            found, spare = jaccard.keys(s, percent)
            parts.append((found, np.full(len(found), cid, np.int64), spare))
            size += len(found)
            if size >= KEYS_AT_ONCE:
                yield _batch(parts)
                parts, size = [], 0
        if parts:
            yield _batch(parts)

    return rows.mapInArrow(run, "key bigint, cid bigint, spare int")


def _shared(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """From rows ordered by key and class: those of keys that several classes have, and whether these are many.

    A run is held back until it ends or has become long; the rest of a long one passes through.
    """
    names = ["key", "cid", "spare", "frequent"]
    held: list[np.ndarray] = [np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int32)]
    long_key: int | None = None
    last: tuple[int, int] | None = None

    def out(
        rows: list[np.ndarray], long: int | None, final: bool
    ) -> tuple[pa.RecordBatch, list[np.ndarray], int | None]:
        """Emit all runs but the last, which may go on."""
        keys = rows[0]
        starts = np.flatnonzero(np.concatenate([[True], keys[1:] != keys[:-1]])[: len(keys)])
        counts = np.diff(np.append(starts, len(keys)))
        frequent = counts > FREQUENT
        if len(keys) and long is not None and keys[0] == long:
            frequent[0] = True
        several = frequent | (counts > 1)
        done = np.ones(len(starts), bool)
        if len(starts) and not final:
            done[-1] = frequent[-1]
            long = int(keys[-1]) if frequent[-1] else None
        take = np.repeat(several & done, counts)
        keep = np.repeat(~done, counts)
        columns = [x[take] for x in (*rows, np.repeat(frequent, counts))]
        batch = pa.RecordBatch.from_arrays(list(map(pa.array, columns)), names=names)
        return batch, [x[keep] for x in rows], long

    for batch in batches:
        if not len(batch):
            continue
        new = [batch[c].to_numpy(zero_copy_only=False) for c in ("key", "cid", "spare")]
        # Copies of a class that several tasks have met stand side by side.
        fresh = np.ones(len(batch), bool)
        fresh[1:] = (new[0][1:] != new[0][:-1]) | (new[1][1:] != new[1][:-1])
        fresh[0] = last != (int(new[0][0]), int(new[1][0]))
        last = int(new[0][-1]), int(new[1][-1])
        rows = [np.concatenate([h, x[fresh]]) for h, x in zip(held, new, strict=True)]
        found, held, long_key = out(rows, long_key, False)
        yield found
    yield out(held, long_key, True)[0]


def _members(
    docs: DataFrame, classes: DataFrame, wanted: DataFrame, n_words: int, seed: int, percent: int
) -> DataFrame:
    """Rows (cid, n, sketch, shingles) of the wanted classes, from one document of each."""
    chosen = classes.join(wanted, "cid", "left_semi").select(
        F.col("low").alias("_low"), F.col("low_chars").alias("_chars"), F.col("low_mark").alias("_mark")
    )
    texts = docs.join(chosen, F.expr("id <=> _low and n_chars = _chars and mark = _mark"), "left_semi")

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists = [("sketch", pa.binary()), ("shingles", pa.list_(pa.int64()))]
        out = pa.schema([("cid", pa.int64()), ("n", pa.int64()), *lists])

        def rows() -> Iterator[tuple]:
            for _, s in _sets(batches, n_words, seed):
                yield jaccard.set_hashes(s)[0], len(s), jaccard.sketch(s, percent), s.view(np.int64)

        yield from in_parts(rows(), out, 500)

    sets = texts.select("text").mapInArrow(run, "cid bigint, n bigint, sketch binary, shingles array<bigint>")
    # Rows that agree in id and text give a class twice.
    sets = sets.join(wanted, "cid", "left_semi")
    return sets.groupBy("cid").agg(*(F.first(c).alias(c) for c in ("n", "sketch", "shingles")))


def _bucket_counts(sets: DataFrame) -> np.ndarray:
    """In how many sets a shingle of each bucket occurs, counted into one array for each task."""

    def add(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(BUCKETS, np.int64)
        for batch in batches:
            if "shingles" in batch.schema.names:
                total += np.bincount(_buckets(batch["shingles"].flatten().to_numpy()), minlength=BUCKETS)
            else:
                for counts in batch["counts"]:
                    total += np.frombuffer(counts.as_py(), np.int64)
        yield pa.RecordBatch.from_arrays([pa.array([total.tobytes()], pa.binary())], names=["counts"])

    parts = sets.select("shingles").mapInArrow(add, "counts binary")
    few = parts.repartition(16).mapInArrow(add, "counts binary")
    return sum((np.frombuffer(r["counts"], np.int64) for r in few.collect()), np.zeros(BUCKETS, np.int64))


def _buckets(shingles: np.ndarray) -> np.ndarray:
    return (jaccard.mixed(shingles.view(np.uint64)) % np.uint64(BUCKETS)).astype(np.int64)


def _rare_keys(keys: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """Rows (key, cid): the rarest shingles of classes for which frequent keys are too many.

    A set of n and one that it links with share percent * n / 100 shingles at least. So each, ordered by any rule
    that is the same for all, has one of them among its first n - percent * n / 100 + 1. The rule is how often
    a shingle's bucket occurs: a poor count makes keys more frequent and loses nothing.
    """
    few = keys.where("frequent").groupBy("cid", "spare").count().where(F.col("count") > F.greatest("spare", F.lit(0)))
    exposed = saved(sets.join(few.select("cid").distinct(), "cid", "left_semi").select("cid", "shingles"), "exposed")
    counts = _bucket_counts(exposed)

    def rarest(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for cid, shingles in zip(batch["cid"], batch["shingles"], strict=True):
                own = shingles.values.to_numpy()
                order = np.lexsort((own, counts[_buckets(own)]))
                first = own[order[: len(own) + percent * -len(own) // 100 + 1]]
                found = jaccard.mixed(first.view(np.uint64) ^ np.uint64(1 << 63)).view(np.int64)
                cids = np.full(len(found), cid.as_py(), np.int64)
                yield pa.RecordBatch.from_arrays([pa.array(found), pa.array(cids)], names=["key", "cid"])

    return exposed.mapInArrow(rarest, "key bigint, cid bigint")


def _one_key_for_each_company(keys: DataFrame) -> DataFrame:
    """Of keys that the same classes have, one; without keys that one class has."""
    known_by = F.sum(F.xxhash64("cid").cast("decimal(20,0)")).alias("sum")
    company = keys.groupBy("key").agg(F.count("*").alias("n"), known_by)
    kept = company.where("n > 1").groupBy("n", "sum").agg(F.min("key").alias("key"))
    # Stored sums meet the rows in joins whose large partitions Spark can split.
    return keys.join(saved(kept.select("key", "n"), "kept-keys"), "key")


def _numbers(batch: pa.RecordBatch, name: str) -> np.ndarray:
    return batch[name].to_numpy(zero_copy_only=False)


def _words(sketches: Iterable[bytes], words: int) -> np.ndarray:
    rows = [jaccard.folded(np.frombuffer(s, np.uint64)[None], words)[0] for s in sketches]
    return np.stack(rows)


def _similar(pairs: DataFrame, sets: DataFrame, percent: int) -> DataFrame:
    """The pairs (a, b) that link: first by sketches, which are short, then by the sets."""

    def by_sketch(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = batch["sketch_a"].to_pylist(), batch["sketch_b"].to_pylist()
            sizes = _numbers(batch, "n_a"), _numbers(batch, "n_b")
            words = np.array([min(len(x), len(y)) // 8 for x, y in zip(a, b, strict=True)], np.int64)
            near = np.zeros(len(batch), bool)
            for w in np.unique(words).tolist():
                at = np.flatnonzero(words == w)
                near[at] = jaccard.may_link(
                    _words((a[i] for i in at), w), _words((b[i] for i in at), w), sizes[0][at], sizes[1][at], percent
                )
            yield batch.select(["a", "b"]).filter(pa.array(near))

    def by_set(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            near = [
                jaccard.linked(x.values.to_numpy(), y.values.to_numpy(), percent)
                for x, y in zip(batch["set_a"], batch["set_b"], strict=True)
            ]
            yield batch.select(["a", "b"]).filter(pa.array(near, pa.bool_()))

    def beside(rows: DataFrame, column: str, name: str, *more: str) -> DataFrame:
        for side in ("a", "b"):
            also = (F.col(c).alias(f"{c}_{side}") for c in more)
            other = sets.select(F.col("cid").alias(side), F.col(column).alias(f"{name}_{side}"), *also)
            rows = rows.join(other, side)
        return rows

    near = saved(beside(pairs, "sketch", "sketch", "n").mapInArrow(by_sketch, "a bigint, b bigint"), "near-pairs")
    sets_of = beside(near, "shingles", "set").select("a", "b", "set_a", "set_b")
    return saved(sets_of.mapInArrow(by_set, "a bigint, b bigint"), "links")


_CELL = ["key", "i", "j"]


def _open_pairs(percent: int):
    """From rows ordered by cell: pairs of classes of different components that sketches do not tell apart."""

    def cell(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        cids, sizes, own, component = (rows[c].to_numpy() for c in ("cid", "n", "own", "component"))
        left, right = np.flatnonzero(own == rows["i"].to_numpy()), np.flatnonzero(own == rows["j"].to_numpy())
        raw = rows["sketch"].to_pylist()
        words = min(len(s) for s in raw) // 8
        sketches = _words(raw, words)
        a, b = [], []
        for x in left.tolist():
            other = right[(cids[right] != cids[x]) & (component[right] != component[x])]
            near = other[jaccard.may_link(sketches[other], sketches[x], sizes[other], sizes[x : x + 1], percent)]
            a.append(np.minimum(cids[near], cids[x]))
            b.append(np.maximum(cids[near], cids[x]))
        return np.concatenate([np.empty(0, np.int64), *a]), np.concatenate([np.empty(0, np.int64), *b])

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for groups in whole_groups(batches, _CELL):
            found = [np.stack(cell(rows)) for rows in groups if len(rows) > 1]
            pairs = np.unique(np.concatenate([np.empty((2, 0), np.int64), *found], axis=1), axis=1)
            yield pa.RecordBatch.from_arrays([pa.array(pairs[0]), pa.array(pairs[1])], names=["a", "b"])

    return run


def similar_groups(
    docs: DataFrame,
    percent: int = PERCENT,
    n_words: int = WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
    block: int = BLOCK,
) -> DataFrame:
    """Rows (id, n_chars, mark, n_shingles, component_id, kept), one for each row of ``docs``.

    Two documents link when 100 * shared shingles >= percent * shingles of both; ``component_id`` is the smallest id
    reached by links. ``kept`` marks the row with that id.
    """
    rows = known_rows(docs, id_col, text_col)
    seed = 0
    while True:
        found = saved(_with_sets(rows, n_words, seed), "sets")
        first = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "n_chars", "mark"))
        classes = found.where("n > 0").groupBy("cid", "check", "n")
        classes = classes.agg(first.alias("first"), F.count("*").alias("size"))
        low = {"low": "first.id", "low_chars": "first.n_chars", "low_mark": "first.mark"}
        named = (F.col(value).alias(name) for name, value in low.items())
        classes = saved(classes.select("cid", "check", "n", "size", *named), "classes")
        # 64 bits stand for a class; should two classes share them, other hashes are taken.
        if classes.groupBy("cid").count().where("count > 1").isEmpty():
            break
        seed += 1

    keys = _keys(rows.select("text"), n_words, seed, percent).repartition("key").sortWithinPartitions("key", "cid")
    keys = saved(keys.mapInArrow(_shared, "key bigint, cid bigint, spare int, frequent boolean"), "shared-keys")
    sets = saved(_members(rows, classes, keys.select("cid").distinct(), n_words, seed, percent), "members")
    companies = keys.where("not frequent").select("key", "cid").unionByName(_rare_keys(keys, sets, percent))
    companies = saved(_one_key_for_each_company(companies), "companies")

    # The class with most company is measured against the others.
    score = companies.groupBy("cid").agg(F.sum("n").alias("score"))
    scored = companies.join(score, "cid")
    middle = saved(scored.groupBy("key").agg(F.max(F.struct("score", "cid")).alias("middle")), "middles")
    stars = companies.join(middle, "key").where("cid <> middle.cid")
    stars = stars.select(F.least("cid", "middle.cid").alias("a"), F.greatest("cid", "middle.cid").alias("b")).distinct()
    stars = saved(stars, "stars")
    links = _similar(stars, sets, percent)
    component = connected_components(links)

    # Classes of one key in different components; a key of two classes is settled.
    open_ = companies.where("n > 2").join(component.withColumnRenamed("node", "cid"), "cid", "left")
    open_ = open_.withColumn("component", F.coalesce("component", "cid"))
    ends = F.min("component").alias("low"), F.max("component").alias("high")
    unsettled = open_.groupBy("key").agg(*ends).where("low < high").select("key")
    open_ = open_.join(saved(unsettled, "unsettled-keys"), "key").join(sets.select("cid", F.col("n").alias("size"), "sketch"), "cid")
    blocks = F.ceil(F.col("n") / block).cast("int")
    open_ = open_.withColumn("own", F.pmod(F.xxhash64("cid"), blocks).cast("int")).withColumn(
        "other", F.explode(F.sequence(F.lit(0), blocks - 1))
    )
    place = F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j")
    cells = open_.select("key", *place, "own", "cid", "component", F.col("size").alias("n"), "sketch")
    cells = cells.repartition(*_CELL).sortWithinPartitions(*_CELL)
    more = cells.mapInArrow(_open_pairs(percent), "a bigint, b bigint").distinct().join(stars, ["a", "b"], "left_anti")
    links = links.unionByName(_similar(saved(more, "open-pairs"), sets, percent))

    component = connected_components(links)
    root = classes.join(component.withColumnRenamed("node", "cid"), "cid", "left")
    root = root.withColumn("root", F.coalesce("component", "cid"))
    order = F.struct(
        F.col("low").isNull().alias("last"), F.col("low").alias("id"),
        F.col("low_chars").alias("n_chars"), F.col("low_mark").alias("mark"),
    )
    first = saved(root.groupBy("root").agg(F.min(order).alias("first")), "firsts")
    groups = root.select("cid", "root").join(first, "root").select("cid", "first")
    # The classes of empty sets are left out: each such row is a group of its own.
    joined = found.join(groups.withColumnRenamed("cid", "_cid"), F.expr("cid = _cid and n > 0"), "left")
    kept = F.expr("n = 0 or (id <=> first.id and n_chars = first.n_chars and mark = first.mark)")
    return joined.select(
        "id", "n_chars", "mark", F.col("n").alias("n_shingles"),
        F.when(F.col("n") > 0, F.col("first.id")).otherwise(F.col("id")).alias("component_id"), kept.alias("kept"),
    )


def drop_similar(
    docs: DataFrame, percent: int = 80, n_words: int = 5, id_col: str = "doc_id", text_col: str = "text"
) -> DataFrame:
    """The rows of ``docs`` without those similar to one that stays, with all their columns.

    Of each group the row with the smallest id stays.
    """
    decided = saved(similar_groups(docs, percent, n_words, id_col, text_col), "similar-groups")
    return rows_that_stay(docs, decided, id_col, text_col)
