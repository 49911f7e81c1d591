"""How much the sources of a language differ in the words they use.

A term is a run of letters: A-Z and a-z, of which the capitals are lowered, and all characters beyond ASCII. A language
keeps the terms that stand in at least ``LEAST_DOCS`` of its documents. A group is a (language, source). Every group, and
every language as a whole, gives each kept term the smoothed share ``1 + floor(10**9 * (count + 5) / (N + 5 * V))``, with
N the sum of its counts over the V kept terms. Two groups differ in a term by the difference of their shares.

Counting: a task counts terms by group, many documents at a time, before Spark adds the counts up; a group with a third
of all rows sends one row per task and term. Kept terms are dealt by hash into blocks of about ``BLOCK`` terms and
numbered there, and every group has one row per block with its sorted (number, count) arrays. The sources of a
language are dealt into tiles; a task co-groups two tiles' arrays of one block and merges each unordered pair of groups
in it once, by a galloping intersection. Shared, one-sided and absent terms are priced apart, so its work grows
with the terms that the two groups have, not with all kept ones. The sum serves both directions.

Null languages, sources and texts count as empty ones; ``''`` is a language and a source. Rows may repeat, and each
counts. Groups without terms take part. Other columns are not looked at. An empty table gives no rows.
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterable, Iterator
from itertools import combinations, product

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.llm.common import saved, utf8
from tidemark.llm.words import AT_ONCE

LEAST_DOCS = 30
SMOOTHING = 5
SCALE = 1_000_000_000
#: Terms listed for each group.
TOP = 50
#: Kept terms in a block, about.
BLOCK = 1 << 12
#: Sources in a tile.
TILE = 4
#: Different (group, term) counts that a task holds before it passes them on.
HELD = 200_000
#: Neighbouring terms that are looked up together once galloping has found where they lie.
RUN = 64

#: ASCII letters in lower case, all other ASCII characters as blanks, bytes beyond ASCII as they are.
_LETTERS = bytes(
    c | 0x20 if 0x41 <= c <= 0x5A else c if 0x61 <= c <= 0x7A or c >= 0x80 else 0x20 for c in range(256)
)
GROUP = ["lang", "source"]


def terms(text: bytes) -> Iterator[list[bytes]]:
    """The terms of a text in UTF-8, a section of it at a time."""
    letters, start = text.translate(_LETTERS), 0
    while start < len(letters):
        cut = letters.find(b" ", start + AT_ONCE)
        end = cut if cut >= 0 else len(letters)
        yield letters[start:end].split()
        start = end


def _counted(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    out = pa.schema([*((c, pa.string()) for c in (*GROUP, "term")), ("n", pa.int64()), ("docs", pa.int64())])
    counts: dict[tuple[str, str], Counter[bytes]] = {}
    docs: dict[tuple[str, str], Counter[bytes]] = {}

    def passed_on() -> Iterator[pa.RecordBatch]:
        sizes = [len(count) for count in counts.values()]
        names = [pa.array(name, pa.string()) for name in zip(*counts, strict=True)] or [pa.array([], pa.string())] * 2
        group = pa.array(np.repeat(np.arange(len(sizes)), sizes))
        found = pa.array([term for count in counts.values() for term in count], pa.binary())
        n = pa.array([n for count in counts.values() for n in count.values()], pa.int64())
        seen = pa.array([docs[key][term] for key, count in counts.items() for term in count], pa.int64())
        # Cut at ASCII characters only, so the terms are as valid as the texts were.
        columns = [*(name.take(group) for name in names), found.view(pa.string()), n, seen]
        yield pa.RecordBatch.from_arrays(columns, schema=out)
        counts.clear()
        docs.clear()

    held = 0
    for batch in batches:
        groups = zip(*(batch[c].to_pylist() for c in GROUP), strict=True)
        for group, text in zip(groups, utf8(batch["text"]), strict=True):
            own: Counter[bytes] = Counter()
            for part in terms(text):
                own.update(part)
            count = counts.setdefault(group, Counter())
            before = len(count)
            count.update(own)
            docs.setdefault(group, Counter()).update(own.keys())
            held += len(count) - before
            if held > HELD:
                yield from passed_on()
                held = 0
    yield from passed_on()


def term_counts(rows: DataFrame) -> DataFrame:
    """Rows (lang, source, term, n, docs): occurrences and documents of each term of rows (lang, source, text)."""
    counted = rows.mapInArrow(_counted, "lang string, source string, term string, n bigint, docs bigint")
    return counted.groupBy(*GROUP, "term").agg(F.sum("n").alias("n"), F.sum("docs").alias("docs"))


def share(count: Column, total: Column, kept: Column) -> Column:
    """The share in exact arithmetic: products of up to 31 digits."""
    part = (count + F.lit(SMOOTHING)).cast("decimal(20,0)") * F.lit(SCALE).cast("decimal(10,0)")
    whole = (total + F.lit(SMOOTHING) * kept).cast("decimal(20,0)")
    # ``div`` is whole-number division; it has no function of its own.
    return F.lit(1).cast("bigint") + F.call_function("div", part, whole)


def shares(counts: np.ndarray, total: int, kept: int) -> np.ndarray:
    """The same for an array of counts, by long division in steps of 1,000, whose remainders stay in a long."""
    whole = total + SMOOTHING * kept
    quotient, rest = np.divmod(counts.astype(np.int64) + SMOOTHING, whole)
    for _ in range(3):
        digits, rest = np.divmod(rest * 1000, whole)
        quotient = quotient * 1000 + digits
    return quotient + 1


def galloping(few: np.ndarray, many: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The places, in each of two sorted arrays of different numbers, of the numbers that both have.

    The shorter array is walked through in runs. From where the last run ended, steps that double find the stretch
    of the longer array that can hold a run; only there the run's numbers are looked up.
    """
    if len(few) > len(many):
        right, left = galloping(many, few)
        return left, right
    found_few, found_many, low = [], [], 0
    for start in range(0, len(few), RUN):
        run = few[start : start + RUN]
        step, high = 1, low
        while high < len(many) and many[high] <= run[-1]:
            low_known, high = high, high + step
            step *= 2
            if many[low_known] < run[0]:
                low = low_known
        at = low + np.searchsorted(many[low : min(high, len(many))], run)
        inside = np.flatnonzero(at < len(many))
        hit = inside[many[at[inside]] == run[inside]]
        found_few.append(hit + start)
        found_many.append(at[hit])
        low = int(at[-1])
    none = np.zeros(0, np.int64)
    return np.concatenate([none, *found_few]), np.concatenate([none, *found_many])


def _pair_value(a, b) -> int:
    """The sum of the differences of two groups' shares over the terms of a block."""
    if not a.block_terms:
        return 0
    own, other = galloping(a.numbers, b.numbers)
    both = np.abs(a.p[own] - b.p[other]).sum()
    only_a = np.abs(np.delete(a.p, own) - b.absent).sum()
    only_b = np.abs(np.delete(b.p, other) - a.absent).sum()
    neither = a.block_terms - len(a.p) - len(b.p) + len(own)
    return int(both + only_a + only_b + neither * abs(a.absent - b.absent))


class _Priced:
    """A group's row of one block: term numbers, their shares, and the share of a term it does not have."""

    def __init__(self, row) -> None:
        self.source, self.block_terms = row.source, row.block_terms
        self.numbers = np.asarray(row.numbers, np.int64)
        if self.block_terms:
            self.p = shares(np.asarray(row.counts, np.int64), row.total, row.kept)
            self.absent = int(shares(np.zeros(1, np.int64), row.total, row.kept)[0])


def _merged(key, left: pd.DataFrame, right: pd.DataFrame) -> pd.DataFrame:
    lang, i, j, _ = key
    own = [_Priced(row) for row in left.itertuples()]
    pairs = combinations(own, 2) if i == j else product(own, [_Priced(row) for row in right.itertuples()])
    rows = [(lang, a.source, b.source, _pair_value(a, b)) for a, b in pairs]
    return pd.DataFrame(rows, columns=["lang", "a", "b", "value"])


class Corpus:
    """The stored counts that both reports start from.

    ``groups``: (lang, source, total, kept), ``kept``: (lang, term, lang_n, block, number), ``counts``: (lang, source, term, n)
    of kept terms only, with block and number.
    """

    def __init__(self, docs: DataFrame, lang_col: str, source_col: str, text_col: str, least_docs: int, block: int):
        rows = docs.select(
            *(
                F.coalesce(F.col(f"`{given}`").cast("string"), F.lit("")).alias(name)
                for name, given in (("lang", lang_col), ("source", source_col), ("text", text_col))
            )
        )
        self.block = block
        found = saved(term_counts(rows), "term-counts")
        by_lang = found.groupBy("lang", "term").agg(F.sum("docs").alias("docs"), F.sum("n").alias("lang_n"))
        by_lang = saved(by_lang.where(F.col("docs") >= least_docs).drop("docs"), "kept-terms")
        per_lang = by_lang.groupBy("lang").agg(F.count("*").alias("kept"), F.sum("lang_n").alias("lang_total"))
        per_lang = saved(per_lang.withColumn("blocks", F.ceil(F.col("kept") / block).cast("int")), "kept-by-language")
        # A block holds about ``block`` terms, so numbering one is bounded work.
        place = F.pmod(F.xxhash64("term"), F.col("blocks")).cast("int")
        number = F.row_number().over(Window.partitionBy("lang", "block").orderBy("term")).cast("bigint")
        numbered = by_lang.join(per_lang, "lang").withColumn("block", place).withColumn("number", number)
        self.kept = saved(numbered.select("lang", "term", "lang_n", "block", "number"), "numbered-terms")
        self.counts = saved(found.drop("docs").join(self.kept, ["lang", "term"]), "kept-counts")
        totals = self.counts.groupBy(*GROUP).agg(F.sum("n").alias("total"))
        every = rows.select(*GROUP).distinct().join(totals, GROUP, "left").join(per_lang, "lang", "left")
        zero = F.lit(0).cast("bigint")
        self.groups = saved(
            every.select(
                *GROUP,
                *(F.coalesce(c, zero).alias(c) for c in ("total", "kept", "lang_total")),
                F.coalesce("blocks", F.lit(1)).alias("blocks"),
            ),
            "groups",
        )

    def block_rows(self) -> DataFrame:
        """Of every group and block: (lang, source, total, kept, block, block_terms, numbers, counts), arrays by number."""
        entry = F.array_sort(F.collect_list(F.struct("number", "n")))
        arrays = self.counts.groupBy(*GROUP, "block").agg(entry.alias("entries"))
        sizes = self.kept.groupBy("lang", "block").agg(F.count("*").alias("block_terms"))
        every = self.groups.select(*GROUP, "total", "kept", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("block"))
        none = F.array().cast("array<bigint>")
        return (
            every.join(sizes, ["lang", "block"], "left")
            .join(arrays, [*GROUP, "block"], "left")
            .select(
                *GROUP, "total", "kept", "block", F.coalesce("block_terms", F.lit(0)).alias("block_terms"),
                F.coalesce("entries.number", none).alias("numbers"), F.coalesce("entries.n", none).alias("counts"),
            )
        )


def source_pairs(corpus: Corpus, tile: int = TILE) -> DataFrame:
    """Rows (lang, source, item, value): the difference of every ordered pair of sources of a language."""
    place = F.row_number().over(Window.partitionBy("lang").orderBy("source")) - 1
    tiles = corpus.groups.select(*GROUP, F.floor(place / tile).cast("int").alias("tile"))
    tiles = tiles.withColumn("last", F.max("tile").over(Window.partitionBy("lang")))
    rows = saved(corpus.block_rows().join(tiles, GROUP), "block-rows")
    cell = ["lang", "i", "j", "block"]
    left = rows.withColumns({"i": F.col("tile"), "j": F.explode(F.sequence("tile", "last"))})
    right = rows.withColumns({"j": F.col("tile"), "i": F.explode(F.sequence(F.lit(0), F.col("tile")))})
    merged = left.groupBy(*cell).cogroup(right.groupBy(*cell)).applyInPandas(
        _merged, "lang string, a string, b string, value bigint"
    )
    pairs = saved(merged.groupBy("lang", "a", "b").agg(F.sum("value").alias("value")), "pairs")
    both = F.array(*(F.struct(F.col(x).alias("source"), F.col(y).alias("item")) for x, y in ("ab", "ba")))
    return pairs.select("lang", "value", F.explode(both).alias("way")).select("lang", "way.source", "way.item", "value")


def typical_terms(corpus: Corpus) -> DataFrame:
    """Rows (lang, source, item, value): by how much a group's share of a term it has exceeds its language's."""
    rows = corpus.counts.drop("block", "number").join(corpus.groups, GROUP)
    more = share(F.col("n"), F.col("total"), F.col("kept")) - share(F.col("lang_n"), F.col("lang_total"), F.col("kept"))
    return rows.select(*GROUP, F.col("term").alias("item"), more.alias("value")).where("value > 0")


def audit(
    docs: DataFrame,
    lang_col: str = "lang",
    source_col: str = "source",
    text_col: str = "text",
    least_docs: int = LEAST_DOCS,
    top: int = TOP,
    block: int = BLOCK,
    tile: int = TILE,
) -> DataFrame:
    """Rows (lang, source, part, item, value, rank): all sources as 'pair', the ``top`` terms as 'term', of each group."""
    corpus = Corpus(docs, lang_col, source_col, text_col, least_docs, block)
    order = Window.partitionBy(*GROUP).orderBy(F.desc("value"), "item")

    def ranked(rows: DataFrame, part: str) -> DataFrame:
        rank = F.row_number().over(order).alias("rank")
        return rows.select(*GROUP, F.lit(part).alias("part"), "item", "value", rank)

    terms = ranked(typical_terms(corpus), "term").where(F.col("rank") <= top)
    return ranked(source_pairs(corpus, tile), "pair").unionByName(terms)


ORACLE_SQL = rf"""
    WITH docs AS (
        SELECT row_number() OVER () AS d, coalesce(lang, '') AS lang, coalesce(source, '') AS source,
               coalesce(text, '') AS text FROM documents
    ),
    words AS (
        SELECT d, lang, source,
               unnest(regexp_extract_all(
                   translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                   '[^\x00-\x40\x5B-\x60\x7B-\x7F]+')) AS term
        FROM docs
    ),
    kept AS MATERIALIZED (
        SELECT lang, term FROM words GROUP BY lang, term HAVING count(DISTINCT d) >= {LEAST_DOCS}
    ),
    vocabulary AS (SELECT lang, count(*)::HUGEINT AS v FROM kept GROUP BY lang),
    groups AS (SELECT DISTINCT lang, source FROM docs),
    counts AS MATERIALIZED (
        SELECT lang, source, term, count(*)::HUGEINT AS n FROM words JOIN kept USING (lang, term) GROUP BY ALL
    ),
    totals AS (SELECT lang, source, sum(n) AS total FROM counts GROUP BY ALL),
    priced AS MATERIALIZED (
        SELECT lang, source, term, coalesce(n, 0) AS n,
               1 + ({SCALE}::HUGEINT * (coalesce(n, 0) + {SMOOTHING})) // (coalesce(total, 0) + {SMOOTHING} * v) AS p
        FROM groups JOIN kept USING (lang) JOIN vocabulary USING (lang) LEFT JOIN totals USING (lang, source)
             LEFT JOIN counts USING (lang, source, term)
    ),
    lang_sums AS (SELECT lang, term, sum(n) AS n FROM counts GROUP BY ALL),
    lang_counts AS (SELECT lang, term, n, sum(n) OVER (PARTITION BY lang) AS total FROM lang_sums),
    lang_priced AS (
        SELECT lang, term, 1 + ({SCALE}::HUGEINT * (n + {SMOOTHING})) // (total + {SMOOTHING} * v) AS q
        FROM lang_counts JOIN vocabulary USING (lang)
    ),
    pairs AS (
        SELECT a.lang, a.source, 'pair' AS part, b.source AS item, coalesce(value, 0)::BIGINT AS value
        FROM groups a JOIN groups b ON a.lang = b.lang AND a.source <> b.source
        LEFT JOIN (
            SELECT x.lang, x.source, y.source AS item, sum(abs(x.p - y.p)) AS value
            FROM priced x JOIN priced y ON x.lang = y.lang AND x.term = y.term AND x.source <> y.source GROUP BY ALL
        ) s ON s.lang = a.lang AND s.source = a.source AND s.item = b.source
    ),
    typical AS (
        SELECT lang, source, 'term' AS part, term AS item, (p - q)::BIGINT AS value
        FROM priced JOIN lang_priced USING (lang, term) WHERE n > 0 AND p > q
    ),
    ranked AS (
        SELECT *, row_number() OVER (PARTITION BY lang, source, part ORDER BY value DESC, encode(item))::INTEGER AS rank
        FROM (FROM pairs UNION ALL FROM typical)
    )
    SELECT lang, source, part, item, value, rank FROM ranked WHERE part = 'pair' OR rank <= {TOP}
"""
