"""Vectors as short codes: product quantisation in whole numbers, exact at every step.

A component x becomes floor(4096 * x). A vector is cut into eight equal parts, and every part position has a codebook of
at most 16 entries, which rounds of assignment and averaging move. Nearest entries come from matrix products:
``|x - c|**2 = |x|**2 - 2 x.c + |c|**2``. For ``x.c`` both sides are broken into limbs so narrow that a float64 product
over a whole part stays below 2**53 and is exact. The products are put together in int64, or in numbers of any
length where a distance might not fit; the first smallest distance wins.

Every task passes on one sum per part, entry and position, Spark adds these, and only the codebooks (16 numbers for each
component of one vector) come to the driver. The vectors are read once a round and never shuffled.

Rows whose vector is null or holds null or non-finite components are dropped. Shorter vectors, empty ones included, count
as ending in zeros, and so does a length that eight does not divide. Rows may repeat, and each counts. The
codebooks start from the first rows by id (nulls last), then by vector; fewer rows give fewer entries. A null label is
a label. A distance beyond the range of a long is null, and so is a sum with such a distance. Other columns are not
looked at. An empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_schema
from pyspark.sql.types import LongType, StringType, StructField, StructType

from tidemark.llm.common import batch_of, saved

SCALE = 4096
PARTS = 8
ENTRIES = 16
ROUNDS = 6
#: Components that a task works on at a time.
BLOCK = 1 << 19
#: Sums leave a task in digits of this many bits, so that Spark's sums of them fit a long.
DIGIT = 40
LONGEST = (1 << 63) - 1


def peak(values: np.ndarray) -> int:
    """The largest magnitude, as a number of any length."""
    return max(abs(int(values.max())), abs(int(values.min()))) if values.size else 0


def whole_numbers(values: np.ndarray, scale: int = SCALE) -> np.ndarray:
    """floor(scale * x) of finite doubles; ``scale`` is a power of two. As int64 if all fit."""
    with np.errstate(over="ignore"):
        scaled = np.floor(values * scale)
    if not scaled.size or np.abs(scaled).max() < 2.0**62:
        return scaled.astype(np.int64)
    # A product beyond the doubles comes from a whole number.
    flat = [int(s) if np.isfinite(s) else int(x) * scale for s, x in zip(scaled.flat, values.flat, strict=True)]
    return np.array(flat, object).reshape(values.shape)


def limb_width(length: int) -> int:
    """Bits of a limb, so that a sum of ``length`` products of two limbs is at most 2**53."""
    return (53 - max(0, length - 1).bit_length()) // 2


def limbs(values: np.ndarray, width: int) -> list[np.ndarray]:
    """Doubles with ``values == sum(limb[k] << (k * width))``, none above 2**width; the last carries the sign."""
    found = []
    while peak(values) > 1 << width:
        found.append((values & ((1 << width) - 1)).astype(np.float64))
        values = values >> width
    return [*found, values.astype(np.float64)]


def products(rows: np.ndarray, entries: np.ndarray, kind: type) -> np.ndarray:
    """All dot products of rows with entries, exact; ``kind`` is int64, or object if they may not fit."""
    width = limb_width(rows.shape[1])
    total = np.zeros((len(rows), len(entries)), kind)
    right = limbs(entries, width)
    for i, a in enumerate(limbs(rows, width)):
        for j, b in enumerate(right):
            total += (a @ b.T).astype(np.int64).astype(kind) << width * (i + j)
    return total


def squared_distances(rows: np.ndarray, entries: np.ndarray) -> np.ndarray:
    """Of every row to every entry."""
    fits = rows.shape[1] * (2 * max(peak(rows), peak(entries))) ** 2 < 1 << 62
    kind = np.int64 if fits else object
    own, other = ((side.astype(kind) ** 2).sum(1) for side in (rows, entries))
    return own[:, None] - 2 * products(rows, entries, kind) + other[None, :]


def _column_sums(values: np.ndarray) -> list[int]:
    if values.dtype != object and peak(values) * len(values) >= 1 << 62:
        values = values.astype(object)
    return [int(x) for x in values.sum(0)]


def vector_width(longest: int, parts: int = PARTS) -> int:
    return max(1, -(-longest // parts)) * parts


def blocks(batch: pa.RecordBatch, width: int) -> Iterator[tuple[np.ndarray, np.ndarray]]:
    """(places of the rows that stay, their whole numbers), a block at a time."""
    most = max(1, BLOCK // width)
    for start in range(0, batch.num_rows, most):
        vectors = batch["embedding"].slice(start, most)
        lengths = vectors.value_lengths().fill_null(0).to_numpy(zero_copy_only=False).astype(np.int64)
        values = vectors.flatten().cast(pa.float64(), safe=False).to_numpy(zero_copy_only=False)
        row = np.repeat(np.arange(len(lengths)), lengths)
        place = np.arange(len(values)) - np.repeat(np.cumsum(lengths) - lengths, lengths)
        stays = vectors.is_valid().to_numpy(zero_copy_only=False)
        finite = np.isfinite(values)
        stays[row[~finite]] = False
        whole = np.zeros((len(lengths), width))
        whole[row[finite], place[finite]] = values[finite]
        at = np.flatnonzero(stays)
        if len(at):
            yield at + start, whole_numbers(whole[at])


def _assigned(numbers: np.ndarray, books: list[np.ndarray]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """For each part: its numbers, the nearest entries and the distances to them."""
    for part, book in zip(np.split(numbers, len(books), axis=1), books, strict=True):
        distances = squared_distances(part, book)
        nearest = distances.argmin(1)
        yield part, nearest, distances[np.arange(len(part)), nearest]


_SUMS = "part int, entry int, place int, digit int, total bigint"


def _digits(value: int) -> Iterator[tuple[int, int]]:
    sign, rest, k = (1 if value >= 0 else -1), abs(value), 0
    while rest:
        if rest % (1 << DIGIT):
            yield k, sign * (rest % (1 << DIGIT))
        rest >>= DIGIT
        k += 1


def _sums(books: list[np.ndarray], width: int):
    """Of every entry: the sum of its parts by place, and at place -1 their number."""

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = pa.schema([*((c, pa.int32()) for c in ("part", "entry", "place", "digit")), ("total", pa.int64())])
        totals: dict[tuple[int, int], list[int]] = {}
        for batch in batches:
            for _, numbers in blocks(batch, width):
                for p, (part, nearest, _) in enumerate(_assigned(numbers, books)):
                    for e in np.unique(nearest).tolist():
                        own = part[nearest == e]
                        added = [len(own), *_column_sums(own)]
                        before = totals.get((p, e), [0] * len(added))
                        totals[p, e] = [a + b for a, b in zip(before, added, strict=True)]
        rows = [
            (p, e, place - 1, k, digit)
            for (p, e), values in totals.items()
            for place, value in enumerate(values)
            for k, digit in _digits(value)
        ]
        yield batch_of(rows, out)

    return run


def _moved(books: list[np.ndarray], sums: DataFrame) -> list[np.ndarray]:
    """The books with every used entry at the floored mean of its parts."""
    added = sums.groupBy("part", "entry", "place", "digit").agg(F.sum("total").alias("total"))
    totals: dict[tuple[int, int, int], int] = {}
    for part, entry, place, digit, total in added.collect():
        key = (part, entry, place)
        totals[key] = totals.get(key, 0) + (total << DIGIT * digit)
    moved = []
    for p, book in enumerate(books):
        entries = [[int(x) for x in entry] for entry in book]
        for e, entry in enumerate(entries):
            n = totals.get((p, e, -1))
            if n:
                entries[e] = [totals.get((p, e, place), 0) // n for place in range(len(entry))]
        moved.append(_as_numbers(entries))
    return moved


def _as_numbers(entries: list[list[int]]) -> np.ndarray:
    fits = all(abs(x) < 1 << 62 for entry in entries for x in entry)
    return np.array(entries, np.int64 if fits else object)


def _coded(books: list[np.ndarray], width: int, out: pa.Schema):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at, numbers in blocks(batch, width):
                codes = np.empty((len(at), len(books)), np.int64)
                error = 0
                for p, (_, nearest, distance) in enumerate(_assigned(numbers, books)):
                    codes[:, p] = nearest
                    # Eight distances that fit a long need not fit one together.
                    error = error + (distance if int(distance.max()) < 1 << 56 else distance.astype(object))
                text = [bytes(row).hex() for row in codes.astype(np.uint8)]
                errors = [e if e <= LONGEST else None for e in error.tolist()]
                places = pa.array(at)
                yield pa.RecordBatch.from_arrays(
                    [batch["id"].take(places), batch["label"].take(places), pa.array(text), pa.array(errors, pa.int64())],
                    schema=out,
                )

    return run


def book_digest(books: list[np.ndarray]) -> str:
    """SHA-256 of all entries' components in decimal, by part, entry and position."""
    return hashlib.sha256(",".join(str(int(x)) for book in books for x in book.flat).encode()).hexdigest()


def learn_books(rows: DataFrame, parts: int = PARTS, entries: int = ENTRIES, rounds: int = ROUNDS):
    """(width, books) for rows (id, embedding, label); (0, []) if no row stays."""
    sound = F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    kept = rows.where(F.col("embedding").isNotNull() & sound)
    longest = kept.agg(F.max(F.size("embedding"))).first()[0]
    if longest is None:
        return 0, []
    width = vector_width(longest, parts)
    first = kept.orderBy(F.col("id").asc_nulls_last(), "embedding").limit(entries).select("embedding").collect()
    start = np.zeros((len(first), width))
    for row, (vector,) in zip(start, first, strict=True):
        row[: len(vector)] = vector
    books = np.split(whole_numbers(start), parts, axis=1)
    for _ in range(rounds):
        books = _moved(books, rows.mapInArrow(_sums(books, width), _SUMS))
    return width, books


def compress(
    vectors: DataFrame,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    parts: int = PARTS,
    entries: int = ENTRIES,
    rounds: int = ROUNDS,
) -> DataFrame:
    """Rows (id, label, code, error, label_error, codebooks_sha256), one for each row of ``vectors`` that stays.

    ``code`` has two hex digits for each part, so a book may have up to 256 entries.
    """
    if not 1 <= entries <= 256:
        raise ValueError("a code has two hex digits for each part: 1 to 256 entries")
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"),
        F.col(f"`{vector_col}`").alias("embedding"),
        F.col(f"`{label_col}`").alias("label"),
    )
    width, books = learn_books(rows, parts, entries, rounds)
    schema = StructType(
        [rows.schema["id"], rows.schema["label"], StructField("code", StringType()), StructField("error", LongType())]
    )
    if not books:
        coded = vectors.sparkSession.createDataFrame([], schema)
    else:
        coded = saved(rows.mapInArrow(_coded(books, width, to_arrow_schema(schema)), schema), "codes")
    # Stored, the sums meet the rows in a join whose large partitions Spark can split.
    total = F.sum(F.col("error").cast("decimal(38,0)"))
    total = F.when(F.count("error") == F.count(F.lit(1)), total.try_cast("bigint"))
    by_label = saved(coded.groupBy("label").agg(total.alias("label_error")), "label-errors")
    joined = coded.alias("c").join(by_label.alias("l"), F.expr("c.label <=> l.label"))
    return joined.select("c.*", "l.label_error", F.lit(book_digest(books)).alias("codebooks_sha256"))


def _oracle_sql() -> str:
    steps = []
    for k in range(ROUNDS + 1):
        steps.append(f"""
    near{k} AS MATERIALIZED (
        SELECT r, p, min(distance * {ENTRIES} + e) % {ENTRIES} AS e, min(distance * {ENTRIES} + e) // {ENTRIES} AS distance
        FROM (
            SELECT r, p, e, list_sum(list_transform(list_zip(x, c), lambda z: (z[1] - z[2]) * (z[1] - z[2]))) AS distance
            FROM parts JOIN book{k} USING (p)
        ) GROUP BY r, p
    )""")
        if k < ROUNDS:
            steps.append(f"""
    book{k + 1} AS MATERIALIZED (
        SELECT p, e, coalesce(m.c, b.c) AS c
        FROM book{k} b LEFT JOIN (
            SELECT p, e, list(((s - ((s % n + n) % n)) // n)::BIGINT ORDER BY i) AS c
            FROM (
                SELECT p, e, i, sum(x[i]) AS s, count(*) AS n
                FROM near{k} JOIN parts USING (r, p), size, unnest(range(1, d + 1)) t(i) GROUP BY p, e, i
            ) GROUP BY p, e
        ) m USING (p, e)
    )""")
    return f"""
    WITH kept AS (
        SELECT vec_id, label, list_transform(embedding, lambda x: floor({SCALE} * x::DOUBLE)::BIGINT) AS v
        FROM embeddings
        WHERE embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0
    ),
    size AS (SELECT max(len(v)) // {PARTS} AS d FROM kept),
    rows AS MATERIALIZED (SELECT *, row_number() OVER (ORDER BY vec_id NULLS LAST, v) AS r FROM kept),
    parts AS MATERIALIZED (
        SELECT r, p, v[p * d + 1 : p * d + d] AS x FROM rows, size, unnest(range({PARTS})) t(p)
    ),
    book0 AS MATERIALIZED (SELECT p, r - 1 AS e, x AS c FROM parts WHERE r <= {ENTRIES}),{",".join(steps)},
    books AS (
        SELECT sha256(string_agg(c[i]::VARCHAR, ',' ORDER BY p, e, i)) AS codebooks_sha256
        FROM book{ROUNDS}, size, unnest(range(1, d + 1)) t(i)
    ),
    coded AS (
        SELECT r, string_agg(format('{{:02x}}', e::BIGINT), '' ORDER BY p) AS code, sum(distance)::BIGINT AS error
        FROM near{ROUNDS} GROUP BY r
    )
    SELECT vec_id, code, error, (sum(error) OVER (PARTITION BY label))::BIGINT AS label_error, codebooks_sha256
    FROM rows JOIN coded USING (r), books
"""


#: The same with a list for each part; for vectors whose length eight divides.
ORACLE_SQL = _oracle_sql()
