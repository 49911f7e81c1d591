"""What the operators of this folder share."""

from __future__ import annotations

from collections.abc import Iterable, Iterator, Sequence
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.workspace import fresh_dir


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def saved(df: DataFrame, label: str) -> DataFrame:
    """The rows, written to the shared folder and read again.

    Later steps then start from stored files: they do not repeat the work before, and a lost
    executor costs no more than its own tasks.
    """
    spark = df.sparkSession
    path = fresh_dir(spark, label)
    df.write.parquet(path)
    return spark.read.schema(df.schema).parquet(path)


def _known_by(id_col: str, text_col: str) -> dict[str, Column]:
    text = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    return {
        "id": F.col(f"`{id_col}`").cast("bigint"),
        "n_chars": F.length(text).cast("bigint"),
        "mark": F.xxhash64(text),
        "text": text,
    }


def known_rows(docs: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """Rows (id, n_chars, mark, text): length and hash of the text tell rows of one id apart."""
    return docs.select(*(value.alias(name) for name, value in _known_by(id_col, text_col).items()))


def rows_that_stay(docs: DataFrame, decided: DataFrame, id_col: str, text_col: str) -> DataFrame:
    """The rows of ``docs`` that were decided to stay, with all their columns.

    ``decided`` is stored and has (id, n_chars, mark, kept) for each row of ``docs``. Of rows that agree in the
    first three one stays, if any does.
    """
    key = ["id", "n_chars", "mark"]
    # Names that no column of the documents has.
    mine = "_gone"
    while any(c.lower().startswith(mine) for c in docs.columns):
        mine = f"_{mine}"
    stay = decided.groupBy(*key).agg(F.max("kept").alias("any_kept"), F.count("*").alias("n"))
    gone = stay.where("not any_kept").select(*(F.col(c).alias(f"{mine}_{c}") for c in key))
    own = _known_by(id_col, text_col)
    same = F.lit(True)
    for name in key:
        same = same & own[name].eqNullSafe(F.col(f"{mine}_{name}"))
    rest = docs.join(gone, same, "left_anti")
    if stay.where("any_kept and n > 1").isEmpty():
        return rest
    rank = F.row_number().over(Window.partitionBy(*(own[c] for c in key)).orderBy(*(f"`{c}`" for c in docs.columns)))
    return rest.withColumn(mine, rank).where(F.col(mine) == 1).drop(mine)


def utf8(values: pa.Array) -> Iterator[bytes]:
    """Each text of an Arrow column as its bytes, null as none; one text at a time."""
    for value in values.cast(pa.large_binary()):
        yield value.as_py() or b""


def texts(values: pa.Array) -> Iterator[str]:
    for value in values:
        yield value.as_py() or ""


def in_parts(rows: Iterable[tuple], schema: pa.Schema, most: int = 20_000) -> Iterator[pa.RecordBatch]:
    """Rows as record batches of at most ``most`` rows."""
    part: list[tuple] = []
    for row in rows:
        part.append(row)
        if len(part) == most:
            yield batch_of(part, schema)
            part = []
    if part:
        yield batch_of(part, schema)


def batch_of(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    columns = zip(*rows, strict=True) if rows else ([] for _ in schema)
    return pa.RecordBatch.from_arrays(
        [pa.array(list(c), field.type) for c, field in zip(columns, schema, strict=True)], schema=schema
    )


def whole_groups(batches: Iterable[pa.RecordBatch], key: Sequence[str]) -> Iterator[Iterator[pa.Table]]:
    """For rows that come ordered by integer keys: the groups that each batch completes.

    The last group of a batch may go on in the next and waits for it.
    """

    def cuts(rows: pa.Table) -> np.ndarray:
        """Where a row is of another group than the one before."""
        different = np.zeros(max(0, len(rows) - 1), bool)
        for c in key:
            values = rows[c].to_numpy()
            different |= values[1:] != values[:-1]
        return np.flatnonzero(different) + 1

    def groups(rows: pa.Table) -> Iterator[pa.Table]:
        bounds = [0, *cuts(rows).tolist(), len(rows)]
        return (rows.slice(a, b - a) for a, b in pairwise(bounds) if b > a)

    waiting: pa.Table | None = None
    for batch in batches:
        rows = pa.Table.from_batches([batch])
        if waiting is not None:
            rows = pa.concat_tables([waiting, rows])
        ends = cuts(rows)
        done = int(ends[-1]) if len(ends) else 0
        yield groups(rows.slice(0, done))
        waiting = rows.slice(done)
    if waiting is not None:
        yield groups(waiting)
