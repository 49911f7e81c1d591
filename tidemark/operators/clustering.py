"""A table's layout for look-ups by any of several columns."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import reduce
from operator import add

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F
from pyspark.sql.types import DataType, DateType, NumericType, StringType, TimestampNTZType, TimestampType

#: Bits of a column's rank: 255 cuts divide its rows into 256 parts.
BITS = 8
_PLACE = "_tidemark_place"


def _number(name: str, kind: DataType) -> Column:
    """A number in the column's order; of a text its first seven bytes."""
    value = F.col(f"`{name}`")
    if isinstance(kind, StringType):
        return F.conv(F.hex(F.substring(F.rpad(F.encode(value, "UTF-8"), F.lit(7), F.lit(b"\0")), 1, 7)), 16, 10).cast("bigint")
    if isinstance(kind, DateType):
        return F.unix_date(value)
    if isinstance(kind, (TimestampType, TimestampNTZType)):
        return F.unix_micros(value.cast("timestamp"))
    if isinstance(kind, NumericType):
        return value
    raise TypeError(f"{name}: {kind.simpleString()} has no ranks")


def _ranks(df: DataFrame, columns: Sequence[str], bits: int) -> list[Column]:
    """Each column's rank by quantiles, found in one pass; nulls rank with the lowest.

    Where many rows share a value, so do cuts: it has one rank, and the other columns divide its rows.
    """
    numbers = [_number(c, df.schema[c].dataType) for c in columns]
    shares = [i / (1 << bits) for i in range(1, 1 << bits)]
    cuts = df.agg(*(F.percentile_approx(n, shares).alias(f"c{i}") for i, n in enumerate(numbers))).first()
    steps = F.array(*(F.lit(1 << b) for b in reversed(range(bits))))

    def rank(number: Column, found: list | None) -> Column:
        if not found:
            return F.lit(0)
        known = F.array(*(F.lit(x) for x in found))

        def step(below: Column, s: Column) -> Column:
            return F.when(number > F.get(known, below + s - 1), below + s).otherwise(below)

        return F.aggregate(steps, F.lit(0), step)

    return [rank(n, found) for n, found in zip(numbers, cuts, strict=True)]


def place_of(df: DataFrame, columns: Sequence[str], bits: int = BITS) -> Column:
    """A row's place on a curve through all columns' ranks: their bits in turn, the highest first."""
    n, bits = len(columns), min(bits, 62 // len(columns))
    place = F.lit(0).cast("bigint")
    for i, rank in enumerate(_ranks(df, columns, bits)):
        # The rank is bound by a one-element array, for it is used once for every bit.
        place = place + F.element_at(F.transform(F.array(rank.cast("bigint")), _spread(bits, n, n - 1 - i)), 1)
    return place


def _spread(bits: int, width: int, offset: int) -> Callable[[Column], Column]:
    """Puts bit b of a number at place ``b * width + offset``."""

    def spread(rank: Column) -> Column:
        moved = [F.shiftleft(F.shiftright(rank, b).bitwiseAND(1), b * width + offset) for b in range(bits)]
        return reduce(add, moved)

    return spread


def append_clustered(
    df: DataFrame, uri: str, columns: Sequence[str], partition_by: Sequence[str] = (), bits: int = BITS, **options: str
) -> int:
    """Add rows to the table at ``uri``, near each other in all ``columns`` alike, and return how many were added.

    Sorted by one column after the other, a file holds a narrow range of the first only. Along the curve each file, and
    each row group in it, holds a narrow range of every column, so the Parquet statistics skip most of
    the table for a look-up by any of them. Columns may be numbers, dates, times or texts; nulls lie with the lowest
    values. ``options`` are those of the Parquet writer. The rows are looked at three times: for the ranks,
    for the ranges, and to write them.
    """
    order = [F.col(f"`{c}`") for c in partition_by] + [F.col(_PLACE)] + [F.col(f"`{c}`") for c in columns]
    rows = df.withColumn(_PLACE, place_of(df, columns, bits)).repartitionByRange(*order)
    written = Observation()
    rows = rows.observe(written, F.count(F.lit(1)).alias("rows")).sortWithinPartitions(*order).drop(_PLACE)
    rows.write.mode("append").options(**options).partitionBy(*partition_by).parquet(uri)
    return written.get["rows"]
