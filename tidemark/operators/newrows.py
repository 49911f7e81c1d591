"""Which batch rows are not stored yet."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import (
    ByteType, DataType, DateType, DecimalType, IntegerType, LongType, ShortType, StringType,
)

from tidemark.operators.dedupe import dedupe
from tidemark.operators.keybitmap import MOST_BITS, bitmap_for
from tidemark.sources.csv import MALFORMED

# Upper bound for the batch's keys, counted before duplicates are removed, up to which they are broadcast.
BROADCAST_KEY_BYTES = 64 * 1024 * 1024
_ROW_BYTES = 16
_RANGED = (ByteType, ShortType, IntegerType, LongType, DateType, DecimalType, StringType)


def has_key(key: Sequence[str]) -> Column:
    return reduce(and_, (F.col(f"`{c}`").isNotNull() for c in key))


def sound_rows(batch: DataFrame, key: Sequence[str]) -> Column:
    """Whether a row has its key and is not a line that the CSV scan has set aside."""
    return has_key(key) & F.col(MALFORMED).isNull() if MALFORMED in batch.columns else has_key(key)


def new_rows(batch: DataFrame, history: DataFrame, key: Sequence[str]) -> DataFrame:
    """Batch rows whose key is not in ``history``; a null key matches nothing and stays."""
    return batch.join(history.select(*(f"`{c}`" for c in key)), on=list(key), how="left_anti").select(
        *(f"`{c}`" for c in batch.columns)
    )


@dataclass(frozen=True)
class KeyProfile:
    """Exact facts about a batch's keys, from one pass that reads only the columns it needs."""

    rows: int
    rows_without_key: int  # malformed lines not among them
    malformed: int
    key_bytes: int
    ranges: dict[str, tuple]  # column -> (lowest, highest, has nulls) over rows with a key

    @property
    def rejected(self) -> int:
        return self.rows_without_key + self.malformed

    def may_hold(self) -> list[Column]:
        """Conditions every stored row with one of the batch's keys meets."""
        tests = []
        for name, (low, high, nulls) in self.ranges.items():
            column = F.col(f"`{name}`")
            parts = [] if low is None else [column.between(F.lit(low), F.lit(high))]
            parts += [column.isNull()] if nulls else []
            if parts:
                tests.append(reduce(or_, parts))
        return tests


def profile_keys(batch: DataFrame, key: Sequence[str], stable: Sequence[str] = ()) -> KeyProfile:
    """Count rows and rejected rows, and find the key ranges and the keys' size in bytes."""
    keyed = sound_rows(batch, key)
    ranged = [c for c in dict.fromkeys([*key, *stable]) if isinstance(batch.schema[c].dataType, _RANGED)]

    def of_keyed(name: str) -> Column:
        return F.when(keyed, F.col(f"`{name}`"))

    measures = [F.count(F.lit(1)).alias("rows"), F.count_if(keyed).alias("keyed")]
    measures += [
        F.sum(F.octet_length(of_keyed(c).cast("string"))).alias(f"size:{c}")
        for c in key
        if not _fixed_width(batch.schema[c].dataType)
    ]
    for c in ranged:
        measures += [
            F.min(of_keyed(c)).alias(f"low:{c}"),
            F.max(of_keyed(c)).alias(f"high:{c}"),
            F.count_if(keyed & F.col(f"`{c}`").isNull()).alias(f"nulls:{c}"),
        ]
    if MALFORMED in batch.columns:
        measures.append(F.count(MALFORMED).alias("malformed"))
    found = batch.agg(*measures).first().asDict()
    return KeyProfile(
        rows=found["rows"],
        rows_without_key=found["rows"] - found["keyed"] - found.get("malformed", 0),
        malformed=found.get("malformed", 0),
        key_bytes=found["keyed"] * _ROW_BYTES * len(key)
        + sum(v or 0 for name, v in found.items() if name.startswith("size:")),
        ranges={c: (found[f"low:{c}"], found[f"high:{c}"], found[f"nulls:{c}"] > 0) for c in ranged},
    )


def _fixed_width(kind: DataType) -> bool:
    return isinstance(kind, _RANGED) and not isinstance(kind, StringType)


def unstored_rows(
    batch: DataFrame,
    history: DataFrame,
    key: Sequence[str],
    prefer: Sequence[Column | str],
    profile: KeyProfile,
    *,
    broadcast_key_bytes: int = BROADCAST_KEY_BYTES,
    bitmap_bits: int = MOST_BITS,
) -> DataFrame:
    """One row per key that has no stored row.  ``batch`` must hold no null keys.

    History is read for its key columns alone, and only where the batch's keys can lie:
    the ranges are pushed to the Parquet scan, so row groups and (for stable partition
    columns) directories outside them are skipped.

    Small batch: its keys, shown to fit the bound, go to the history scan, which thus is
    not shuffled; the keys found there are no more than the batch has, and are taken off
    before the batch is shuffled to drop duplicates.

    Large batch: duplicates are dropped first, which leaves one row per key and task
    before the shuffle; the anti-join then uses that same partitioning by key.  Of the
    history only rows that pass a bitmap of the batch's keys are shuffled, which matters where
    ranges do not tell the keys apart (hashed ids); a batch with too many keys for ``bitmap_bits`` goes without.
    """
    names = [f"`{c}`" for c in key]
    stored = reduce(DataFrame.where, profile.may_hold(), history).select(*names)
    if profile.key_bytes <= broadcast_key_bytes:
        wanted = F.broadcast(batch.select(*names))
        known = F.broadcast(stored.join(wanted, on=list(key), how="left_semi").distinct())
        return dedupe(new_rows(batch, known, key), key, prefer)
    bitmap = bitmap_for(profile.rows, [stored.schema[c].dataType for c in key], bitmap_bits) if bitmap_bits else None
    if bitmap is not None:
        stored = bitmap.thin_out(stored, batch.select(*names), key)
    return new_rows(dedupe(batch, key, prefer), stored, key)
