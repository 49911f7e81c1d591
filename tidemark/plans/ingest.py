"""Insert-only, repeatable ingestion of a batch into a stored table."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.dedupe import dedupe
from tidemark.operators.keybitmap import MOST_BITS
from tidemark.operators.newrows import BROADCAST_KEY_BYTES, profile_keys, sound_rows, unstored_rows
from tidemark.operators.sinks import append, overwrite
from tidemark.sources.csv import MALFORMED, MalformedRows
from tidemark.sources.history import read_history, stored_columns
from tidemark.tables import TableSpec

#: Rows of a kept batch that a task reads, about.
TASK_ROWS = 500_000


class SchemaMismatch(ValueError):
    """The batch does not have the columns or types of the table."""


@dataclass(frozen=True)
class IngestResult:
    table: str
    first_load: bool
    read: int
    rejected: int
    appended: int


# Type changes that keep every value.
_WIDENING = {
    ("tinyint", "smallint"), ("tinyint", "int"), ("tinyint", "bigint"), ("smallint", "int"), ("smallint", "bigint"),
    ("int", "bigint"), ("tinyint", "double"), ("smallint", "double"), ("int", "double"), ("float", "double"),
}


def conform(batch: DataFrame, wanted: StructType) -> DataFrame:
    """The batch with the columns, order and types of ``wanted``; raises when values could change.

    The lines a CSV scan has set aside stay beside it.
    """
    aside = [F.col(MALFORMED)] if MALFORMED in batch.columns else []
    missing = [f.name for f in wanted if f.name not in batch.columns]
    extra = [c for c in batch.columns if c not in wanted.names and c != MALFORMED]
    if missing or extra:
        raise SchemaMismatch(f"columns missing from the batch: {missing}; not in the table: {extra}")
    kinds = dict(batch.dtypes)
    wrong = [
        f"{f.name}: {kinds[f.name]} instead of {f.dataType.simpleString()}"
        for f in wanted
        if kinds[f.name] != f.dataType.simpleString()
        and (kinds[f.name], f.dataType.simpleString()) not in _WIDENING
    ]
    if wrong:
        raise SchemaMismatch("; ".join(wrong))
    return batch.select(*(F.col(f"`{f.name}`").cast(f.dataType) for f in wanted), *aside)


def as_stored(batch: DataFrame, spec: TableSpec) -> DataFrame:
    """Empty texts in partition columns as nulls, which is how a directory gives them back.

    Rows are thus compared in the form in which they are stored.
    """
    kinds = dict(batch.dtypes)
    texts = [c for c in spec.partition_by if kinds.get(c) == "string"]
    return batch.withColumns({c: F.nullif(F.col(f"`{c}`"), F.lit("")) for c in texts}) if texts else batch


def ingest(
    spark: SparkSession,
    batch: DataFrame,
    spec: TableSpec,
    uri: str,
    *,
    rejects_uri: str | None = None,
    broadcast_key_bytes: int = BROADCAST_KEY_BYTES,
    bitmap_bits: int = MOST_BITS,
    read_once: bool = False,
) -> IngestResult:
    """Append to ``uri`` the batch rows whose key is not stored there, one row per key.

    Running a batch again adds nothing, also after a failed run that stored a part of
    it.  A stored row never changes: a batch row with a known key and other attributes
    is left out.  Rows without a key are counted as rejected and never stored in the
    table, and so are the lines that ``read_csv`` has set aside as malformed; with
    ``rejects_uri`` they replace what that path holds, so give each batch its own.  Malformed lines without
    ``rejects_uri`` raise ``MalformedRows``, before anything is written.

    The batch is looked at two or three times, large ones once more for the bitmap of their keys.  ``read_once``
    keeps it on the executors' disks after the first, which pays for input that is costly to read, such as CSV,
    where every look parses all columns, and packs its parts for the later looks by the number of its rows.

    One writer per table: two runs at the same time may both add the same key.
    """
    options = {"rejects_uri": rejects_uri, "broadcast_key_bytes": broadcast_key_bytes, "bitmap_bits": bitmap_bits}
    if not read_once:
        return _ingest(spark, batch, spec, uri, **options)
    kept = batch.persist(StorageLevel.DISK_ONLY)
    try:
        return _ingest(spark, kept, spec, uri, packed=True, **options)
    finally:
        kept.unpersist()


def _tasks(spark: SparkSession, rows: int) -> int:
    """Tasks for kept rows: one for each core, and more where one would get over ``TASK_ROWS``."""
    return max(spark.sparkContext.defaultParallelism, -(-rows // TASK_ROWS))


def _ingest(
    spark: SparkSession,
    batch: DataFrame,
    spec: TableSpec,
    uri: str,
    *,
    rejects_uri: str | None,
    broadcast_key_bytes: int,
    bitmap_bits: int,
    packed: bool = False,
) -> IngestResult:
    """As ``ingest``. ``packed``: the batch is kept, in as many parts as a stream's state has, and few tasks read several each.

    A shuffle writes a file for each of its two sides' pairs of tasks, and a stream has no adaptive execution to pack them.
    """
    if spec.schema is not None:
        batch = conform(batch, StructType.fromDDL(spec.schema))
    batch = as_stored(batch, spec)
    fields = batch.drop(MALFORMED).schema
    history = read_history(spark, uri, fields)
    stored = None if history is None else stored_columns(history)
    if stored is None:
        history = None
    else:
        kinds = batch.dtypes
        directories = [f for f in fields if f.name in spec.partition_by]
        batch = conform(batch, StructType([*stored, *directories])).select(*(f"`{c}`" for c in batch.columns))
        if batch.dtypes != kinds:
            history = read_history(spark, uri, batch.drop(MALFORMED).schema)

    sound = sound_rows(batch, spec.key)
    profile = profile_keys(batch, spec.key, spec.stable)
    if profile.malformed and rejects_uri is None:
        raise MalformedRows(f"{profile.malformed} lines do not have the columns and types of {spec.name}")
    if rejects_uri is not None:
        if profile.rejected:
            overwrite(batch.where(~sound), rejects_uri)
        elif read_history(spark, rejects_uri, batch.schema) is not None:
            overwrite(batch.limit(0), rejects_uri)  # those of an earlier batch are not this one's
    if history is not None and profile.rejected == profile.rows:
        # Nothing to look up, as in a micro-batch of repeats or one that only moves a stream's watermark.
        return IngestResult(spec.name, first_load=False, read=profile.rows, rejected=profile.rejected, appended=0)
    keyed = batch.where(sound).drop(MALFORMED)
    if packed:
        keyed = keyed.coalesce(_tasks(spark, profile.rows))
    if history is None:
        fresh = dedupe(keyed, spec.key, spec.preference())
    else:
        fresh = unstored_rows(
            keyed, history, spec.key, spec.preference(), profile,
            broadcast_key_bytes=broadcast_key_bytes, bitmap_bits=bitmap_bits,
        )
    if packed:
        fresh = fresh.coalesce(_tasks(spark, profile.rows))
    # The write looks at the new rows once to find ranges before it moves them.  Kept on the
    # executors' disks, they are not joined and sorted twice; a lost copy is computed again.
    fresh = fresh.persist(StorageLevel.DISK_ONLY)
    try:
        # A batch that was loaded before needs no ranges and no commit; a first load creates the table, even without rows.
        nothing = history is not None and fresh.isEmpty()
        appended = 0 if nothing else append(fresh, uri, spec.partition_by, key=spec.key)
    finally:
        fresh.unpersist()
    return IngestResult(
        table=spec.name,
        first_load=history is None,
        read=profile.rows,
        rejected=profile.rejected,
        appended=appended,
    )
