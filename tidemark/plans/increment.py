"""Layers brought up to date from what is new in the layer before.

A cleaned table follows the raw one by load time: a run looks at rows loaded since its mark, less some overlap for clocks
that disagree, and of these takes up the ones whose key is neither cleaned nor rejected yet. Every row it stores
has the run's time in ``REFINED``; summary tables follow by that column and rebuild just the directories that new rows
touch. Marks move after the work is stored, and work done twice adds nothing, so a run that died is repaired by the next.
"""

from __future__ import annotations

import time
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass, replace
from datetime import timedelta
from functools import reduce
from operator import and_, or_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.operators.dedupe import dedupe
from tidemark.operators.newrows import BROADCAST_KEY_BYTES, profile_keys
from tidemark.operators.sinks import overwrite
from tidemark.plans.ingest import ingest
from tidemark.plans.marks import read_mark, write_mark
from tidemark.plans.silver import Field, clean, split_rejects
from tidemark.sources.history import read_history, stored_columns
from tidemark.tables import TableSpec
from tidemark.workspace import fresh_dir

#: When a run stored a row, on every row of a table that follows another.
REFINED = "_refined_at"
LOADED = "_ingested_at"
#: How much earlier than the mark a row may have been loaded and still be looked at.
OVERLAP = timedelta(days=1)
#: Directories named one by one in a scan's filter; more are looked up by a join.
NAMED_DIRECTORIES = 10_000


@dataclass(frozen=True)
class SilverRefresh:
    """What a run did: rows that were due, and how many of them were added to the table and to the rejects."""

    table: str
    due: int
    appended: int
    rejected: int


def read_bronze(spark: SparkSession, uri: str, spec: TableSpec) -> DataFrame | None:
    """The raw table, with its load columns if it is stored with them."""
    if spec.schema is None:
        raise ValueError(f"{spec.name} has no declared types")
    rows = read_history(spark, uri, spec.schema)
    columns = None if rows is None else stored_columns(rows)
    if columns is None:
        return rows
    return read_history(spark, uri, spec.with_load_columns().schema) if LOADED in columns.names else rows


def _raw(name: str) -> Column:
    return F.col(f"`{name}`").cast("string")


def due_keys(
    bronze: DataFrame, spec: TableSpec, fields: Sequence[Field], silver: DataFrame | None, rejects: DataFrame | None
) -> DataFrame:
    """The keys, as raw texts, of raw rows that are neither cleaned nor rejected yet; reads key columns only."""
    key = list(spec.key)
    keys = clean(bronze.select(*(f"`{c}`" for c in key)), [f for f in fields if f.name in key])
    if silver is not None:
        keys = keys.join(silver.select(*(f"`{c}`" for c in key)), key, "left_anti")
    keys = keys.select("_texts.*")
    if rejects is not None:
        keys = keys.join(rejects.select(*(f"`{c}`" for c in key)), key, "left_anti")
    return keys.distinct()


def _rows_of(bronze: DataFrame, key: Sequence[str], keys: DataFrame) -> DataFrame:
    """The raw rows with one of the keys, which are broadcast if they were measured to be small."""
    profile = profile_keys(keys, key)
    wanted = keys.select(*(F.col(f"`{c}`").alias(f"_due_{i}") for i, c in enumerate(key)))
    if profile.key_bytes <= BROADCAST_KEY_BYTES:
        wanted = F.broadcast(wanted)
    same = reduce(and_, (_raw(c).eqNullSafe(F.col(f"_due_{i}")) for i, c in enumerate(key)))
    return bronze.join(wanted, same, "left_semi")


def _time(micros: int) -> Column:
    return F.timestamp_micros(F.lit(micros).cast("bigint"))


def _stored(rows: DataFrame, label: str) -> DataFrame:
    """Worked out once, for several readers."""
    path = fresh_dir(rows.sparkSession, label)
    rows.write.parquet(path)
    return read_history(rows.sparkSession, path, rows.schema)


def _last(rows: DataFrame, column: str) -> int | None:
    return rows.agg(F.unix_micros(F.max(column))).first()[0]


@dataclass(frozen=True)
class _Layout:
    """What the cleaned table and its rejects look like when stored."""

    table: TableSpec
    fit: StructType
    refused: StructType


def _layout(spark: SparkSession, spec: TableSpec, fields: Sequence[Field]) -> _Layout:
    none = spark.createDataFrame([], StructType([StructField(f.name, StringType()) for f in fields]))
    fit, refused = split_rejects(clean(none, fields))
    schema = fit.withColumn(REFINED, _time(0)).schema
    ddl = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema)
    return _Layout(replace(spec, schema=ddl), schema, refused.schema)


def read_silver(spark: SparkSession, uri: str, spec: TableSpec, fields: Sequence[Field]) -> DataFrame | None:
    """The cleaned table with the time each row was stored."""
    return read_history(spark, uri, _layout(spark, spec, fields).fit)


def refresh_silver(
    spark: SparkSession,
    bronze_uri: str,
    silver_uri: str,
    spec: TableSpec,
    fields: Sequence[Field],
    *,
    rejects_uri: str,
    overlap: timedelta = OVERLAP,
) -> SilverRefresh | None:
    """Clean the raw rows that came since the last run; ``None`` if nothing was ever loaded.

    Rows that qualify are added to the cleaned table, one per key, and stamped; the others are added, as they came, to
    the rejects. A raw table without load columns has all its keys, but only these, looked at. The raw table must be
    stored by ``ingest``, so that keys are not null and rows never change. Nulls, repeats and rows that tie are
    treated as in ``clean`` and ``ingest``; an empty raw table gives empty results and moves no mark.
    """
    bronze = read_bronze(spark, bronze_uri, spec)
    if bronze is None:
        return None
    high = None
    if LOADED in bronze.columns:
        mark = read_mark(spark, silver_uri, "bronze")
        if mark is not None:
            bronze = bronze.where(F.col(LOADED) >= _time(mark - overlap // timedelta(microseconds=1)))
        high = _last(bronze, LOADED)
        high = mark if high is None else max(high, mark or high)

    layout = _layout(spark, spec, fields)
    silver = read_history(spark, silver_uri, layout.fit)
    rejects = read_history(spark, rejects_uri, layout.refused)
    if silver is not None or rejects is not None:
        due = _stored(due_keys(bronze, spec, fields, silver, rejects), "due-keys")
        if due.isEmpty():
            return SilverRefresh(spec.name, 0, 0, 0)
        bronze = _rows_of(bronze, spec.key, due)
    stamp = _next_run(spark, silver_uri)
    fit, refused = split_rejects(_stored(clean(bronze, fields), "cleaned"))
    rejected = ingest(spark, refused, TableSpec(f"{spec.name} rejects", spec.key), rejects_uri)
    cleaned = ingest(spark, fit.withColumn(REFINED, _time(stamp)), layout.table, silver_uri)
    _moved(spark, silver_uri, stamp, high)
    return SilverRefresh(spec.name, cleaned.read + rejected.read, cleaned.appended, rejected.appended)


def rebuild_silver(
    spark: SparkSession, bronze_uri: str, silver_uri: str, spec: TableSpec, fields: Sequence[Field], *, rejects_uri: str
) -> SilverRefresh | None:
    """Replace the cleaned table and its rejects by all raw rows cleaned anew."""
    bronze = read_bronze(spark, bronze_uri, spec)
    if bronze is None:
        return None
    high = _last(bronze, LOADED) if LOADED in bronze.columns else None
    stamp = _next_run(spark, silver_uri)
    fit, refused = split_rejects(_stored(clean(bronze, fields), "cleaned"))
    rejected = overwrite(refused, rejects_uri)
    rows = dedupe(fit, spec.key, spec.preference()).withColumn(REFINED, _time(stamp))
    appended = overwrite(rows, silver_uri, spec.partition_by, spec.key)
    _moved(spark, silver_uri, stamp, high)
    return SilverRefresh(spec.name, bronze.count(), appended, rejected)


def _next_run(spark: SparkSession, uri: str) -> int:
    """A time for a new run over a table, in microseconds, after those of all runs before."""
    return max(time.time_ns() // 1000, (read_mark(spark, uri, "refined") or 0) + 1)


def _moved(spark: SparkSession, uri: str, stamp: int, high: int | None) -> None:
    write_mark(spark, uri, "refined", stamp)
    if high is not None:
        write_mark(spark, uri, "bronze", high)


@dataclass(frozen=True)
class FactRefresh:
    """Directories that were rebuilt, and the rows written to them."""

    directories: int
    rows: int


def new_since(rows: DataFrame, mark: int | None, until: int | None = None) -> DataFrame:
    """The rows that runs after ``mark`` stored, up to ``until``."""
    if mark is not None:
        rows = rows.where(F.col(REFINED) > _time(mark))
    return rows if until is None else rows.where(F.col(REFINED) <= _time(until))


def last_refined(rows: DataFrame) -> int | None:
    return _last(rows, REFINED)


def touched(rows: DataFrame, by: Mapping[str, Column], directories: DataFrame, named: int = NAMED_DIRECTORIES) -> DataFrame:
    """The rows that belong to one of the stored ``directories``.

    A few are named in a filter, which reaches the scan and prunes its directories where ``by`` follows from partition
    columns; beyond that a join finds them.
    """
    found = directories.limit(named + 1).collect()
    if len(found) <= named and len(by) == 1:
        ((_, place),) = by.items()
        values = [r[0] for r in found]
        tests = [place.isin([v for v in values if v is not None])] if any(v is not None for v in values) else []
        tests += [place.isNull()] if None in values else []
        return rows.where(reduce(or_, tests)) if tests else rows.limit(0)
    wanted = directories.select(*(F.col(f"`{c}`").alias(f"_touched_{c}") for c in by))
    same = reduce(and_, (place.eqNullSafe(F.col(f"`_touched_{c}`")) for c, place in by.items()))
    return rows.join(wanted, same, "left_semi")


def refresh_fact(
    spark: SparkSession,
    silver: DataFrame,
    build: Callable[[DataFrame], DataFrame],
    uri: str,
    by: Mapping[str, Column],
    *,
    named_directories: int = NAMED_DIRECTORIES,
) -> FactRefresh:
    """Rebuild the directories of a summary table that new cleaned rows touch, and no others.

    ``by`` gives the directory columns of the table as expressions over ``silver``; ``build`` makes the table's rows, with
    these columns, from cleaned rows, and must not mix rows of different directories. Directories are replaced one by one
    when all are written, so readers find each as it was or as it is, and never an empty table. Empty texts in a
    directory column must not occur; a null has a directory of its own.
    """
    mark, high = read_mark(spark, uri, "refined"), last_refined(silver)
    if high is None or high == mark:
        return FactRefresh(0, 0)
    new = new_since(silver, mark, high).select(*(c.alias(n) for n, c in by.items()))
    directories = _stored(new.distinct(), "touched")
    rows = overwrite(
        build(touched(silver, by, directories, named_directories)), uri, list(by), only_written_partitions=True
    )
    write_mark(spark, uri, "refined", high)
    return FactRefresh(directories.count(), rows)
