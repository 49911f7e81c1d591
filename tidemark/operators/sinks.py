"""Partitioned Parquet writes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Observation
from pyspark.sql import functions as F


def append(df: DataFrame, uri: str, partition_by: Sequence[str] = (), key: Sequence[str] = ()) -> int:
    """Add rows to the table at ``uri`` and return how many were added."""
    return _write(df, uri, partition_by, key, "append", {})


def overwrite(
    df: DataFrame,
    uri: str,
    partition_by: Sequence[str] = (),
    key: Sequence[str] = (),
    *,
    only_written_partitions: bool = False,
    tasks: int | None = None,
) -> int:
    """Replace the whole table, or just the partitions that ``df`` has rows for.

    With a ``key``, ``tasks`` says over how many tasks the rows are ranged.
    """
    mode = "dynamic" if only_written_partitions else "static"
    return _write(df, uri, partition_by, key, "overwrite", {"partitionOverwriteMode": mode}, tasks)


def _write(
    df: DataFrame,
    uri: str,
    partition_by: Sequence[str],
    key: Sequence[str],
    mode: str,
    options: dict[str, str],
    tasks: int | None = None,
) -> int:
    """Write once, counting on the way.

    The count sits in the stage that writes, where a task that is run again counts
    once; below a shuffle a re-run stage would be counted twice.
    """
    written = Observation()
    rows = _gathered(df, partition_by, key, tasks).observe(written, F.count(F.lit(1)).alias("rows"))
    order = _columns([*partition_by, *key])
    if order:
        rows = rows.sortWithinPartitions(*order)
    rows.write.mode(mode).options(**options).partitionBy(*partition_by).parquet(uri)
    return written.get["rows"]


def _gathered(
    df: DataFrame, partition_by: Sequence[str], key: Sequence[str], tasks: int | None = None
) -> DataFrame:
    """Bring a directory's rows together, in evenly sized tasks.

    With a ``key`` that is unique among the rows, ranges over directory and key do both:
    a directory with a third of all rows takes a third of the tasks, small ones share a
    task, and there are no more files than directories plus tasks.  The files of a
    directory hold separate key ranges, which later key look-ups can skip by.  Finding the
    ranges evaluates ``df`` once more back to its last shuffle or file scan.

    Without a key, adaptive execution cuts and packs tasks by size.
    """
    if key:
        places = _columns([*partition_by, *key])
        return df.repartitionByRange(tasks, *places) if tasks else df.repartitionByRange(*places)
    return df.hint("rebalance", *_columns(partition_by))


def _columns(names: Sequence[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in dict.fromkeys(names)]
