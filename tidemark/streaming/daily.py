"""Ingest the files that arrived since the last run."""

from __future__ import annotations

import threading

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.plans.bronze import with_load_columns
from tidemark.plans.ingest import IngestResult, ingest
from tidemark.tables import TableSpec


def ingest_available(
    stream: DataFrame,
    spec: TableSpec,
    uri: str,
    checkpoint: str,
    *,
    rejects_uri: str | None = None,
    batch_id: str | None = None,
    repeats_within: str | None = None,
) -> list[IngestResult]:
    """Ingest what ``stream`` has not delivered to this ``checkpoint`` yet, then stop.

    A micro-batch may be delivered twice after a failure; ingestion by key then adds
    nothing, so the table holds each key once.  For the same reason a lost checkpoint
    only costs time.  Rejected rows lie in ``rejects_uri`` under the ``run=`` that the checkpoint stands for and the
    ``batch=`` number: a batch delivered twice replaces its rejects, and no other run's are touched.

    ``repeats_within``, such as ``7 days``, also drops rows that repeat, in all their columns, one that arrived
    up to so long before, in whichever file: a file sent again costs no look into the table, and its rejects are not
    listed again.  Arrival is the time of the micro-batch, so no row is ever too late.  The state holds 128 bits of
    hash for every row of that time; a large inbox needs a state store that keeps it on disk.

    With a ``batch_id`` the load history is stored with each row; ``spec`` is then that of the
    table with its load columns, and ``stream`` a file scan.
    """
    results: list[IngestResult] = []
    columns = [F.col(f"`{c}`") for c in stream.columns]
    if batch_id is not None:
        stream = with_load_columns(stream, batch_id)
    if repeats_within is not None:
        stream = _without_repeats(stream, columns, repeats_within)
    started = threading.Event()

    def load(batch: DataFrame, number: int) -> None:
        started.wait()
        rejects = None if rejects_uri is None else f"{rejects_uri}/run={query.id}/batch={number}"
        results.append(ingest(batch.sparkSession, batch, spec, uri, rejects_uri=rejects, read_once=True))

    query = (
        stream.writeStream.foreachBatch(load)
        .option("checkpointLocation", checkpoint)
        .trigger(availableNow=True)
        .start()
    )
    started.set()
    query.awaitTermination()
    return results


def _without_repeats(stream: DataFrame, columns: list[Column], within: str) -> DataFrame:
    """The first of rows that agree in ``columns`` and arrive within some time of each other."""
    hashed = {"_row_1": F.xxhash64(*columns), "_row_2": F.xxhash64(F.lit(1), *columns, F.lit(2))}
    marked = stream.withColumns({**hashed, "_arrived": F.current_timestamp()}).withWatermark("_arrived", within)
    return marked.dropDuplicatesWithinWatermark([*hashed]).drop(*hashed, "_arrived")
