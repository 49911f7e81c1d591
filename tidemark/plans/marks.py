"""How far a table has followed another one.

A mark is a number kept beside the table's files, in a folder that scans of the table skip. Marks are only ever
added, after the work they stand for is stored, so a run that dies leaves the mark before and its work is done again.
"""

from __future__ import annotations

from pyspark.sql import SparkSession
from pyspark.sql import functions as F

from tidemark.sources.history import read_history

_SCHEMA = "place bigint, value bigint"


def _path(uri: str, name: str) -> str:
    return f"{uri.rstrip('/')}/_marks/{name}"


def _last(spark: SparkSession, uri: str, name: str) -> tuple[int, int | None]:
    marks = read_history(spark, _path(uri, name), _SCHEMA)
    if marks is None:
        return 0, None
    place, value = marks.agg(F.max("place"), F.max_by("value", "place")).first()
    return place or 0, value


def read_mark(spark: SparkSession, uri: str, name: str) -> int | None:
    """The mark written last, or ``None``."""
    return _last(spark, uri, name)[1]


def write_mark(spark: SparkSession, uri: str, name: str, value: int) -> None:
    place, last = _last(spark, uri, name)
    if value != last:
        added = spark.createDataFrame([(place + 1, value)], _SCHEMA).coalesce(1)
        added.write.mode("append").parquet(_path(uri, name))
