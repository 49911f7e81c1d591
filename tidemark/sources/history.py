"""Reading what is already stored."""

from __future__ import annotations

from urllib.parse import unquote

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType


def read_history(spark: SparkSession, uri: str, schema: StructType | str) -> DataFrame | None:
    """The stored table, or ``None`` when nothing was ever stored at ``uri``.

    A missing path is the only condition that means "no history"; anything else
    (no permission, damaged files, an unreachable store) is raised, since taking it
    for a first load would store the whole batch a second time.

    The declared schema keeps partition values in their type (``'07'`` stays text),
    saves the footer read of schema inference, and makes a path without data files
    read as zero rows.
    """
    try:
        return spark.read.schema(schema).parquet(uri)
    except AnalysisException as error:
        if error.getCondition() == "PATH_NOT_FOUND":
            return None
        raise


def stored_columns(history: DataFrame) -> StructType | None:
    """The columns inside the stored files (partition columns are not among them).

    One row is looked up to learn one file's name, and that file's footer is read; the
    table is not listed a second time.  The path comes URI-encoded.  ``None`` when no rows are stored.
    """
    sample = history.select("_metadata.file_path").head(1)
    if not sample:
        return None
    return history.sparkSession.read.parquet(unquote(sample[0].file_path)).schema
