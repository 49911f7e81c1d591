"""Load history of the stored raw layer."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def with_load_columns(df: DataFrame, batch_id: str, *, from_files: bool = True) -> DataFrame:
    """Note on every row which load brought it, from which file, and when.

    Call it directly on a file scan; pass ``from_files=False`` for rows that have no file.
    """
    source = F.col("_metadata.file_path") if from_files else F.lit(None).cast("string")
    return df.select(
        "*",
        F.lit(batch_id).alias("_batch_id"),
        source.alias("_source_file"),
        F.current_timestamp().alias("_ingested_at"),
    )
