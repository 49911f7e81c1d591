"""One defined row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import ArrayType, DataType, MapType, StructType, VariantType


def dedupe(df: DataFrame, key: Sequence[str], prefer: Sequence[Column | str] = ()) -> DataFrame:
    """Keep, for every key, the row that comes first in the ``prefer`` order.

    Rows still tied are ordered by their remaining columns, so the survivor is the same
    for any partitioning of the input and for a task that is run again after an
    executor was lost.  Rows whose key is null form one group, like any other key.

    Spark keeps one row per key in each task before the shuffle (``WindowGroupLimit``),
    so a key with a third of all rows sends one row per input task to its reducer.
    """
    rest = [F.col(f"`{f.name}`") for f in df.schema if f.name not in key and _sortable(f.dataType)]
    order = [*prefer, *rest] or [F.col(f"`{key[0]}`")]
    rank = F.row_number().over(Window.partitionBy(*(f"`{c}`" for c in key)).orderBy(*order))
    return df.withColumn("_tidemark_rank", rank).where("_tidemark_rank = 1").drop("_tidemark_rank")


def _sortable(kind: DataType) -> bool:
    if isinstance(kind, ArrayType):
        return _sortable(kind.elementType)
    if isinstance(kind, StructType):
        return all(_sortable(f.dataType) for f in kind)
    return not isinstance(kind, (MapType, VariantType))
