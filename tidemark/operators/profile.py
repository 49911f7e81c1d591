"""Profiling a table: preview, columns, nulls, value counts."""

from __future__ import annotations

import re
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, FloatType, LongType, StructField, StructType


def present(df: DataFrame, name: str) -> Column:
    """The column with not-a-number taken as missing, as data-frame profiling does."""
    value = F.col(f"`{name}`")
    if isinstance(df.schema[name].dataType, (DoubleType, FloatType)):
        return F.when(~F.isnan(value), value)
    return value


def head(df: DataFrame, order_by: Sequence[str | Column], n: int = 5) -> DataFrame:
    """The first ``n`` rows in a stated order; files of a distributed table have none."""
    return df.orderBy(*order_by).limit(n)


def column_info(df: DataFrame) -> DataFrame:
    """One row per column: position, name, type, number of values present."""
    places = _by_column(df, [F.struct(F.lit(i).alias("pos"), F.lit(t).alias("dtype"),
                                      F.count(present(df, c)).alias("non_null"))
                             for i, (c, t) in enumerate(df.dtypes)])
    return places.select("measure.pos", "column", "measure.dtype", "measure.non_null")


def null_counts(df: DataFrame) -> DataFrame:
    """One row per column: number of missing values."""
    missing = _by_column(df, [F.count_if(present(df, c).isNull()) for c in df.columns])
    return missing.select("column", F.col("measure").alias("nulls"))


def _by_column(df: DataFrame, measures: list[Column]) -> DataFrame:
    """All measures in one pass, then one row per column."""
    pairs = [
        F.struct(F.lit(c).alias("column"), m.alias("measure")) for c, m in zip(df.columns, measures, strict=True)
    ]
    return df.agg(F.array(*pairs).alias("all")).select(F.inline("all"))


def value_counts(df: DataFrame, name: str) -> DataFrame:
    """How often each value occurs, most frequent first; missing values are left out."""
    return (
        df.select(present(df, name).alias(name))
        .where(F.col(f"`{name}`").isNotNull())
        .groupBy(f"`{name}`")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy(F.desc("count"), F.asc(f"`{name}`"))
    )


def value_counts_multi(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """Value counts of several columns in one pass, values as text."""
    cells = [
        F.struct(F.lit(c).alias("column"), present(df, c).cast("string").alias("value")) for c in names
    ]
    return (
        df.select(F.inline(F.array(*cells)))
        .where(F.col("value").isNotNull())
        .groupBy("column", "value")
        .agg(F.count(F.lit(1)).alias("count"))
        .orderBy("column", F.desc("count"), "value")
    )


#: Groups that a column's values are dealt into by hash, at most 64 KiB of counters a task.
VALUE_GROUPS = 1 << 13


def top_values(df: DataFrame, name: str, k: int, *, groups: int = VALUE_GROUPS, first: int = 64) -> DataFrame:
    """The ``k`` most frequent values of a column, as the first rows of ``value_counts`` would have them.

    For columns with so many values that counting each of them would shuffle the table. Values are dealt into groups by
    hash and the groups are counted, which sends a bounded number of rows per task. No value is more frequent than its
    group, so only values of the largest groups are counted one by one: if the last of the ``k`` is more frequent
    than the next group as a whole, they are proven to be the top. Otherwise four times as many groups are taken, all of them
    at last. Missing values are left out; ties go to the lesser value; fewer values give fewer rows.
    """
    value = F.col(f"`{name}`")
    rows = df.select(present(df, name).alias(name)).where(value.isNotNull())
    # -0.0 equals 0.0 but has another hash.
    fractional = isinstance(df.schema[name].dataType, (DoubleType, FloatType))
    group = F.pmod(F.xxhash64(value + F.lit(0.0) if fractional else value), F.lit(groups)).cast("int")
    sizes = rows.groupBy(group.alias("group")).agg(F.count(F.lit(1)).alias("n")).orderBy(F.desc("n"), "group").collect()
    taken = max(first, k)
    while True:
        chosen = rows
        if taken < len(sizes):
            wanted = bytearray(groups)
            for row in sizes[:taken]:
                wanted[row["group"]] = 1
            # A byte for each group, looked up in the scan's own task without a join.
            chosen = rows.where(F.substring(F.lit(bytes(wanted)), group + 1, F.lit(1)) == F.lit(b"\x01"))
        counts = chosen.groupBy(f"`{name}`").agg(F.count(F.lit(1)).alias("count"))
        top = counts.orderBy(F.desc("count"), value).limit(k)
        if taken >= len(sizes):
            return top
        found = top.agg(F.count(F.lit(1)), F.min("count")).first()
        if found[0] == k and found[1] > sizes[taken]["n"]:
            return top
        taken *= 4



#: Files that are tried one after the other before empty ones are looked for.
TRIED_FILES = 8


def head_in_file_order(df: DataFrame, n: int = 5) -> DataFrame:
    """The first ``n`` rows as they stand in the files, in the order of the files' paths, with their ``position`` from 0.

    ``df`` is a file scan. One file is looked at after the other, and of a file one
    split after the other, until there are enough rows: usually the first split of the first file is all that is read.
    Only the ``n`` rows come to the driver. A scan without rows, or without files, gives no rows.
    """
    if "position" in df.columns:
        raise ValueError("the rows have a column position of their own")
    path = F.col("_metadata.file_path")
    rows: list = []

    def look(name: str) -> bool:
        # ``take`` runs the first partition alone; those of one file are its splits, in order.
        rows.extend(df.where(path == name).take(n - len(rows)))
        return len(rows) >= n

    # Both name files alike but for an empty authority.
    files = sorted(re.sub("^([A-Za-z0-9+.-]+):///", r"\1:/", name) for name in df.inputFiles())
    if n > 0 and not any(look(name) for name in files[:TRIED_FILES]) and len(files) > TRIED_FILES:
        rest = df.where(path > files[TRIED_FILES - 1]).groupBy(path.alias("path")).count()
        for row in rest.orderBy("path").limit(n - len(rows)).collect():
            if look(row["path"]):
                break
    schema = StructType([StructField("position", LongType(), False), *df.schema])
    return df.sparkSession.createDataFrame([(i, *row) for i, row in enumerate(rows)], schema)
