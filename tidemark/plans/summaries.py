"""A table's descriptive statistics, kept up to date directory by directory.

For each directory and numeric column a summary is stored: count, mean, sum of squared deviations, extremes and a
quantile sketch. Summaries merge, so describing the whole table starts from them: only the passes that make its quartiles exact
still read rows. A directory is summed up again when its files have changed, and no other is.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from math import sqrt
from operator import and_

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.operators.describe import POOL_ROWS, describe_known, numeric
from tidemark.operators.profile import present
from tidemark.plans.compact import directory_files
from tidemark.sources.history import read_history

#: Size of a quantile sketch, and the error of its ranks.
SKETCH = 2_000
ERROR = 0.003

_SUMMARY = "`column` string, n bigint, mean double, m2 double, low double, high double, sketch binary, files bigint, bytes bigint"


def _same(columns: Sequence[str], left: str, right: str) -> Column:
    return reduce(and_, (F.col(f"{left}.`{c}`").eqNullSafe(F.col(f"{right}.`{c}`")) for c in columns))


def _schema(table: DataFrame, partition_by: Sequence[str]) -> str:
    kinds = dict(table.dtypes)
    return ", ".join([*(f"`{c}` {kinds[c]}" for c in partition_by), _SUMMARY, "run bigint"])


def _stored(spark: SparkSession, table: DataFrame, uri: str, partition_by: Sequence[str]) -> DataFrame | None:
    """The latest summaries of each directory."""
    every = read_history(spark, uri, _schema(table, partition_by))
    if every is None:
        return None
    last = every.groupBy(*(f"`{c}`" for c in partition_by)).agg(F.max("run").alias("run"))
    return every.alias("e").join(last.alias("l"), _same([*partition_by, "run"], "e", "l"), "left_semi")


def refresh_summaries(
    spark: SparkSession, table: DataFrame, uri: str, partition_by: Sequence[str], columns: Sequence[str] | None = None
) -> int:
    """Sum up the directories of a stored table that are new or whose files have changed; returns how many.

    ``table`` is the scan of the table. Which directories have changed is seen from footers; of the changed ones the
    numeric columns are read once. Missing values and not-a-numbers count as absent. A directory that is gone is left
    out when summaries are merged. A null directory value is one like any other.
    """
    names = list(columns) if columns is not None else [c for c in numeric(table) if c not in partition_by]
    place = [F.col(f"`{c}`") for c in partition_by]
    files = directory_files(table, tuple(partition_by))
    known = _stored(spark, table, uri, partition_by)
    due = files
    if known is not None:
        same = _same([*partition_by, "files", "bytes"], "f", "k")
        due = files.alias("f").join(known.select(*place, "files", "bytes").distinct().alias("k"), same, "left_anti")
    due = due.collect()
    if not due:
        return 0
    run = 1 + ((known.agg(F.max("run")).first()[0] or 0) if known is not None else 0)
    changed = spark.createDataFrame(due, files.schema)
    rows = table
    for c in partition_by:
        values = {r[c] for r in due}
        test = F.col(f"`{c}`").isin([v for v in values if v is not None])
        rows = rows.where(test | F.col(f"`{c}`").isNull() if None in values else test)
    rows = rows.alias("t").join(F.broadcast(changed.alias("d")), _same(partition_by, "t", "d"), "left_semi")
    values = rows.select(*place, *(present(table, c).cast("double").alias(f"_value_{i}") for i, c in enumerate(names)))

    def summary(i: int, name: str) -> Column:
        v = F.col(f"_value_{i}")
        return F.struct(
            F.lit(name).alias("column"), F.count(v).alias("n"), F.avg(v).alias("mean"),
            (F.var_pop(v) * F.count(v)).alias("m2"), F.min(v).alias("low"), F.max(v).alias("high"),
            F.kll_sketch_agg_double(v, F.lit(SKETCH)).alias("sketch"),
        )

    found = values.groupBy(*place).agg(F.array(*(summary(i, c) for i, c in enumerate(names))).alias("all"))
    found = found.select(*place, F.inline("all"))
    noted = found.alias("s").join(F.broadcast(changed.alias("d")), _same(partition_by, "s", "d"))
    columns_ = [*partition_by, "column", "n", "mean", "m2", "low", "high", "sketch"]
    noted = noted.select(*(f"s.`{c}`" for c in columns_), "d.files", "d.bytes", F.lit(run).cast("bigint").alias("run"))
    noted.coalesce(1).write.mode("append").parquet(uri)
    return len(due)


def describe_merged(
    spark: SparkSession, table: DataFrame, uri: str, partition_by: Sequence[str], *, pool_rows: int = POOL_ROWS
) -> DataFrame:
    """What ``describe`` gives for the table, from its stored summaries, which are brought up to date first.

    Count, mean, deviation and extremes follow from the summaries alone. Quartiles take their first cuts from the merged
    sketch; they are as exact as those of ``describe``, with two scans less. A table without rows has no columns here.
    """
    refresh_summaries(spark, table, uri, partition_by)
    known = _stored(spark, table, uri, partition_by)
    if known is None:
        return describe_known(table, [], lambda *_: [], ERROR)
    # Directories that are gone are none of the table's.
    present_now = directory_files(table, tuple(partition_by))
    known = known.alias("k").join(present_now.alias("f"), _same(partition_by, "k", "f"), "left_semi")
    mean = F.sum(F.col("mean") * F.col("n")) / F.sum("n")
    merged = known.groupBy("column").agg(
        F.sum("n").alias("n"), mean.alias("mean"), F.sum("m2").alias("m2"), F.min("low").alias("low"), F.max("high").alias("high"),
        F.kll_merge_agg_double(F.when(F.col("n") > 0, F.col("sketch")), F.lit(SKETCH)).alias("sketch"),
    )
    # Deviations within directories, and those of their means from the mean of all.
    between = known.join(merged.select("column", F.col("mean").alias("all_mean")), "column").groupBy("column").agg(
        F.sum(F.col("n") * F.pow(F.col("mean") - F.col("all_mean"), 2)).alias("between")
    )
    sums = {r["column"]: r for r in merged.join(between, "column").collect()}
    order = [c for c in table.columns if c in sums]

    def fact(r) -> tuple:
        # As in the usual deviation, a single value has none.
        std = sqrt((r["m2"] + (r["between"] or 0.0)) / (r["n"] - 1)) if r["n"] > 1 else None
        return r["column"], r["n"], r["mean"], std, r["low"], r["high"]

    def quantile(column: str, ranks: Sequence[float]) -> list[float]:
        held = spark.createDataFrame([(bytearray(sums[column]["sketch"]),)], "sketch binary")
        wanted = (F.kll_sketch_get_quantile_double("sketch", F.lit(float(r))).alias(str(i)) for i, r in enumerate(ranks))
        return list(held.select(*wanted).first())

    return describe_known(table, [fact(sums[c]) for c in order], quantile, ERROR, pool_rows=pool_rows)
