"""Statistics from stored summaries of directories: equal to describing the whole table."""

import math

import pytest
from pyspark.sql import functions as F

from tidemark.operators import append, describe
from tidemark.plans import summaries
from tidemark.plans.summaries import describe_merged, refresh_summaries

SCHEMA = "k bigint, v double, w int, s string, d string"


class Table:
    def __init__(self, spark, path):
        self.spark, self.uri, self.sums = spark, f"{path}/t", f"{path}/s"

    def add(self, rows):
        append(rows, self.uri, ["d"], ["k"])

    def scan(self):
        return self.spark.read.schema(SCHEMA).parquet(self.uri)

    def merged(self, **options):
        return rows_of(describe_merged(self.spark, self.scan(), self.sums, ["d"], **options))

    def expected(self):
        return rows_of(describe(self.scan()))


def rows_of(found):
    return {r["column"]: tuple(r)[1:] for r in found.collect()}


def alike(found, expected):
    assert set(found) == set(expected)
    for name, row in expected.items():
        for i, (a, b) in enumerate(zip(found[name], row, strict=True)):
            if i in (1, 2):  # mean and deviation may differ in the last digits
                assert (a is None) == (b is None) and (a is None or math.isclose(a, b, rel_tol=1e-9, abs_tol=1e-9)), name
            else:
                assert a == b, (name, i)


def days(spark, n, days, offset=0):
    k = F.col("id") + offset
    return spark.range(n).select(
        k.alias("k"),
        F.when(k % 11 == 0, float("nan")).when(k % 7 == 0, None).when(k % 3 == 0, 5.0).otherwise((k * 7919 % 10007) / 7).alias("v"),
        (k % 5).cast("int").alias("w"), F.lit("x").alias("s"),
        F.when(k % days == 0, None).otherwise((k % days).cast("string")).alias("d"),
    )


@pytest.mark.parametrize("pool_rows", [1_000_000, 1_000])
def test_equals_describing_the_table(spark, tmp_path, pool_rows):
    table = Table(spark, tmp_path)
    table.add(days(spark, 6000, 6))
    alike(table.merged(pool_rows=pool_rows), table.expected())
    table.add(days(spark, 3000, 9, 10_000))
    alike(table.merged(pool_rows=pool_rows), table.expected())


def test_only_changed_directories_are_read(spark, tmp_path):
    table = Table(spark, tmp_path)
    table.add(days(spark, 500, 5))
    assert refresh_summaries(spark, table.scan(), table.sums, ["d"]) == 5
    assert refresh_summaries(spark, table.scan(), table.sums, ["d"]) == 0
    table.add(days(spark, 50, 5).withColumn("d", F.lit("new")))
    assert refresh_summaries(spark, table.scan(), table.sums, ["d"]) == 1
    table.add(spark.createDataFrame([(9_000, 1.0, 1, "x", None)], SCHEMA))
    assert refresh_summaries(spark, table.scan(), table.sums, ["d"]) == 1
    alike(table.merged(), table.expected())


def test_two_scans_less(spark, tmp_path, monkeypatch):
    """Neither the summary nor a sample is read once the summaries are there."""
    table = Table(spark, tmp_path)
    table.add(days(spark, 20_000, 4))
    refresh_summaries(spark, table.scan(), table.sums, ["d"])

    def unexpected(*_):
        raise AssertionError("the table was read")

    expected = table.expected()
    import sys

    module = sys.modules["tidemark.operators.describe"]
    monkeypatch.setattr(module, "_summary", unexpected)
    monkeypatch.setattr(module, "_suggest", unexpected)
    alike(table.merged(pool_rows=1_000), expected)


def test_a_wrong_sketch_costs_a_pass_only(spark, tmp_path, monkeypatch):
    table = Table(spark, tmp_path)
    table.add(days(spark, 9000, 3))
    monkeypatch.setattr(summaries, "ERROR", 0.0)
    alike(table.merged(pool_rows=1_000), table.expected())


def test_a_directory_that_is_gone(spark, tmp_path):
    table = Table(spark, tmp_path)
    table.add(days(spark, 400, 4))
    table.merged()
    days(spark, 100, 2).where("d = '1'").write.mode("overwrite").partitionBy("d").parquet(table.uri)
    alike(table.merged(), table.expected())


def test_no_values_single_values_and_no_rows(spark, tmp_path):
    table = Table(spark, tmp_path)
    table.add(spark.createDataFrame([(1, None, None, None, "a"), (2, float("nan"), 3, None, "b")], SCHEMA))
    alike(table.merged(), table.expected())
    empty = Table(spark, tmp_path / "empty")
    empty.add(spark.createDataFrame([], SCHEMA))
    assert empty.merged() == {}
