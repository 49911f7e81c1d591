"""The layout along a curve: each column alone prunes row groups."""

import glob
from datetime import date, datetime

import pyarrow.parquet as pq
import pytest
from pyspark.sql import functions as F

from __spark_entry__ import SMOKE_DIR
from tidemark.operators import append
from tidemark.operators.clustering import append_clustered, place_of

COLUMNS = ["l_orderkey", "l_partkey", "l_suppkey"]
SMALL = {"parquet.block.size": "65536", "parquet.page.size": "8192", "parquet.block.size.row.check.min": "50"}


def kept_share(path, column, value):
    """The share of row groups whose statistics do not rule a value out."""
    kept = total = 0
    for name in glob.glob(f"{path}/**/*.parquet", recursive=True):
        footer = pq.ParquetFile(name).metadata
        at = footer.schema.names.index(column)
        for i in range(footer.num_row_groups):
            found = footer.row_group(i).column(at).statistics
            total += 1
            kept += found.min <= value <= found.max
    return kept / total, total


def test_each_column_alone_prunes_row_groups(spark, tmp_path):
    lines = spark.read.parquet(f"{SMOKE_DIR}/lineitem.parquet")
    clustered, sorted_ = str(tmp_path / "clustered"), str(tmp_path / "sorted")
    n = lines.count()
    before = spark.conf.get("spark.sql.shuffle.partitions")
    spark.conf.set("spark.sql.shuffle.partitions", "64")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        assert append_clustered(lines, clustered, COLUMNS, **SMALL) == n
        append(lines, sorted_, (), COLUMNS)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before)
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    for column in COLUMNS:
        values = lines.agg(F.percentile_approx(column, [0.1, 0.3, 0.4, 0.6, 0.9])).first()[0]
        shares, totals = zip(*(kept_share(clustered, column, value) for value in values))
        # Each column has two bits of the 64 files' places: a quarter of them, and those that lie across a bound.
        assert min(totals) >= 60 and sum(shares) / len(shares) < 0.5
    assert kept_share(sorted_, "l_suppkey", 5)[0] > 0.9
    assert spark.read.parquet(clustered).exceptAll(lines).count() == 0


def test_a_hot_value_is_divided_by_the_other_column(spark, tmp_path):
    rows = spark.range(9000).select(F.when(F.col("id") % 3 == 0, 7).otherwise(F.col("id")).alias("a"), (F.col("id") * 7919 % 9000).alias("b"))
    places = rows.select("a", place_of(rows, ["a", "b"]).alias("p"))
    assert places.where("a = 7").select("p").distinct().count() > 100
    assert append_clustered(rows, str(tmp_path / "t"), ["a", "b"]) == 9000


def test_places_follow_both_columns(spark):
    rows = spark.createDataFrame([(x, y) for x in range(16) for y in range(16)], "x int, y int")
    found = {(r.x, r.y): r.p for r in rows.select("x", "y", place_of(rows, ["x", "y"], 4).alias("p")).collect()}
    assert sorted(found.values()) == list(range(256))
    assert {k for k, p in found.items() if p < 64} == {(x, y) for x in range(8) for y in range(8)}


@pytest.mark.parametrize(
    "kind, values",
    [
        ("string", ["", "a", "ab", "é", "zzzzzzzzzz", None]), ("date", [date(1960, 1, 1), date(2020, 1, 1), None]),
        ("timestamp_ntz", [datetime(1960, 1, 1), datetime(2020, 1, 1)]), ("decimal(10,2)", [None]), ("double", [1.5, float("nan"), None]),
    ],
)
def test_kinds_nulls_and_repeats(spark, tmp_path, kind, values):
    rows = spark.createDataFrame([(v, i) for i, v in enumerate(values * 3)], f"v {kind}, _n int")
    uri = str(tmp_path / "t")
    assert append_clustered(rows, uri, ["v", "_n"], ["_n"]) == len(values) * 3
    assert spark.read.parquet(uri).count() == len(values) * 3
    ordered = [r.p for r in rows.orderBy(F.col("v").asc_nulls_first(), "_n").select(place_of(rows, ["v"]).alias("p")).collect()]
    assert ordered == sorted(ordered)


def test_an_empty_table(spark, tmp_path):
    empty = spark.createDataFrame([], "a int, b string")
    assert append_clustered(empty, str(tmp_path / "t"), ["a", "b"]) == 0
    assert spark.read.parquet(str(tmp_path / "t")).columns == ["a", "b"]
