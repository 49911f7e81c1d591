from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from tidemark.plans.gold import month_of
from tidemark.tables import TableSpec

Query = Callable[[SparkSession, str], DataFrame]
Entries = dict[str, tuple[Query, str]]

ORDERS = TableSpec(
    name="orders",
    key=("o_orderkey",),
    partition_by=("month",),
    latest_by=("o_orderdate",),
    schema=(
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string, month string"
    ),
)
LINES = TableSpec(
    name="lineitem",
    key=("l_orderkey", "l_linenumber"),
    partition_by=("month",),
    latest_by=("l_shipdate",),
    schema=(
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, l_quantity double, "
        "l_extendedprice double, l_discount double, l_tax double, l_returnflag string, l_linestatus string, "
        "l_shipdate timestamp_ntz, month string"
    ),
)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").withColumn("month", month_of("o_orderdate"))


def lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "lineitem").withColumn("month", month_of("l_shipdate"))


# Orders stored before the batch arrives.
EARLIER = "o_orderdate < timestamp_ntz '1998-01-01 00:00:00'"
ORDERS_SQL = "SELECT *, strftime(o_orderdate, '%Y-%m') AS month FROM orders"
