"""Profiling queries."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.common import Entries, table
from tidemark.operators import (
    append, column_info, describe, head, head_in_file_order, null_counts, top_values, value_counts, value_counts_multi,
)
from tidemark.plans.summaries import describe_merged
from tidemark.sources import read_csv
from tidemark.workspace import fresh_dir


def _gappy_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The events with some values missing; the given tables hold no nulls."""
    return table(spark, sf_dir, "events").withColumns(
        {
            "value": F.when(F.col("event_type") != "error", F.col("value")),
            "props": F.when(F.col("event_type").isin("view", "click"), F.col("props")),
        }
    )


def profile_head(spark: SparkSession, sf_dir: str) -> DataFrame:
    return head(table(spark, sf_dir, "orders"), ["o_orderkey"], 5)


def profile_head_file_order(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The first lines of CSV files that hold the orders from the last to the first."""
    orders, path = table(spark, sf_dir, "orders"), fresh_dir(spark, "orders_csv")
    backwards = F.desc("o_orderkey")
    orders.repartitionByRange(3, backwards).sortWithinPartitions(backwards).write.csv(path, header=True)
    return head_in_file_order(read_csv(spark, path, orders.schema), 7)


def profile_top_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The products with most lines, and the users with most events, without counting every one."""
    lines = top_values(table(spark, sf_dir, "lineitem"), "l_partkey", 20)
    events = top_values(table(spark, sf_dir, "events"), "user_id", 10)
    return lines.select(F.lit("l_partkey").alias("column"), F.col("l_partkey").alias("value"), "count").unionByName(
        events.select(F.lit("user_id").alias("column"), F.col("user_id").alias("value"), "count")
    )


def profile_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_info(_gappy_events(spark, sf_dir))


def profile_describe(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(describe(table(spark, sf_dir, "orders"), ["o_totalprice"]))


def profile_describe_all(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _rounded(describe(table(spark, sf_dir, "lineitem")))


def profile_describe_merged(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``profile_describe_all``, from summaries of a stored table's directories; the last year arrives later."""
    every, uri, sums = table(spark, sf_dir, "lineitem"), fresh_dir(spark, "lineitem"), fresh_dir(spark, "summaries")
    every = every.withColumn("year", F.year("l_shipdate"))
    schema = every.schema
    for part in (F.col("year") < 1998, F.col("year") >= 1998):
        append(every.where(part), uri, ["year"], ["l_orderkey", "l_linenumber"])
        found = describe_merged(spark, spark.read.schema(schema).parquet(uri), sums, ["year"], pool_rows=1_000)
    return _rounded(found)


def profile_describe_bracketed(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``profile_describe_all`` with so small a pool that the quartiles are bracketed first."""
    return _rounded(describe(table(spark, sf_dir, "lineitem"), pool_rows=1_000))


def _rounded(stats: DataFrame) -> DataFrame:
    return stats.select("column", "count", *(F.round(c, 4).alias(c) for c in stats.columns[2:]))


def profile_null_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return null_counts(_gappy_events(spark, sf_dir))


def profile_value_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_counts(table(spark, sf_dir, "lineitem"), "l_returnflag")


def profile_value_counts_multi(spark: SparkSession, sf_dir: str) -> DataFrame:
    return value_counts_multi(table(spark, sf_dir, "orders"), ["o_orderstatus", "o_orderpriority"])


def _stats_sql(rows: str, column: str) -> str:
    value = f"{column}::DOUBLE"
    return f"""
        SELECT '{column}' AS "column", count({value}) AS count, round(avg({value}), 4) AS mean,
               round(stddev_samp({value}), 4) AS std, round(min({value}), 4) AS min,
               round(quantile_cont({value}, 0.25), 4) AS q25, round(quantile_cont({value}, 0.5), 4) AS q50,
               round(quantile_cont({value}, 0.75), 4) AS q75, round(max({value}), 4) AS max
        FROM {rows}
    """


_LINE_NUMBERS = (
    "l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity", "l_extendedprice", "l_discount", "l_tax",
)
_EVENT_COLUMNS = {
    "event_id": ("bigint", "TRUE"),
    "ts": ("timestamp_ntz", "TRUE"),
    "user_id": ("bigint", "TRUE"),
    "event_type": ("string", "TRUE"),
    "value": ("double", "event_type <> 'error'"),
    "props": ("string", "event_type IN ('view', 'click')"),
}

ENTRIES: Entries = {
    "profile_head_file_order": (
        profile_head_file_order,
        """
        SELECT row_number() OVER (ORDER BY o_orderkey DESC) - 1 AS position, *
        FROM orders ORDER BY o_orderkey DESC LIMIT 7
        """,
    ),
    "profile_top_values": (
        profile_top_values,
        """
        (SELECT 'l_partkey' AS "column", l_partkey AS value, count(*) AS count FROM lineitem
         GROUP BY l_partkey ORDER BY count DESC, value LIMIT 20)
        UNION ALL
        (SELECT 'user_id', user_id, count(*) AS n FROM events GROUP BY user_id ORDER BY n DESC, user_id LIMIT 10)
        """,
    ),
    "profile_head": (profile_head, "SELECT * FROM orders ORDER BY o_orderkey LIMIT 5"),
    "profile_info": (
        profile_info,
        " UNION ALL ".join(
            f"""SELECT {i}::INT AS pos, '{c}' AS "column", '{t}' AS dtype,
                       count({c}) FILTER (WHERE {there}) AS non_null FROM events"""
            for i, (c, (t, there)) in enumerate(_EVENT_COLUMNS.items())
        ),
    ),
    "profile_describe": (profile_describe, _stats_sql("orders", "o_totalprice")),
    "profile_describe_all": (
        profile_describe_all,
        " UNION ALL ".join(_stats_sql("lineitem", c) for c in _LINE_NUMBERS),
    ),
    "profile_describe_bracketed": (
        profile_describe_bracketed,
        " UNION ALL ".join(_stats_sql("lineitem", c) for c in _LINE_NUMBERS),
    ),
    "profile_describe_merged": (
        profile_describe_merged,
        " UNION ALL ".join(_stats_sql("lineitem", c) for c in _LINE_NUMBERS),
    ),
    "profile_null_counts": (
        profile_null_counts,
        " UNION ALL ".join(
            f"""SELECT '{c}' AS "column", count(*) FILTER (WHERE NOT ({there}) OR {c} IS NULL) AS nulls FROM events"""
            for c, (_, there) in _EVENT_COLUMNS.items()
        ),
    ),
    "profile_value_counts": (
        profile_value_counts,
        "SELECT l_returnflag, count(*) AS count FROM lineitem WHERE l_returnflag IS NOT NULL GROUP BY l_returnflag",
    ),
    "profile_value_counts_multi": (
        profile_value_counts_multi,
        """
        SELECT 'o_orderstatus' AS "column", o_orderstatus AS value, count(*) AS count FROM orders GROUP BY 2
        UNION ALL SELECT 'o_orderpriority', o_orderpriority, count(*) FROM orders GROUP BY 2
        """,
    ),
}
