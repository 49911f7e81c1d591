"""What the plans must look like to hold at a thousand times the data."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import dedupe, profile_keys, unstored_rows
from tidemark.plans import ingest
from tidemark.sources import read_history
from tidemark.tables import TableSpec

SPEC = TableSpec("t", ("k",), ("p",), ("v",), schema="k bigint, v bigint, s string, p string")


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


@pytest.fixture
def no_auto_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


@pytest.fixture
def stored(spark, target):
    rows = spark.range(1000).selectExpr("id AS k", "id AS v", "'x' AS s", "cast(id % 3 AS string) AS p")
    ingest(spark, rows, SPEC, target)
    return rows, read_history(spark, target, SPEC.schema)


def test_duplicates_shrink_before_the_shuffle(spark):
    lines = plan_of(dedupe(spark.range(10).selectExpr("id % 2 AS k", "id AS v"), ["k"], [F.desc("v")])).splitlines()
    shuffle = next(i for i, line in enumerate(lines) if "Exchange hashpartitioning" in line)
    partial = next(i for i, line in enumerate(lines) if "WindowGroupLimit" in line and "Partial" in line)
    assert partial > shuffle


def test_large_batch_is_shuffled_once(spark, stored, no_auto_broadcast):
    batch, history = stored
    plan = plan_of(unstored_rows(batch, history, ["k"], [], profile_keys(batch, ["k"]), broadcast_key_bytes=0))
    assert plan.count("Exchange hashpartitioning(k") == 2
    assert "SortMergeJoin" in plan and "LeftAnti" in plan
    assert "ReadSchema: struct<k:bigint>" in plan
    assert "GreaterThanOrEqual(k,0), LessThanOrEqual(k,999)" in plan


def test_small_batch_leaves_the_history_where_it_is(spark, stored, no_auto_broadcast):
    batch, history = stored
    plan = plan_of(unstored_rows(batch, history, ["k"], [], profile_keys(batch, ["k"])))
    assert "SortMergeJoin" not in plan
    assert plan.count("BroadcastHashJoin") == 2
    assert "ReadSchema: struct<k:bigint>" in plan


def test_stable_partition_columns_prune_directories(spark, stored):
    batch, history = stored
    late = batch.where("p = '2'")
    profile = profile_keys(late, ["k"], ["p"])
    assert profile.ranges["p"] == ("2", "2", False)
    plan = plan_of(unstored_rows(late, history, ["k"], [], profile))
    assert "PartitionFilters: [isnotnull(p" in plan


def test_hot_key_sends_one_row_per_task(spark):
    """A third of all rows under one key: the shuffle carries a row per task for it."""
    rows = spark.range(0, 60_000, 1, 6).selectExpr("if(id % 3 = 0, -1, id) AS k", "id AS v")
    survivors = dedupe(rows, ["k"], [F.desc("v")])
    assert survivors.count() == 40_001
    assert survivors.where("k = -1").first().v == 59_997
