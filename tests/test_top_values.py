"""The most frequent values without counting all of them."""

import random
from collections import Counter

import pytest
from pyspark.sql import functions as F

from tidemark.operators import profile, top_values


def by_hand(values, k):
    counts = Counter(v for v in values if v is not None)
    return sorted(counts.items(), key=lambda x: (-x[1], x[0]))[:k]


def found(spark, values, k, kind="string", **options):
    df = spark.createDataFrame([(v, 1) for v in values], f"v {kind}, count int").repartition(3)
    return [tuple(r) for r in top_values(df, "v", k, **options).collect()]


def skewed(seed, n, different):
    draw = random.Random(seed)
    return [draw.choice(["hot", "warm", None] + [f"v{int(draw.paretovariate(0.7)) % different}"] * 4) for _ in range(n)]


@pytest.mark.parametrize("groups,first", [(8192, 64), (64, 1), (7, 1), (1, 1)])
def test_equals_counting_all(spark, groups, first):
    values = skewed(1, 4000, 900)
    for k in (1, 5, 40):
        assert found(spark, values, k, groups=groups, first=first) == by_hand(values, k)


def test_all_alike_falls_back_to_counting_all(spark):
    values = [f"v{i % 300:03d}" for i in range(900)]
    assert found(spark, values, 10, groups=16, first=1) == by_hand(values, 10)


def test_the_bound_decides(spark, monkeypatch):
    """Taking the largest groups only is right because the next group as a whole has fewer rows than the last value found."""
    values = ["a"] * 500 + ["b"] * 400 + [f"v{i}" for i in range(2000)]
    df = spark.createDataFrame([(v,) for v in values], "v string")
    top = top_values(df, "v", 2, groups=256, first=2)
    assert [tuple(r) for r in top.collect()] == [("a", 500), ("b", 400)]
    plan = top._jdf.queryExecution().optimizedPlan().toString()
    assert "substring" in plan  # most groups were never counted value by value
    sizes = df.groupBy(F.pmod(F.xxhash64("v"), F.lit(256)).alias("g")).count().orderBy(F.desc("count")).collect()
    assert sizes[2]["count"] < 400


def test_a_hot_value_is_summed_in_each_task(spark):
    rows = spark.range(0, 30_000, 1, 6).select(F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("v"))
    top = top_values(rows, "v", 1)
    assert [tuple(r) for r in top.collect()] == [(-1, 10_000)]
    plan = top._jdf.queryExecution().executedPlan().toString()
    assert plan.count("partial_count") >= 1


def test_kinds_ties_nulls_and_empty_tables(spark):
    assert found(spark, [], 3) == [] == found(spark, [None, None], 3)
    assert found(spark, ["b", "a", "c", "a", "b"], 2) == [("a", 2), ("b", 2)]
    doubles = [0.0, -0.0, 1.5, float("nan"), None, 1.5, 0.0]
    assert found(spark, doubles, 5, "double") == [(0.0, 3), (1.5, 2)]
    assert profile.VALUE_GROUPS == 8192
