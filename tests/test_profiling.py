"""Profiles against pandas and against Spark's own exact percentile."""

import random

import pandas as pd
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tidemark.operators import column_info, describe, head, null_counts, value_counts, value_counts_multi
from tidemark.operators.describe import _within


ROWS = 8_001


@pytest.fixture(scope="module")
def sample():
    pick = random.Random(3)
    return pd.DataFrame(
        {
            "n": [pick.choice([1, 2, 2, 2, 5, 9]) for _ in range(ROWS)],
            "x": [pick.gauss(0, 1) * 10 ** pick.randint(0, 6) for _ in range(ROWS - 1)] + [float("nan")],
            "c": [pick.choice(["a", "b", "b", None]) for _ in range(ROWS)],
        }
    )


def quartiles(found):
    return [found[f"q{q}"] for q in (25, 50, 75)]


@pytest.mark.parametrize("pool_rows", [1_000_000, 1_000])
def test_describe_equals_pandas(spark, sample, pool_rows):
    ours = {r["column"]: r for r in describe(spark.createDataFrame(sample), pool_rows=pool_rows).collect()}
    assert set(ours) == {"n", "x"}
    for name, theirs in sample.describe().items():
        found = ours[name]
        values = [found[c] for c in ("count", "mean", "std", "min")] + quartiles(found) + [found["max"]]
        assert values == pytest.approx(list(theirs), rel=1e-9)


@settings(max_examples=10, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(
    st.lists(st.one_of(st.sampled_from([0.0, -0.0, 7.0, 1e300]), st.floats(-1e9, 1e9)), min_size=1, max_size=12),
    st.integers(1, 1_500),
    st.sampled_from([0.0, 0.25, 1e-3]),
)
def test_quartiles_of_any_values(spark, values, copies, step):
    """Each value with many neighbours, at distance zero as well, so that bracketing is needed."""
    expected = pd.Series([v + i * step for v in values for i in range(copies)]).quantile([0.25, 0.5, 0.75])
    rows = spark.createDataFrame([(v,) for v in values], "v double").repartition(3)
    spread = rows.select("v", F.explode(F.sequence(F.lit(0), F.lit(copies - 1))).alias("i"))
    df = spread.select((F.col("v") + F.col("i") * step).alias("x"))
    found = quartiles(describe(df, pool_rows=0).first())
    assert found == pytest.approx(list(expected), rel=1e-9, abs=1e-12)


def test_values_outside_the_brackets_generate_no_rows(spark):
    rows = spark.range(1000).selectExpr("double(id) as a", "if(id % 2 = 0, double(id), null) as b")
    found = _within(rows, [("a", 10.0, 19.0), ("b", 0.0, 9.0)])
    assert sorted(map(tuple, found.collect())) == [(0, float(v)) for v in range(10, 20)] + [(1, float(v)) for v in range(0, 10, 2)]
    plan = found._jdf.queryExecution().optimizedPlan().toString()
    # The nulls are taken out of the array, not out of generated rows.
    assert plan.startswith("Generate inline(") and "filter(array(" in plan


def test_describe_with_a_hot_value(spark):
    df = spark.range(0, 300_000, 1, 8).select(
        F.when(F.col("id") % 3 == 0, 1000).otherwise(F.col("id") * 7919 % 300_007).alias("x")
    )
    exact = df.agg(F.percentile("x", [0.25, 0.5, 0.75]).alias("q")).first().q
    assert quartiles(describe(df, pool_rows=1_000).first()) == exact


def test_describe_edge_columns(spark):
    df = spark.sql("SELECT cast(NULL AS int) AS none, 4.5BD AS one, double('infinity') AS inf, 'x' AS text")
    found = {r["column"]: r for r in describe(df).collect()}
    assert set(found) == {"none", "one", "inf"}
    assert (found["none"]["count"], found["none"]["q50"]) == (0, None)
    assert (found["one"]["std"], quartiles(found["one"])) == (None, [4.5] * 3)
    assert found["inf"]["q25"] == float("inf")


def test_describe_of_a_wide_table(spark):
    df = spark.range(9).select(*((F.col("id") + i).alias(f"c{i}") for i in range(35)))
    found = {r["column"]: quartiles(r) for r in describe(df).collect()}
    assert found == {f"c{i}": [2.0 + i, 4.0 + i, 6.0 + i] for i in range(35)}


def test_describe_without_numbers(spark):
    assert describe(spark.sql("SELECT 'x' AS text")).collect() == []
    assert describe(spark.sql("SELECT 1 AS x").where("x > 1")).first()["count"] == 0


def test_counts_equal_pandas(spark, sample):
    df = spark.createDataFrame(sample)
    assert {r["column"]: r.nulls for r in null_counts(df).collect()} == dict(sample.isnull().sum())
    info = column_info(df).orderBy("pos").collect()
    assert [(r.column, r.dtype) for r in info] == df.dtypes
    assert [r.non_null for r in info] == list(sample.notnull().sum())
    theirs = sample["c"].value_counts()
    assert [(r.c, r["count"]) for r in value_counts(df, "c").collect()] == list(theirs.items())
    both = value_counts_multi(df, ["c", "n"]).collect()
    assert {(r["value"], r["count"]) for r in both if r.column == "c"} == set(theirs.items())
    assert sum(r["count"] for r in both if r.column == "n") == ROWS


def test_head(spark):
    assert [r.id for r in head(spark.range(100).repartition(5), ["id"], 3).collect()] == [0, 1, 2]
