"""Dimension history and as-of joins against plain loops."""

import random
from datetime import date, datetime, timedelta

import pytest
from pyspark.sql import functions as F

from tidemark.plans.versions import as_of, dimension_history

OBSERVED = "k int, day date, a string, b int, n int"
START = date(2024, 1, 1)


def versions_by_hand(rows):
    out = []
    for key in {r[0] for r in rows} - {None}:
        days = {}
        for _, day, a, b, n in sorted((r for r in rows if r[0] == key and r[1]), key=lambda r: r[4]):
            days[day] = (a, b)  # the greatest n of a day stays
        found = []
        for day in sorted(days):
            if not found or found[-1][1] != days[day]:
                found.append((day, days[day]))
        for i, (day, state) in enumerate(found):
            until = found[i + 1][0] if i + 1 < len(found) else None
            out.append((key, *state, day, until, i + 1, until is None))
    return sorted(out, key=str)


def history(spark, rows, **options):
    df = spark.createDataFrame(rows, OBSERVED).repartition(3)
    return dimension_history(df, ["k"], ["a", "b"], "day", [F.desc("n")], **options)


def observations(seed, n, keys=6):
    draw = random.Random(seed)
    return [
        (draw.choice([*range(keys), None]), draw.choice([START + timedelta(draw.randrange(60)), None] if draw.random() < 0.05 else [START + timedelta(draw.randrange(60))]),
         draw.choice(["x", "y", None]), draw.choice([1, None]), i)
        for i in range(n)
    ]


@pytest.mark.parametrize("span", [86_400, 7 * 86_400, 10**9])
def test_versions_equal_a_plain_loop(spark, span):
    rows = observations(1, 500)
    assert sorted(map(tuple, history(spark, rows, span=span).collect()), key=str) == versions_by_hand(rows)


def test_a_hot_key_is_compared_in_spans(spark):
    """A third of all observations under one key: what meets along the key are the firsts of spans and changes."""
    rows = [(0, START + timedelta(i // 10), "x" if i < 1500 else "y", 1, i) for i in range(3000)]
    rows += [(1 + i % 50, START + timedelta(i % 40), "z", i % 2, i) for i in range(6000)]
    found = history(spark, rows, span=20 * 86_400)
    assert sorted(map(tuple, found.collect()), key=str) == versions_by_hand(rows)
    lines = found._jdf.queryExecution().executedPlan().toString().splitlines()
    by_span = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(k" in line and "_span" in line]
    by_key = [i for i, line in enumerate(lines) if "Exchange hashpartitioning(k" in line and "_span" not in line and "day" not in line]
    assert by_span and by_key and by_key[0] < by_span[0]


def test_repeats_and_an_empty_table(spark):
    rows = [(1, START, "x", 1, 1)] * 3
    assert [tuple(r) for r in history(spark, rows).collect()] == [(1, "x", 1, START, None, 1, True)]
    assert history(spark, []).collect() == []


FACTS = "id int, k int, day date, a_note string, _at int"
VERSIONS = "k int, valid_from date, price int"


def as_of_by_hand(facts, versions):
    out = []
    for f in facts:
        own = [v for v in versions if f[1] is not None and f[2] is not None and v[0] == f[1] and v[1] and v[1] <= f[2]]
        best = max(own, key=lambda v: (v[1], v[2] is not None, v[2] or 0), default=(None, None, None))
        out.append((*f, best[2]))
    return sorted(out, key=str)


def joined(spark, facts, versions, **options):
    left = spark.createDataFrame(facts, FACTS).repartition(3)
    found = as_of(left, spark.createDataFrame(versions, VERSIONS), ["k"], "day", ["price"], **options)
    assert found.columns == [*left.columns, "price"]
    return found


def some(seed, n_facts, n_versions):
    draw = random.Random(seed)

    def day():
        return draw.choice([START + timedelta(draw.randrange(50))] * 20 + [None])

    facts = [(i, draw.choice([0, 0, 0, 1, 2, 3, 9, None]), day(), "x", 1) for i in range(n_facts)]
    versions = [(draw.choice([0, 1, 2, 3, None]), day(), draw.choice([None, i])) for i in range(n_versions)]
    return facts, versions


@pytest.mark.parametrize("split", [1_000_000, 50, 1])
def test_as_of_equals_a_plain_loop(spark, split):
    facts, versions = some(2, 600, 80)
    assert sorted(map(tuple, joined(spark, facts, versions, split=split).collect()), key=str) == as_of_by_hand(facts, versions)


def test_a_hot_product_is_dealt_out(spark):
    facts = [(i, 0 if i % 3 else 1 + i % 7, START + timedelta(i % 30), None, i) for i in range(3000)]
    versions = [(k, START + timedelta(3 * d), 10 * k + d) for k in range(8) for d in range(5)]
    found = joined(spark, facts, versions, split=100)
    assert sorted(map(tuple, found.collect()), key=str) == as_of_by_hand(facts, versions)
    plan = found._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastNestedLoopJoin" not in plan and "CartesianProduct" not in plan
    assert "Exchange hashpartitioning(_key_0" in plan and "_slot" in plan


def test_empty_sides_and_clashing_columns(spark):
    facts, versions = some(3, 20, 20)
    assert joined(spark, [], versions).collect() == []
    assert {r.price for r in joined(spark, facts, []).collect()} == {None}
    with pytest.raises(ValueError):
        as_of(spark.createDataFrame(facts, FACTS), spark.createDataFrame(versions, VERSIONS), ["k"], "day", ["k"])


def test_times_within_a_day(spark):
    rows = [(1, datetime(2024, 1, 1, h), v) for h, v in ((0, "a"), (5, "a"), (6, "b"), (23, "a"))]
    observed = spark.createDataFrame(rows, "k int, t timestamp_ntz, v string")
    found = dimension_history(observed, ["k"], ["v"], "t").orderBy("version").collect()
    assert [(r.v, r.valid_from.hour) for r in found] == [("a", 0), ("b", 6), ("a", 23)]
