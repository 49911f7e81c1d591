"""The bitmap that thins out the history: never a stored key lost, and little else let through."""

from datetime import date, datetime
from decimal import Decimal

import pytest
from pyspark.sql import functions as F
from pyspark.sql.types import DoubleType, LongType, StringType, StructField, StructType

from tidemark.operators import profile_keys, unstored_rows
from tidemark.operators.keybitmap import BLOCK_BITS, PROBES, KeyBitmap, bitmap_for


@pytest.mark.parametrize(
    "kind, values",
    [
        ("bigint", [-(1 << 63), -1, 0, 1, (1 << 63) - 1]), ("int", [-5, 0, 7]), ("string", ["", "a", "é", "x" * 5000]),
        ("date", [date(1970, 1, 1), date(2025, 2, 3)]), ("timestamp_ntz", [datetime(2025, 1, 1, 2, 3)]),
        ("decimal(20,4)", [Decimal("-1.5"), Decimal("0")]), ("boolean", [True]),
    ],
)
def test_wanted_keys_always_pass(spark, kind, values):
    rows = spark.createDataFrame([(v, i) for i, v in enumerate(values)], f"k {kind}, i int")
    for blocks in (1, 3):
        passed = KeyBitmap(blocks).thin_out(rows, rows.select("k"), ["k"])
        assert passed.columns == ["k", "i"] and passed.count() == len(values)


def test_bits_are_those_that_were_set(spark):
    """Each of a block's bits, set alone, lets through the rows that test it and no others."""
    bitmap = KeyBitmap(1)
    keys = spark.range(300).withColumnRenamed("id", "k")
    _, bits = bitmap._places(["k"], keys.schema)
    places = {r.k: set(r[1:]) for r in keys.select("k", *bits).collect()}
    wanted = set().union(*(places[k] for k in range(40)))
    passed = {r.k for r in bitmap.thin_out(keys, keys.where("k < 40"), ["k"]).collect()}
    assert passed == {k for k, own in places.items() if own <= wanted}
    assert passed >= set(range(40)) and all(0 <= b < BLOCK_BITS for own in places.values() for b in own)
    assert len(set().union(*places.values())) > 300 * PROBES * 0.9


def test_other_keys_rarely_pass(spark):
    n = 20_000
    bitmap = bitmap_for(n, [LongType()])
    stored = spark.range(50 * n).withColumnRenamed("id", "k")
    passed = bitmap.thin_out(stored, stored.where(f"k % 50 = 0"), ["k"]).where("k % 50 <> 0").count()
    assert passed / (49 * n) < 2 * bitmap.false_share(n) < 0.01


def test_sizes():
    assert bitmap_for(0, [LongType()]).blocks == 1
    assert bitmap_for(10**6, [LongType(), StringType()]).blocks == -(-16 * 10**6 // BLOCK_BITS)
    assert bitmap_for(10**7, [LongType()], 1 << 26).bits == 1 << 26
    assert bitmap_for(10**12, [LongType()]) is None
    assert bitmap_for(10, [DoubleType()]) is None
    assert bitmap_for(10, [StructType([StructField("a", LongType())])]) is None


@pytest.fixture
def no_auto_broadcast(spark):
    before = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", before)


def _shuffled_rows(plan, column):
    """Rows written by each shuffle on ``column`` of an executed plan."""
    found, waiting = [], [plan]
    while waiting:
        node = waiting.pop()
        name = node.getClass().getSimpleName()
        if name == "AdaptiveSparkPlanExec":
            waiting.append(node.executedPlan())
            continue
        if name.endswith("QueryStageExec"):
            waiting.append(node.plan())
            continue
        if name == "ShuffleExchangeExec" and column in node.outputPartitioning().toString():
            found.append(node.metrics().get("shuffleRecordsWritten").get().value())
        children = node.children()
        waiting += [children.apply(i) for i in range(children.size())]
    return found


def test_history_is_thinned_out_before_its_shuffle(spark, tmp_path, no_auto_broadcast):
    """One row in a hundred of the history matches: less than twice the matches are shuffled."""
    spark.range(200_000).select(F.sha2(F.col("id").cast("string"), 256).alias("k"), "id").write.parquet(f"{tmp_path}/h")
    history = spark.read.parquet(f"{tmp_path}/h")
    batch = history.where("id % 100 = 0").unionByName(
        spark.range(2000).select(F.sha2(F.concat(F.lit("n"), F.col("id").cast("string")), 256).alias("k"), "id")
    )
    batch.write.parquet(f"{tmp_path}/b")
    batch = spark.read.parquet(f"{tmp_path}/b")
    fresh = unstored_rows(batch, history, ["k"], [], profile_keys(batch, ["k"]), broadcast_key_bytes=0)
    assert len(fresh.collect()) == 2000
    plan = fresh._jdf.queryExecution().executedPlan()
    lines = plan.toString().splitlines()
    scan = next(i for i, line in enumerate(lines) if "SortMergeJoin" in line and "LeftAnti" in line)
    history_side = [line for line in lines[scan:] if "BroadcastHashJoin" in line or "Exchange hashpartitioning(k" in line]
    assert "Exchange" in history_side[-2] and "BroadcastHashJoin" in history_side[-1]
    shuffled = sorted(_shuffled_rows(plan, "hashpartitioning(k"))
    assert 2000 <= shuffled[0] < 4000 and shuffled[1] == 4000


def test_nulls_ties_and_empty_tables(spark):
    rows = spark.createDataFrame([("a", 1), ("a", 1), ("b", 2), (None, 3)], "k string, _block int")
    empty = rows.limit(0)
    keyed = rows.where("k IS NOT NULL")
    for batch, history, expected in (
        (keyed, empty, {"a", "b"}), (empty, rows, set()), (keyed, rows.where("k = 'a'"), {"b"}), (keyed, rows, set()),
    ):
        got = unstored_rows(batch, history, ["k"], [], profile_keys(batch, ["k"]), broadcast_key_bytes=0)
        assert {r.k for r in got.collect()} == expected and got.columns == ["k", "_block"]


def test_without_bitmap_the_result_is_the_same(spark, no_auto_broadcast):
    history = spark.range(0, 1000, 3).withColumnRenamed("id", "k")
    batch = spark.range(1000).withColumnRenamed("id", "k")
    profile = profile_keys(batch, ["k"])
    ways = [
        unstored_rows(batch, history, ["k"], [], profile, broadcast_key_bytes=0, bitmap_bits=bits) for bits in (0, 1 << 29)
    ]
    assert "_words" not in ways[0]._jdf.queryExecution().toString()
    assert sorted(r.k for r in ways[0].collect()) == sorted(r.k for r in ways[1].collect()) == [k for k in range(1000) if k % 3]
