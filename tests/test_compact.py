"""Compaction: the same rows in fewer files, whatever happens on the way."""

import glob

import pytest
from pyspark.sql import functions as F

from tidemark.operators import append
from tidemark.plans import compact as compaction
from tidemark.plans import ingest
from tidemark.plans.compact import Compaction, compact, directory_files, fragmented
from tidemark.plans.marks import read_mark
from tidemark.sources import read_history
from tidemark.tables import TableSpec

SPEC = TableSpec("t", ("k",), ("a", "b"), schema="k bigint, v string, a string, b int")


def loads(spark, target, n=6, wide=1):
    """Many small files in a=x and in the null directory, one each in the others."""
    rows = spark.range(600).select(
        F.col("id").alias("k"), F.concat(*(F.sha2(F.concat("id", F.lit(f"/{i}")), 256) for i in range(wide))).alias("v"),
        F.when(F.col("id") % 3 == 0, "x").when(F.col("id") % 3 == 1, F.lit(None)).otherwise("y").alias("a"),
        (F.col("id") % 2).cast("int").alias("b"),
    )
    for part in range(n):
        append(rows.where(f"(k div 7) % {n} = {part} AND (a IS NULL OR a = 'x')"), target, SPEC.partition_by, SPEC.key)
    append(rows.where("a = 'y'"), target, SPEC.partition_by, SPEC.key)
    return rows


def files(target):
    return {p for p in glob.glob(f"{target}/a=*/b=*/*.parquet")}


def rows_of(spark, target):
    return sorted(map(str, read_history(spark, target, SPEC.schema).select("k", "v", "a", "b").collect()))


def test_only_fragmented_directories_are_rewritten(spark, target):
    rows = sorted(map(str, loads(spark, target).collect()))
    before = files(target)
    table = read_history(spark, target, SPEC.schema)
    sizes = {(r.a, r.b): r.files for r in directory_files(table, SPEC.partition_by).collect()}
    assert sum(sizes.values()) == len(before) and sizes["x", 0] >= 3
    wanted = {(r.a, r.b) for r in fragmented(directory_files(table, SPEC.partition_by), 1 << 20).collect()}
    assert {a for a, _ in wanted} == {"x", None}
    result = compact(spark, target, SPEC, file_bytes=1 << 20)
    assert result.directories == len(wanted) and result.files_before == sum(sizes[d] for d in wanted)
    assert result.files_after <= 2 * len(wanted)
    assert rows_of(spark, target) == rows
    after = files(target)
    assert {p for p in before if "a=y" in p} == {p for p in after if "a=y" in p}
    assert compact(spark, target, SPEC, file_bytes=1 << 20) == Compaction(0, 0, 0)
    assert files(target) == after


def test_large_directories_keep_files_of_the_size_wanted(spark, target):
    rows = loads(spark, target)
    size = directory_files(read_history(spark, target, SPEC.schema), SPEC.partition_by).agg(F.max("bytes")).first()[0]
    compact(spark, target, SPEC, file_bytes=size)
    left = directory_files(read_history(spark, target, SPEC.schema), SPEC.partition_by)
    assert fragmented(left, size).count() == 0 and left.agg(F.max("files")).first()[0] <= 2
    assert rows_of(spark, target) == sorted(map(str, rows.collect()))


def test_files_hold_separate_key_ranges(spark, target):
    loads(spark, target, 8, wide=40)
    size = directory_files(read_history(spark, target, SPEC.schema), SPEC.partition_by).agg(F.max("bytes")).first()[0]
    assert compact(spark, target, SPEC, file_bytes=size // 3 + 1).directories > 0
    ranges = (
        read_history(spark, target, SPEC.schema).where("a = 'x' AND b = 0")
        .groupBy("_metadata.file_path").agg(F.min("k").alias("low"), F.max("k").alias("high")).orderBy("low").collect()
    )
    assert 1 < len(ranges) <= 6 and all(r.high < s.low for r, s in zip(ranges, ranges[1:]))


@pytest.mark.parametrize("dies_in", ["copy", "swap", "mark"])
def test_a_run_that_died_is_carried_on(spark, target, monkeypatch, dies_in):
    rows = loads(spark, target)

    def lost(*_, **__):
        raise RuntimeError("lost")

    if dies_in == "copy":
        monkeypatch.setattr(compaction, "write_mark", lost)
    elif dies_in == "swap":

        def half(df, uri, by, key, **options):
            """One directory is swapped, another is gone."""
            real(df.where("a = 'x' AND b = 0"), uri, by, key, **options)
            real(df.where("a = 'x' AND b = 1").limit(1), uri, by, key, **options)
            lost()

        real = compaction.overwrite
        monkeypatch.setattr(compaction, "overwrite", half)
    else:
        marks = iter([compaction.write_mark, lost])
        monkeypatch.setattr(compaction, "write_mark", lambda *a: next(marks)(*a))
    with pytest.raises(RuntimeError):
        compact(spark, target, SPEC, file_bytes=1 << 20)
    monkeypatch.undo()
    new = spark.createDataFrame([(10_000, "new", "x", 0), (10_001, "new", None, 1)], SPEC.schema)
    if dies_in != "swap":  # rows of the lost directory must not come back a second time
        assert ingest(spark, new.unionByName(rows), SPEC, target).appended == 2
    else:
        append(new, target, SPEC.partition_by, SPEC.key)
    compact(spark, target, SPEC, file_bytes=1 << 20)
    assert rows_of(spark, target) == sorted(map(str, rows.unionByName(new).collect()))
    assert read_mark(spark, target, "compaction") % 2 == 0
    assert fragmented(directory_files(read_history(spark, target, SPEC.schema), SPEC.partition_by), 1 << 20).count() == 0


def test_many_directories_are_joined(spark, target, monkeypatch):
    monkeypatch.setattr(compaction, "NAMED_DIRECTORIES", 1)
    rows = loads(spark, target)
    assert compact(spark, target, SPEC, file_bytes=1 << 20).directories == 4
    assert rows_of(spark, target) == sorted(map(str, rows.collect()))


def test_looking_for_fragments_reads_no_column(spark, target):
    loads(spark, target, 2)
    plan = directory_files(read_history(spark, target, SPEC.schema), SPEC.partition_by)._jdf.queryExecution().executedPlan()
    assert "ReadSchema: struct<>" in plan.toString()


def test_nothing_stored_and_no_rows(spark, target):
    assert compact(spark, target, SPEC) == Compaction(0, 0, 0)
    append(spark.createDataFrame([], SPEC.schema), target, SPEC.partition_by, SPEC.key)
    assert compact(spark, target, SPEC) == Compaction(0, 0, 0)
    with pytest.raises(ValueError):
        compact(spark, target, TableSpec("t", ("k",), schema="k int"))
