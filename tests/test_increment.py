"""Layers that follow the one before: equal to a full rebuild, repeatable, and no more work than what is new."""

import glob
import os

import pytest
from pyspark.sql import functions as F

from tidemark.plans import Field, ingest, with_load_columns
from tidemark.plans import increment
from tidemark.plans.increment import (
    REFINED, due_keys, new_since, read_bronze, read_silver, rebuild_silver, refresh_fact, refresh_silver,
)
from tidemark.plans.marks import read_mark, write_mark
from tidemark.sources import read_history
from tidemark.tables import TableSpec

SPEC = TableSpec("sales", ("k",), ("d",), schema="k string, v string, other string, d string")
FIELDS = (Field("k", "int", required=True), Field("v", "decimal(8,2)", required=True), Field("other"), Field("d"))
TYPES = "k string, v string, other string, d string"


class Layers:
    def __init__(self, spark, path, loads=True):
        self.spark, self.loads = spark, loads
        self.bronze, self.silver, self.rejects, self.fact = (f"{path}/{n}" for n in ("b", "s", "r", "f"))

    def load(self, rows, name="load"):
        batch, spec = self.spark.createDataFrame(rows, TYPES), SPEC
        if self.loads:
            batch, spec = with_load_columns(batch, name, from_files=False), SPEC.with_load_columns()
        return ingest(self.spark, batch, spec, self.bronze)

    def refresh(self):
        return refresh_silver(self.spark, self.bronze, self.silver, SPEC, FIELDS, rejects_uri=self.rejects)

    def cleaned(self):
        return read_silver(self.spark, self.silver, SPEC, FIELDS)

    def rows(self):
        kept = {tuple(map(str, r)) for r in self.cleaned().select("k", "v", "other", "d").collect()}
        return kept, sorted(r.k for r in self.spark.read.parquet(self.rejects).collect())

    def refresh_fact(self, **options):
        return refresh_fact(self.spark, self.cleaned(), totals, self.fact, {"d": F.col("d")}, **options)

    def totals(self):
        return {(r.d, int(r.n), str(r.total)) for r in self.spark.read.schema("n long, total decimal(18,2), d string").parquet(self.fact).collect()}

    def files(self):
        return {p: os.stat(p).st_mtime_ns for p in glob.glob(f"{self.fact}/d=*/*.parquet")}


def totals(rows):
    return rows.groupBy("d").agg(F.count("*").alias("n"), F.sum("v").cast("decimal(18,2)").alias("total"))


DAYS = (
    [(" 1", "1.50", "a", "x"), ("2", "?", "b", "x"), ("3", "3", None, "y")],
    [(" 1", "9", "changed", "x"), ("4", "4", "n/a", "y"), ("five", "5", "e", "z")],
    [("6", "6.25", "", "w"), ("7", "", "g", None), ("8", "8", "h", None)],
)
KEPT = {("1", "1.50", "a", "x"), ("3", "3.00", "None", "y"), ("4", "4.00", "None", "y"), ("6", "6.25", "None", "w"), ("8", "8.00", "h", "None")}
REJECTED = ["2", "7", "five"]


@pytest.mark.parametrize("loads", [True, False], ids=["load columns", "keys only"])
def test_three_loads_equal_a_rebuild(spark, tmp_path, loads):
    layers = Layers(spark, tmp_path, loads)
    done = []
    for day in DAYS:
        layers.load(day)
        done.append(layers.refresh())
    assert [(r.due, r.appended, r.rejected) for r in done] == [(3, 2, 1), (2, 1, 1), (3, 2, 1)]
    assert layers.rows() == (KEPT, REJECTED)
    assert layers.refresh().due == 0
    rebuilt = Layers(spark, tmp_path / "again", loads)
    rebuilt.bronze = layers.bronze
    result = rebuild_silver(spark, rebuilt.bronze, rebuilt.silver, SPEC, FIELDS, rejects_uri=rebuilt.rejects)
    assert (result.due, result.appended, result.rejected) == (8, 5, 3)
    assert rebuilt.rows() == (KEPT, REJECTED) and rebuilt.refresh().due == 0


def test_a_run_without_news_reads_keys_and_load_times_only(spark, tmp_path, monkeypatch):
    layers = Layers(spark, tmp_path)
    layers.load(DAYS[0])
    layers.refresh()
    silver, rejects = layers.cleaned(), spark.read.parquet(layers.rejects)
    bronze = read_bronze(spark, layers.bronze, SPEC).where(F.col("_ingested_at") >= F.lit("2020-01-01").cast("timestamp"))
    plan = due_keys(bronze, SPEC, FIELDS, silver, rejects)._jdf.queryExecution().executedPlan().toString()
    read = {line.split("ReadSchema: ")[1] for line in plan.splitlines() if "ReadSchema" in line}
    assert read == {"struct<k:string,_ingested_at:timestamp>", "struct<k:int>", "struct<k:string>"}
    assert "GreaterThanOrEqual(_ingested_at" in plan

    def unexpected(*_):
        raise AssertionError("whole rows were read")

    monkeypatch.setattr(increment, "_rows_of", unexpected)
    assert layers.refresh().due == 0


def test_rows_far_before_the_mark_are_not_looked_at(spark, tmp_path):
    layers = Layers(spark, tmp_path)
    layers.load(DAYS[0])
    layers.refresh()
    write_mark(spark, layers.silver, "bronze", read_mark(spark, layers.silver, "bronze") + 2 * 86_400 * 10**6)
    layers.load(DAYS[1])
    assert layers.refresh().due == 0


@pytest.mark.parametrize("dies_in", ["rejects", "table", "mark"])
def test_a_run_that_died_is_repaired_by_the_next(spark, tmp_path, monkeypatch, dies_in):
    layers = Layers(spark, tmp_path)
    layers.load(DAYS[0])
    layers.refresh()
    layers.load(DAYS[1])
    layers.load(DAYS[2])
    real = {"ingest": increment.ingest, "_moved": increment._moved}

    def failing_ingest(spark, batch, spec, uri, **options):
        if uri == {"rejects": layers.rejects, "table": layers.silver}.get(dies_in):
            real["ingest"](spark, batch.limit(1), spec, uri, **options)  # a part of it is stored
            raise RuntimeError("lost")
        return real["ingest"](spark, batch, spec, uri, **options)

    def failing_mark(*_):
        raise RuntimeError("lost")

    monkeypatch.setattr(increment, "ingest", failing_ingest)
    if dies_in == "mark":
        monkeypatch.setattr(increment, "_moved", failing_mark)
    with pytest.raises(RuntimeError):
        layers.refresh()
    monkeypatch.undo()
    layers.refresh()
    assert layers.rows() == (KEPT, REJECTED)


def test_facts_follow(spark, tmp_path):
    layers = Layers(spark, tmp_path)
    layers.load(DAYS[0])
    layers.refresh()
    assert layers.refresh_fact().directories == 2
    before = layers.files()
    layers.load(DAYS[1])
    layers.refresh()
    assert (layers.refresh_fact().directories, layers.refresh_fact().directories) == (1, 0)
    after = layers.files()
    # The directory that nothing has touched still has its very file.
    assert {p for p in before if "d=x" in p} <= set(after) and not {p for p in before if "d=y" in p} & set(after)
    layers.load(DAYS[2])
    layers.refresh()
    assert layers.refresh_fact().directories == 2
    expected = {(r.d, r.n, str(r.total)) for r in totals(layers.cleaned()).collect()}
    assert layers.totals() == expected == {("x", 1, "1.50"), ("y", 2, "7.00"), ("w", 1, "6.25"), (None, 1, "8.00")}


def test_many_directories_are_found_by_a_join(spark, tmp_path):
    layers = Layers(spark, tmp_path)
    for day in DAYS:
        layers.load(day)
        layers.refresh()
        layers.refresh_fact(named_directories=0)
    assert layers.totals() == {("x", 1, "1.50"), ("y", 2, "7.00"), ("w", 1, "6.25"), (None, 1, "8.00")}


def test_only_touched_directories_are_scanned(spark, tmp_path):
    layers = Layers(spark, tmp_path)
    layers.load(DAYS[0])
    layers.refresh()
    places = spark.createDataFrame([("y",), (None,)], "d string")
    rows = increment.touched(layers.cleaned(), {"d": F.col("d")}, places)
    plan = rows._jdf.queryExecution().executedPlan().toString()
    assert "isnull(d" in plan.split("PartitionFilters: ")[1].split("PushedFilters")[0] and [r.k for r in rows.collect()] == [3]


def test_a_hot_directory(spark, tmp_path):
    """A third of all new rows in one directory: summed before they meet."""
    layers = Layers(spark, tmp_path)
    rows = [(str(k), "1", "o", "hot" if k % 3 == 0 else str(k % 50)) for k in range(3000)]
    layers.load(rows)
    layers.refresh()
    layers.refresh_fact()
    assert ("hot", 1000, "1000.00") in layers.totals() and len(layers.totals()) == 51


def test_empty_tables(spark, tmp_path):
    layers = Layers(spark, tmp_path)
    assert layers.refresh() is None
    layers.load([])
    assert layers.refresh().due == 0
    assert layers.refresh_fact().directories == 0 and read_mark(spark, layers.silver, "bronze") is None
    layers.load(DAYS[0])
    assert layers.refresh().appended == 2


def test_marks(spark, tmp_path):
    uri = str(tmp_path / "t")
    spark.range(3).write.parquet(uri)
    assert read_mark(spark, uri, "a") is None
    for value in (5, 5, 9, 7):
        write_mark(spark, uri, "a", value)
        assert read_mark(spark, uri, "a") == value
    assert read_mark(spark, uri, "b") is None and read_history(spark, uri, "id bigint").count() == 3


def test_new_rows_between_marks(spark):
    rows = spark.range(10).select("id", F.timestamp_micros("id").alias(REFINED))
    assert [r.id for r in new_since(rows, 3, 6).collect()] == [4, 5, 6] and new_since(rows, None).count() == 10
