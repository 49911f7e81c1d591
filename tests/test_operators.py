"""Sources, duplicate removal, sinks."""

import os

import pytest
from pyspark.sql import functions as F

from tidemark.operators import append, dedupe, new_rows, overwrite, profile_keys
from tidemark.sources import read_csv, read_csv_loose
from tidemark.workspace import fresh_dir


def test_dedupe_takes_any_order_and_column_type(spark):
    df = spark.sql(
        "SELECT * FROM VALUES (1, 5, map('a', 1), array(1)), (1, 3, map('b', 1), array(2)), (null, 1, null, null),"
        " (null, 2, null, null) AS t(k, v, m, a)"
    )
    assert {(r.k, r.v) for r in dedupe(df, ["k"], [F.desc("v")]).collect()} == {(1, 5), (None, 2)}
    assert {(r.k, r.v) for r in dedupe(df, ["k"], [F.asc("v")]).collect()} == {(1, 3), (None, 1)}
    assert dedupe(df.select("k"), ["k"]).count() == 2


def test_dedupe_quotes_names(spark):
    df = spark.createDataFrame([(1, 2), (1, 3)], "`a.b` int, `c d` int")
    assert [tuple(r) for r in dedupe(df, ["a.b"], [F.desc("c d")]).collect()] == [(1, 3)]


def test_new_rows_keeps_null_keys_and_columns_of_the_batch(spark):
    batch = spark.createDataFrame([("x", 1), ("y", 2), ("z", None)], "v string, k int")
    history = spark.createDataFrame([(1, "other")], "k int, w string")
    found = new_rows(batch, history, ["k"])
    assert found.columns == ["v", "k"]
    assert {r.v for r in found.collect()} == {"y", "z"}


def test_key_profile(spark):
    rows = [(5, "bb", 1.5), (2, "a", None), (None, "c", 1.0), (9, None, 1.0)]
    batch = spark.createDataFrame(rows, "k int, s string, d double")
    found = profile_keys(batch, ["k", "s"], ["d"])
    assert (found.rows, found.rows_without_key) == (4, 2)
    assert found.ranges == {"k": (2, 5, False), "s": ("a", "bb", False)}
    assert found.key_bytes >= 2 * 2 * 8 + 3


def test_csv_header_is_checked_against_the_schema(spark, tmp_path):
    path = tmp_path / "moved.csv"
    path.write_text("b,a\n1,2\n")
    assert read_csv(spark, str(path), "b int, a int").first() == (1, 2)
    with pytest.raises(Exception, match="(?i)header"):
        read_csv(spark, str(path), "a int, b int").collect()


def test_loose_csv(spark, tmp_path):
    path = tmp_path / "loose.csv"
    path.write_text("a,b,n,f,day,none\n1,NA,7,True,2025-01-02,\n2,null,N/A,False,2025-01-03,NA\n3,,8.5,,x,\n4,x,1e3,NaN,,\n5,N/A,,True,,\n")
    found = read_csv_loose(spark, str(path))
    assert found.dtypes == [
        ("a", "bigint"), ("b", "string"), ("n", "double"), ("f", "boolean"), ("day", "string"), ("none", "double"),
    ]
    rows = found.orderBy("a").collect()
    assert [r.b for r in rows] == [None, None, None, "x", None]
    assert [r.n for r in rows] == [7.0, None, 8.5, 1000.0, None]
    assert read_csv(spark, str(path)).where("b IS NULL").count() == 1


def test_numbers_with_suffixes_stay_text(spark, tmp_path):
    path = tmp_path / "codes.csv"
    path.write_text("code\n1d\n2f\n")
    assert read_csv_loose(spark, str(path)).dtypes == [("code", "string")]


def files_in(path):
    return [f for f in os.listdir(path) if f.endswith(".parquet")]


def test_append_and_overwrite(spark, target):
    rows = spark.range(100).selectExpr("id", "id % 4 AS p", "id % 2 AS q")
    assert append(rows, target, ["p", "q"], ["id"]) == 100
    assert append(rows.where("p = 1"), target, ["p", "q"]) == 25
    assert spark.read.parquet(target).count() == 125
    assert overwrite(rows.where("p = 3"), target, ["p", "q"], only_written_partitions=True) == 25
    assert spark.read.parquet(target).count() == 125
    assert overwrite(rows.where("p = 3"), target, ["p", "q"]) == 25
    assert spark.read.parquet(target).count() == 25


def test_append_without_partitions(spark, target):
    assert append(spark.range(10), target) == 10
    assert spark.read.parquet(target).count() == 10


def test_a_directory_gets_few_files_and_a_hot_one_is_split(spark, target):
    rows = spark.range(0, 200_000, 1, 16).selectExpr(
        "id", "md5(cast(id AS string)) AS v", "if(id % 3 = 0, id % 30, -1) AS p"
    )
    before = spark.conf.get("spark.sql.adaptive.advisoryPartitionSizeInBytes")
    spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", "1m")
    try:
        append(rows, target, ["p"], ["id"])
        append(rows, target + "_no_key", ["p"])
    finally:
        spark.conf.set("spark.sql.adaptive.advisoryPartitionSizeInBytes", before)
    assert len(files_in(f"{target}/p=-1")) > 2
    assert max(len(files_in(f"{target}/p={p}")) for p in range(0, 30, 3)) <= 2
    assert len(files_in(f"{target}_no_key/p=-1")) > 2
    for uri in (target, target + "_no_key"):
        assert spark.read.parquet(uri).count() == 200_000


class Session:
    """Stands in for a session: its settings cannot be changed once it runs."""

    def __init__(self, **settings):
        self.conf = {name.replace("_", "."): value for name, value in settings.items()}


def test_work_folder_follows_the_session(tmp_path):
    cluster = Session(spark_master="yarn", spark_checkpoint_dir=f"{tmp_path}/")
    one, two = fresh_dir(cluster, "x"), fresh_dir(cluster, "x")
    assert one != two and one.startswith(f"{tmp_path}/x-")


def test_no_machine_local_work_folder_on_a_cluster():
    with pytest.raises(RuntimeError, match="spark.checkpoint.dir"):
        fresh_dir(Session(spark_master="yarn"), "x")
    assert os.path.isdir(os.path.dirname(fresh_dir(Session(spark_master="local[2]"), "x")))
