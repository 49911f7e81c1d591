"""The first rows as they stand in the files."""

import pytest
from pyspark.sql import functions as F

from tidemark.operators import head_in_file_order, profile


def write(spark, path, kind, files):
    """File number i holds the given numbers, in their order."""
    for i, numbers in enumerate(files):
        rows = spark.createDataFrame([(n, f"row {n} " + "x" * 50) for n in numbers], "n int, s string").coalesce(1)
        rows.write.format(kind).save(f"{path}/part=a {i:03d}")
    reader = spark.read.schema("n int, s string, part string")
    return reader.format(kind).load(str(path))


def numbers(found):
    return [(r.position, r.n) for r in found.collect()]


@pytest.mark.parametrize("kind", ["parquet", "csv"])
def test_three_files(spark, tmp_path, kind):
    files = [[9, 3, 7], [1, 8], [2, 2]]
    df = write(spark, tmp_path / "t x", kind, files)
    flat = [n for f in files for n in f]
    for n in (0, 1, 3, 4, 6, 7, 50):
        assert numbers(head_in_file_order(df, n)) == list(enumerate(flat))[:n]
    assert head_in_file_order(df, 1).columns == ["position", "n", "s", "part"]
    assert head_in_file_order(df, 4).collect()[3].part == "a 001"


@pytest.mark.parametrize("kind", ["parquet", "csv"])
def test_several_splits_and_only_the_first_is_read(spark, tmp_path, kind):
    before = spark.conf.get("spark.sql.files.maxPartitionBytes")
    spark.conf.set("spark.sql.files.maxPartitionBytes", "16k")
    try:
        order = [(i * 7919) % 5000 for i in range(5000)]
        df = write(spark, tmp_path / "t", kind, [order, [1]])
        assert df.rdd.getNumPartitions() > 3
        assert numbers(head_in_file_order(df, 20)) == list(enumerate(order))[:20]
        if kind == "csv":
            assert numbers(head_in_file_order(df, 4000)) == list(enumerate(order))[:4000]
        one = df.where(F.col("_metadata.file_path") == df.select("_metadata.file_path").orderBy("_metadata.file_path").first()[0])
        assert 1 < one.rdd.getNumPartitions() < df.rdd.getNumPartitions()  # other files are not even planned
    finally:
        spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_many_empty_files(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(profile, "TRIED_FILES", 2)
    df = write(spark, tmp_path / "t", "parquet", [[], [5], [], [], [6, 4], [], [1]])
    assert numbers(head_in_file_order(df, 3)) == [(0, 5), (1, 6), (2, 4)]
    assert numbers(head_in_file_order(df, 9)) == [(0, 5), (1, 6), (2, 4), (3, 1)]


def test_no_rows(spark, tmp_path):
    assert numbers(head_in_file_order(write(spark, tmp_path / "t", "parquet", [[], []]), 3)) == []
    rows = spark.createDataFrame([(1, None)], "n int, position string").coalesce(1)
    rows.write.parquet(str(tmp_path / "u"))
    with pytest.raises(ValueError):
        head_in_file_order(spark.read.parquet(str(tmp_path / "u")), 1)
