"""Load history, cleaning, dimensions and facts on small rows."""

import datetime as dt
from decimal import Decimal

from pyspark.sql import functions as F

from tidemark.functions import money, standard_text, to_amount
from tidemark.plans import Field, clean, gold, ignored_values, split_rejects, with_load_columns


def test_load_columns(spark, tmp_path):
    path = tmp_path / "day.csv"
    path.write_text("a\n1\n")
    row = with_load_columns(spark.read.csv(str(path), header=True), "b7").first()
    assert (row._batch_id, row._source_file.rsplit("/", 1)[1]) == ("b7", "day.csv")
    assert row._ingested_at is not None
    assert with_load_columns(spark.range(1), "b8", from_files=False).first()._source_file is None


def test_clean_and_split(spark):
    raw = spark.createDataFrame(
        [(" 1 ", " tech ", "9.5"), ("x", "N/A", "1"), (None, "b", "2"), ("4", "c", "much")],
        "id string, brand string, price string",
    )
    fields = (Field("id", "int", required=True), Field("brand", upper=True), Field("price", "double"))
    fit, rejects = split_rejects(clean(raw, fields))
    assert fit.dtypes == [("id", "int"), ("brand", "string"), ("price", "double")]
    assert [tuple(r) for r in fit.orderBy("id").collect()] == [(1, "TECH", 9.5), (4, "C", None)]
    # Rejects hold the columns as they came.
    assert {(r.id, r.brand, r.price, *r._problems) for r in rejects.collect()} == {
        ("x", "N/A", "1", "invalid: id"), (None, "b", "2", "missing: id"),
    }
    assert [tuple(r) for r in ignored_values(clean(raw, fields), ["id"]).collect()] == [(4, "price", "much")]


def test_values_that_would_change_are_invalid(spark):
    raw = spark.createDataFrame(
        [("10.990", "7.0", "x"), ("10.999", "7.5", "x"), ("99999999999.00", "1e2", "x"), ("1e-9", "9999999999", "x"), ("\t5\u00a0", " 7 ", "x")],
        "price string, n string, v string",
    )
    fields = (Field("price", "decimal(12,2)"), Field("n", "int"), Field("v", required=True))
    found = clean(raw, fields).collect()
    assert [(r.price, r.n) for r in found] == [
        (Decimal("10.99"), 7), (None, None), (None, None), (None, None), (Decimal("5.00"), 7),
    ]
    assert [r._problems for r in found[:2]] == [[], ["ignored: price", "ignored: n"]]


def test_clean_without_required_columns(spark):
    fit, rejects = split_rejects(clean(spark.sql("SELECT ' a ' AS x"), (Field("x"),)))
    assert (fit.first().x, rejects.count()) == ("a", 0)


def test_standard_text(spark):
    row = spark.sql("SELECT ' null ' AS a, ' Áudio ' AS b").select(
        standard_text(F.col("a")).alias("a"), standard_text(F.col("b"), upper=True).alias("b")
    )
    assert tuple(row.first()) == (None, "ÁUDIO")


def test_half_cents_are_exact(spark):
    rows = spark.sql("SELECT 0.1D * 3 AS price, 0.05D AS discount FROM range(1000)")
    net = money("price") * (1 - F.col("discount").cast("decimal(4,2)"))
    assert rows.agg(F.sum(net).alias("v")).first().v == Decimal("285.0000")
    assert rows.agg(to_amount(F.sum(net)).alias("v")).first().v == 285.0


def test_calendar(spark):
    days = spark.createDataFrame([(dt.date(2025, 11, 30),), (dt.date(2025, 11, 30),), (None,)], "d date")
    assert [tuple(r) for r in gold.calendar(days, "d").collect()] == [
        (20251130, dt.date(2025, 11, 30), 2025, 4, 11)
    ]


def test_dimension_has_one_row_per_key(spark):
    rows = spark.createDataFrame([(1, "a", 1), (1, "b", 2), (2, "c", 1)], "k int, name string, t int")
    found = gold.dimension(rows, ["k"], ["name", "t"], [F.desc("t")])
    assert {(r.k, r.name) for r in found.collect()} == {(1, "b"), (2, "c")}


def test_return_rate_keeps_lines_of_unknown_products(spark):
    rows = [(1, "R", 5.0), (1, "N", 5.0), (2, "R", 3.0), (9, "R", 1.0)]
    lines = spark.createDataFrame(rows, "p int, f string, v double")
    products = spark.createDataFrame([(1, "x"), (2, "y")], "p int, brand string")
    found = gold.return_rate(
        lines, products, product=("p", "p"), group="brand", returned=F.col("f") == "R", value=money("v")
    )
    assert {tuple(r) for r in found.collect()} == {
        ("x", 2, 1, 5.0, 0.5), ("y", 1, 1, 3.0, 1.0), (None, 1, 1, 1.0, 1.0),
    }


def test_return_rate_without_returns_is_zero(spark):
    lines = spark.createDataFrame([(1, None, 5.0)], "p int, f string, v double")
    products = spark.createDataFrame([(1, "x")], "p int, brand string")
    found = gold.return_rate(
        lines, products, product=("p", "p"), group="brand", returned=F.col("f") == "R", value=money("v")
    )
    assert [tuple(r) for r in found.collect()] == [("x", 1, 0, 0, 0.0)]


def test_orphan_keys(spark):
    rows = spark.createDataFrame([(1,), (1,), (2,), (None,)], "k int")
    parents = spark.createDataFrame([(2,)], "id int")
    assert [tuple(r) for r in gold.orphan_keys(rows, "k", parents, "id").collect()] == [(1, 2)]
