"""Dimensions, facts and answers on top of the cleaned tables.

Rows are summed up per join key before they meet a dimension.  A product or customer
with a third of all rows then brings at most one row per group and task to the join.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.operators.dedupe import dedupe


def dimension(
    df: DataFrame, key: Sequence[str], attributes: Sequence[str], prefer: Sequence[Column | str] = ()
) -> DataFrame:
    """One row per key with its attributes."""
    return dedupe(df.select(*key, *attributes), key, prefer)


def date_key(name: str) -> Column:
    """A day as the number yyyymmdd, by which facts refer to the calendar."""
    return F.date_format(F.col(f"`{name}`"), "yyyyMMdd").cast("int")


def calendar(df: DataFrame, date: str) -> DataFrame:
    """The days that occur in a column, with key, year, quarter and month."""
    day = F.col("cal_date")
    return (
        df.select(F.to_date(F.col(f"`{date}`")).alias("cal_date"))
        .where(day.isNotNull())
        .distinct()
        .select(
            date_key("cal_date").alias("date_key"),
            "cal_date",
            F.year(day).alias("cal_year"),
            F.quarter(day).alias("cal_quarter"),
            F.month(day).alias("cal_month"),
        )
    )


def month_of(name: str) -> Column:
    return F.date_format(F.col(f"`{name}`"), "yyyy-MM")


def fact(rows: DataFrame, by: Mapping[str, Column], totals: Mapping[str, Column]) -> DataFrame:
    """Row count and decimal totals per group."""
    return (
        rows.select(*(c.alias(n) for n, c in by.items()), *(c.alias(n) for n, c in totals.items()))
        .groupBy(*by)
        .agg(F.count(F.lit(1)).alias("rows"), *(F.sum(n).alias(n) for n in totals))
    )


def roll_up(parts: DataFrame, by: Sequence[str], totals: Sequence[str]) -> DataFrame:
    """Sum partial facts over fewer columns."""
    return parts.groupBy(*by).agg(*(F.sum(n).alias(n) for n in totals))


def sales_by_month(
    orders: DataFrame,
    customers: DataFrame,
    places: DataFrame,
    *,
    date: str,
    status: str,
    value: Column,
    customer: tuple[str, str],
    place: tuple[str, str],
    place_name: str,
) -> DataFrame:
    """Orders and revenue per month, customer's place and status.

    ``customer`` and ``place`` name the joined columns: (orders, customers) and (customers, places).
    """
    per_customer = fact(
        orders,
        {"month": month_of(date), customer[0]: F.col(customer[0]), "status": F.col(status)},
        {"revenue": value},
    )
    homes = customers.select(F.col(customer[1]).alias(customer[0]), F.col(place[0]).alias("_place"))
    per_place = roll_up(
        per_customer.join(homes, customer[0], "left"), ["month", "_place", "status"], ["rows", "revenue"]
    )
    names = places.select(F.col(place[1]).alias("_place"), F.col(place_name).alias("place"))
    return per_place.join(names, "_place", "left").groupBy("month", "place", "status").agg(
        F.sum("rows").alias("orders"), F.sum("revenue").alias("revenue")
    )


def returns_by_month(
    returns: DataFrame, *, date: str, product: str, quantity: Column, value: Column
) -> DataFrame:
    """Returned lines, pieces and value per month and product."""
    per_product = fact(
        returns, {"month": month_of(date), "product": F.col(product)}, {"quantity": quantity, "value": value}
    )
    return per_product.select(
        "month",
        "product",
        F.col("rows").alias("returned_lines"),
        F.col("quantity").alias("returned_quantity"),
        F.col("value").alias("returned_value"),
    )


def return_rate(
    lines: DataFrame, products: DataFrame, *, product: tuple[str, str], group: str, returned: Column, value: Column
) -> DataFrame:
    """Share of lines that came back, and their value, per product group (brand, category...).

    Lines whose product is unknown are reported under a null group.
    """
    per_product = fact(
        lines,
        {product[0]: F.col(product[0])},
        {"returned_lines": returned.cast("bigint"), "returned_value": F.when(returned, value)},
    )
    groups = products.select(F.col(product[1]).alias(product[0]), F.col(group))
    grouped = per_product.join(groups, product[0], "left")
    totals = roll_up(grouped, [group], ["rows", "returned_lines", "returned_value"])
    return totals.select(
        group,
        F.col("rows").alias("lines"),
        F.coalesce("returned_lines", F.lit(0)).alias("returned_lines"),
        F.coalesce("returned_value", F.lit(0)).alias("returned_value"),
        (F.coalesce("returned_lines", F.lit(0)) / F.col("rows")).alias("return_rate"),
    )


def orphan_keys(rows: DataFrame, key: str, parents: DataFrame, parent_key: str) -> DataFrame:
    """Keys that point at no parent, and how many rows use each."""
    used = rows.groupBy(key).agg(F.count(F.lit(1)).alias("rows")).where(F.col(key).isNotNull())
    return used.join(parents.select(F.col(parent_key).alias(key)), key, "left_anti")
