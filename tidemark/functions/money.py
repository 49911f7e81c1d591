"""Money in exact decimals, so that sums do not depend on the order of addition."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def money(value: Column | str) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return column.cast("decimal(12,2)")


def to_amount(total: Column) -> Column:
    """A decimal sum as a double with four places, for reports."""
    return total.cast("decimal(30,4)").cast("double")
