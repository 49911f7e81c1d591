"""Layered batch ingestion and table profiling on PySpark.

Functions take a caller's ``SparkSession`` and DataFrames and give DataFrames
back.  Only the sinks, ``plans.ingest`` and the first steps of
``operators.describe`` start Spark jobs.
"""

from tidemark.tables import RETURNS, SALES, STOCK, TableSpec

__all__ = ["RETURNS", "SALES", "STOCK", "TableSpec"]
