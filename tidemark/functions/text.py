"""Text cleaning as column expressions."""

from __future__ import annotations

from collections.abc import Iterable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# The texts that the usual data-frame CSV reader takes as missing.
NULL_TOKENS = (
    "", "#N/A", "#N/A N/A", "#NA", "-1.#IND", "-1.#QNAN", "-NaN", "-nan", "1.#IND", "1.#QNAN",
    "<NA>", "N/A", "NA", "NULL", "NaN", "None", "n/a", "nan", "null",
)


# Blanks, tabs, line breaks, no-break spaces and the byte order mark.
BLANKS = " \t\n\x0b\x0c\r\u00a0\u2007\u202f\ufeff"


def null_if_token(value: Column, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    return F.when(value.isin(*tokens), None).otherwise(value)


def map_null_tokens(df: DataFrame, columns: Iterable[str], tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Turn spelled-out nulls in text columns into nulls; the reader itself accepts one spelling."""
    return df.withColumns({c: null_if_token(F.col(f"`{c}`"), tokens) for c in columns})


def standard_text(value: Column, *, upper: bool = False, tokens: Sequence[str] = NULL_TOKENS) -> Column:
    """Trimmed text with spelled-out nulls removed, upper-cased on request."""
    cleaned = null_if_token(F.trim(value, F.lit(BLANKS)), tokens)
    return F.upper(cleaned) if upper else cleaned
