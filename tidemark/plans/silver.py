"""Cleaned, typed tables and the rows that did not qualify."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.functions.text import NULL_TOKENS, standard_text


@dataclass(frozen=True)
class Field:
    """How one column is cleaned: its type, whether to upper-case it, whether it must be there."""

    name: str
    type: str = "string"
    upper: bool = False
    required: bool = False


def clean(df: DataFrame, fields: Sequence[Field], tokens: Sequence[str] = NULL_TOKENS) -> DataFrame:
    """Standardise and type the named columns.

    Text is trimmed and spelled-out nulls become nulls; a value that is not of its
    column's type, or would be rounded or cut to fit it, becomes null.  ``_problems`` lists, per row, the required
    columns without a usable value as ``missing: c`` or ``invalid: c``, and the values of other columns that
    were not usable as ``ignored: c``.  ``_texts`` holds the named columns as they came.
    """
    given = [F.col(f"`{f.name}`").cast("string").alias(f.name) for f in fields]
    texts = df.select(F.struct(*given).alias("_texts")).select(
        *(standard_text(F.col(f"_texts.`{f.name}`"), upper=f.upper, tokens=tokens).alias(f.name) for f in fields),
        "_texts",
    )
    problems = []
    for f in fields:
        value = F.col(f"`{f.name}`")
        bad = value.isNotNull() & _exactly(value, f.type).isNull()
        if f.required:
            problems.append(F.when(value.isNull(), f"missing: {f.name}").when(bad, f"invalid: {f.name}"))
        else:
            problems.append(F.when(bad, f"ignored: {f.name}"))
    return texts.select(
        *(_exactly(F.col(f"`{f.name}`"), f.type).alias(f.name) for f in fields),
        F.array_compact(F.array(*problems).cast("array<string>")).alias("_problems"),
        "_texts",
    )


def _exactly(value: Column, kind: str) -> Column:
    """A text as a value of a type, null where that would change its value."""
    if kind in ("tinyint", "smallint", "int", "bigint"):
        whole = F.substring_index(value, ".", 1)
        return F.when(value.rlike(r"^[+-]?\d+$"), value.try_cast(kind)).when(
            value.rlike(r"^[+-]?\d+\.0*$"), whole.try_cast(kind)
        )
    typed = value.try_cast(kind)
    if kind.startswith("decimal"):
        scale = int(kind.rstrip(") ").rpartition(",")[2]) if "," in kind else 0
        # A digit beyond the scale, or a power of ten that may stand for one.
        longer = value.rlike(rf"\.\d{{{scale}}}\d*[1-9]|[eE]")
        return F.when(~longer, typed)
    return typed


def split_rejects(cleaned: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Rows fit for the cleaned table, and the others: their columns as they came, and their ``_problems``."""
    fit = F.forall("_problems", lambda p: p.startswith("ignored: "))
    return cleaned.where(fit).drop("_problems", "_texts"), cleaned.where(~fit).select("_texts.*", "_problems")


def ignored_values(cleaned: DataFrame, key: Sequence[str]) -> DataFrame:
    """The values left out of rows that are fit: (key, column, text), one row for each."""
    fit = F.forall("_problems", lambda p: p.startswith("ignored: "))
    found = cleaned.where(fit).select(*(f"`{c}`" for c in key), "_texts", F.explode("_problems").alias("_problem"))
    names = [f.name for f in cleaned.schema["_texts"].dataType]
    text = F.coalesce(*(F.when(F.col("_problem") == f"ignored: {c}", F.col(f"_texts.`{c}`")) for c in names))
    column = F.substring("_problem", len("ignored: ") + 1, F.lit(1 << 30))
    return found.select(*(f"`{c}`" for c in key), column.alias("column"), text.alias("text"))
