"""Exact descriptive statistics of numeric columns."""

from __future__ import annotations

import math
from collections.abc import Callable, Sequence
from dataclasses import dataclass, replace
from functools import reduce
from itertools import count

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.types import NumericType

from tidemark.operators.profile import present

# Most different values one task orders to pick a quartile from.
POOL_ROWS = 1_000_000
_LEAST_POOL_ROWS = 1_000
# Wide tables are described in several passes, each reading its own columns.
_COLUMNS_AT_ONCE = 16
_SAMPLE_ROWS = 200_000


@dataclass(frozen=True)
class _Bracket:
    """Values between which the order statistics ``rank`` and, if ``share``, ``rank + 1`` lie."""

    column: str
    quarter: int
    rank: int
    share: float
    low: float
    high: float
    below: int  # rows less than low
    upto_low: int  # rows not above low, or less when unknown
    below_high: int  # rows less than high, or more when unknown
    upto_high: int  # rows not above high

    @property
    def between(self) -> int:
        return 0 if self.low == self.high else self.below_high - self.upto_low

    def cut(self, value: float, less: int, equal: int) -> _Bracket:
        """The bracket after learning how many rows are less than and equal to ``value``."""
        found = self
        if less <= self.rank and value >= self.low:
            found = replace(found, low=value, below=less, upto_low=less + equal)
        if less + equal > self.rank + (self.share > 0) and value <= self.high:
            found = replace(found, high=value, below_high=less, upto_high=less + equal)
        return found


def describe(df: DataFrame, columns: Sequence[str] | None = None, *, pool_rows: int = POOL_ROWS) -> DataFrame:
    """Count, mean, sample deviation, minimum, quartiles and maximum; one row per column.

    Quartiles are exact, linearly interpolated order statistics.  The built-in exact
    percentile gathers every different value of a column in one task, so it is not used.
    Instead each quartile is bracketed: a sample suggests two cut values, a counting
    pass gives their exact ranks, and this repeats until few enough values lie between
    them to be ordered by one task.  A poor sample costs another pass, never a wrong
    result.  Up to ``pool_rows`` values (1,000 at least) no bracketing is needed.
    """
    groups = _in_groups(numeric(df) if columns is None else list(columns))
    return reduce(DataFrame.unionAll, (_describe(df, group, pool_rows) for group in groups))


def numeric(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema if isinstance(f.dataType, NumericType)]


def _in_groups(names: list[str]) -> list[list[str]]:
    return [names[i : i + _COLUMNS_AT_ONCE] for i in range(0, len(names), _COLUMNS_AT_ONCE)] or [[]]


def describe_known(
    df: DataFrame, facts: Sequence[tuple], quantile: Callable[[str, Sequence[float]], list[float]], error: float, *,
    pool_rows: int = POOL_ROWS,
) -> DataFrame:
    """As ``describe``, with what is known beforehand: neither the summary nor a sample is read.

    ``facts`` are (column, count, mean, deviation, min, max); ``quantile`` gives values of a column at some
    ranks, which are right but for ``error``. Wrong ones cost another pass, never a wrong result.
    """

    def first(brackets: list[_Bracket]) -> list[tuple[_Bracket, list[float]]]:
        cuts = []
        for b in brackets:
            at = b.rank / b.upto_high
            margin = 2 * error + 2 / b.upto_high
            cuts.append((b, quantile(b.column, [max(0.0, at - margin), min(1.0, at + margin)])))
        return cuts

    known = {fact[0]: tuple(fact) for fact in facts}
    groups = _in_groups(list(known))
    return reduce(DataFrame.unionAll, (_describe(df, g, pool_rows, [known[c] for c in g], first) for g in groups))


_Suggestion = Callable[[list[_Bracket]], list[tuple[_Bracket, list[float]]]]


def _describe(
    df: DataFrame,
    names: list[str],
    pool_rows: int,
    summary: list[tuple] | None = None,
    first: _Suggestion | None = None,
) -> DataFrame:
    values = df.select(*(present(df, c).cast("double").alias(c) for c in names))
    if summary is None:
        summary = _summary(values, names)
    widest = [b for s in summary for b in _quartiles(s)]
    brackets = _bracket(values, widest, pool_rows, first)
    facts = df.sparkSession.createDataFrame(
        summary, "`column` string, `count` bigint, mean double, std double, `min` double, `max` double"
    )
    return facts.join(F.broadcast(_pick(values, brackets, brackets != widest)), "column", "left").select(
        "column", "count", "mean", "std", "min", "q25", "q50", "q75", "max"
    )


def _summary(values: DataFrame, names: list[str]) -> list[tuple]:
    if not names:
        return []
    measures = (F.count, F.avg, F.stddev_samp, F.min, F.max)
    row = values.agg(*(f(f"`{c}`").alias(f"{i}:{c}") for c in names for i, f in enumerate(measures))).first()
    return [(c, *(row[f"{i}:{c}"] for i in range(len(measures)))) for c in names]


def _quartiles(facts: tuple) -> list[_Bracket]:
    name, rows, _, _, low, high = facts
    found = []
    for quarter in (1, 2, 3) if rows else ():
        rank, rest = divmod((rows - 1) * quarter, 4)
        found.append(_Bracket(name, quarter, rank, rest / 4, low, high, 0, 0, rows, rows))
    return found


def _bracket(
    values: DataFrame, brackets: list[_Bracket], pool_rows: int, first: _Suggestion | None = None
) -> list[_Bracket]:
    """Narrow the brackets until each holds few enough values; a handful of rounds at any size."""
    for seed in count():
        wide = [b for b in brackets if b.between > max(pool_rows, _LEAST_POOL_ROWS)]
        if not wide:
            break
        cuts = first(wide) if first and seed == 0 else _suggest(values, wide, seed)
        ranks = _ranks(values, {(b.column, v) for b, pair in cuts for v in pair})
        narrowed = {}
        for bracket, pair in cuts:
            after = bracket
            for value in pair:
                after = after.cut(value, *ranks[bracket.column, value])
            narrowed[bracket] = after
        stuck = [b for b, after in narrowed.items() if after.between >= b.between]
        if stuck:
            # The sample gave nothing new: a value from inside always narrows a bracket.
            inner = _inside(values, stuck, seed)
            ranks = _ranks(values, {(b.column, v) for b, v in inner.items()})
            narrowed.update({b: narrowed[b].cut(v, *ranks[b.column, v]) for b, v in inner.items()})
        brackets = [narrowed.get(b, b) for b in brackets]
    return brackets


def _inside(values: DataFrame, brackets: list[_Bracket], seed: int) -> dict[_Bracket, float]:
    """For each bracket some value between its ends; both ends are known, so there is one."""
    drawn = values.withColumn("_draw", F.rand(-1 - seed))
    measures = []
    for i, b in enumerate(brackets):
        column = F.col(f"`{b.column}`")
        measures.append(F.min_by(column, F.when((column > b.low) & (column < b.high), F.col("_draw"))).alias(str(i)))
    row = drawn.agg(*measures).first()
    return {b: row[str(i)] for i, b in enumerate(brackets)}


def _suggest(values: DataFrame, brackets: list[_Bracket], seed: int) -> list[tuple[_Bracket, list[float]]]:
    """Two values per bracket, from a sample, that very likely enclose its order statistics."""
    shared: dict[tuple, list[_Bracket]] = {}
    for b in brackets:
        shared.setdefault((b.column, b.low, b.high), []).append(b)
    drawn = values.withColumn("_draw", F.rand(seed))
    measures = []
    for i, ((name, low, high), users) in enumerate(shared.items()):
        inside = users[0].upto_high - users[0].below
        taken = min(inside, _SAMPLE_ROWS)
        margin = 2.5 * math.sqrt((1 - taken / inside) / taken) + 2 / inside + 0.0002
        places = [(b.rank - b.below) / inside for b in users]
        ends = [min(1.0, max(0.0, at + step)) for at in places for step in (-margin, margin)]
        column = F.col(f"`{name}`")
        sample = F.when(column.between(low, high) & (F.col("_draw") < taken / inside), column)
        measures.append(F.percentile_approx(sample, ends, 10_000).alias(str(i)))
    row = drawn.agg(*measures).first()
    return [
        (b, row[str(i)][2 * j : 2 * j + 2] if row[str(i)] else [])
        for i, users in enumerate(shared.values())
        for j, b in enumerate(users)
    ]


def _ranks(values: DataFrame, cuts: set[tuple[str, float]]) -> dict[tuple[str, float], tuple[int, int]]:
    """For each cut value, the exact number of rows less than it and equal to it."""
    ordered = sorted(cuts)
    if not ordered:
        return {}
    row = values.agg(
        *(F.count_if(F.col(f"`{c}`") < v).alias(f"less{i}") for i, (c, v) in enumerate(ordered)),
        *(F.count_if(F.col(f"`{c}`") == v).alias(f"equal{i}") for i, (c, v) in enumerate(ordered)),
    ).first()
    return {cut: (row[f"less{i}"], row[f"equal{i}"]) for i, cut in enumerate(ordered)}


def _within(values: DataFrame, parts: list[tuple[str, float, float]], narrow: bool = True) -> DataFrame:
    """Rows (part, value) for the values that lie in a part's bracket; other values generate none.

    Where the brackets hold all values but nulls (not ``narrow``), taking these out of the rows is cheaper.
    """
    cells = [
        F.when(F.col(f"`{c}`").between(low, high), F.struct(F.lit(i).alias("part"), F.col(f"`{c}`").alias("value")))
        for i, (c, low, high) in enumerate(parts)
    ]
    none = F.array().cast("array<struct<part:int,value:double>>")
    if not narrow and cells:
        return values.select(F.inline(F.array(*cells))).where("part IS NOT NULL")
    return values.select(F.inline(F.array_compact(F.array(*cells)) if cells else none))


def _pick(values: DataFrame, brackets: list[_Bracket], narrow: bool) -> DataFrame:
    """Read the order statistics off the brackets' values, equal values counted together first."""
    parts = list(dict.fromkeys((b.column, b.low, b.high) for b in brackets))
    targets = values.sparkSession.createDataFrame(
        [(parts.index((b.column, b.low, b.high)), b.column, b.quarter, b.rank - b.below, b.share) for b in brackets],
        "part int, `column` string, quarter int, rank bigint, share double",
    )
    pool = _within(values, parts, narrow).groupBy("part", "value").agg(F.count(F.lit(1)).alias("n"))
    seen = Window.partitionBy("part").orderBy("value").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    ranked = pool.withColumn("upto", F.sum("n").over(seen))

    def value_at(rank: Column) -> Column:
        return F.max(F.when((F.col("upto") > rank) & (F.col("upto") - F.col("n") <= rank), F.col("value")))

    picked = (
        ranked.join(F.broadcast(targets), "part")
        .where((F.col("upto") > F.col("rank")) & (F.col("upto") - F.col("n") <= F.col("rank") + 1))
        .groupBy("column", "quarter", "share")
        .agg(value_at(F.col("rank")).alias("lower"), value_at(F.col("rank") + 1).alias("upper"))
        .withColumn("value", _between(F.col("lower"), F.col("upper"), F.col("share")))
    )
    return picked.groupBy("column").agg(
        *(F.max(F.when(F.col("quarter") == q, F.col("value"))).alias(f"q{25 * q}") for q in (1, 2, 3))
    )


def _between(lower: Column, upper: Column, share: Column) -> Column:
    """Linear interpolation from the nearer end, rounded as data-frame profiling does."""
    gap = upper - lower
    return (
        F.when((share == 0) | (lower == upper), lower)
        .when(share < 0.5, lower + gap * share)
        .otherwise(upper - gap * (1 - share))
    )
