"""Dimensions with their history, and facts that meet the version in force at their time.

Versions follow from what loads have seen of a key: neighbouring observations with equal attributes are one version, which
holds from the first of them until the next version begins. To find the changes of a key with very many
observations, these are first compared inside spans of time, in as many tasks as there are spans; only the first of each
span and those that differ from the one before are then compared along the whole key.

An as-of join orders a key's versions and facts by time in one shuffle and carries the last version forward; no
fact meets more than one version, and nothing is compared across a range. A key with very many facts is dealt out over
several tasks, each of which gets a copy of that key's versions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tidemark.operators.dedupe import dedupe
from tidemark.operators.newrows import has_key
from tidemark.workspace import fresh_dir

#: Seconds of a span in which a key's observations are compared first.
SPAN = 86_400
#: Facts of a key beyond which it is dealt out over several tasks.
SPLIT = 1_000_000
#: Keys with more facts than that, sent to every task; of more such keys Spark joins the list its own way.
BROADCAST_KEYS = 100_000

FROM, UNTIL, VERSION, CURRENT = "valid_from", "valid_until", "version", "is_current"


def _named(columns: Sequence[str]) -> list[Column]:
    return [F.col(f"`{c}`") for c in columns]


def _span(at: str, seconds: int) -> Column:
    return F.floor(F.unix_micros(F.col(f"`{at}`").cast("timestamp")) / (seconds * 1_000_000)).cast("bigint")


def dimension_history(
    observations: DataFrame,
    key: Sequence[str],
    attributes: Sequence[str],
    at: str,
    prefer: Sequence[Column | str] = (),
    *,
    span: int = SPAN,
) -> DataFrame:
    """Rows (key, attributes, valid_from, valid_until, version, is_current), one for each version of a key.

    ``at`` is a date or time column. A version holds from ``valid_from``, the first observation of its attributes, up to but
    without ``valid_until``, which is null for the current one; versions count from 1. Of several observations
    of a key at one time the first by ``prefer`` counts, remaining ties are settled by the other columns. A null attribute
    is a value like any other. Observations without a key or a time are left out. An empty table gives no versions.
    """
    once = dedupe(observations.where(has_key([*key, at])), [*key, at], prefer)
    state = F.struct(*_named(attributes)) if attributes else F.lit(0)
    rows = once.select(*_named([*key, at, *attributes]), state.alias("_state"), _span(at, span).alias("_span"))

    def changes(rows: DataFrame, *by: str) -> DataFrame:
        """Rows that are the first of their group or differ from the row before."""
        along = Window.partitionBy(*_named([*key, *by])).orderBy(F.col(f"`{at}`"))
        before = rows.withColumns({"_first": F.row_number().over(along) == 1, "_before": F.lag("_state").over(along)})
        return before.where("_first OR NOT (_state <=> _before)").drop("_first", "_before")

    found = changes(changes(rows, "_span"))
    along = Window.partitionBy(*_named(key)).orderBy(F.col(f"`{at}`"))
    until = F.lead(F.col(f"`{at}`")).over(along)
    return found.select(
        *_named([*key, *attributes]),
        F.col(f"`{at}`").alias(FROM),
        until.alias(UNTIL),
        F.row_number().over(along).alias(VERSION),
        until.isNull().alias(CURRENT),
    )


def as_of(
    facts: DataFrame,
    versions: DataFrame,
    key: Sequence[str],
    at: str,
    columns: Sequence[str],
    valid_from: str = FROM,
    *,
    split: int = SPLIT,
) -> DataFrame:
    """The facts, with ``columns`` of the version of their key that was in force at their time.

    That is the version with the latest ``valid_from`` not after ``at``; these two must have one type. Facts before the first
    version, of an unknown key, or without key or time get nulls, and none is lost or repeated. Of versions
    of a key that begin at one time the greatest by ``columns`` counts. ``columns`` must not be among the facts' columns.
    """
    clash = sorted(set(columns) & set(facts.columns))
    if clash:
        raise ValueError(f"columns of both facts and versions: {clash}")
    slot, late, version, fact = "_slot", "_late", "_version", "_fact"
    keyed = facts.select(
        *(F.col(f"`{c}`").alias(f"_key_{i}") for i, c in enumerate(key)),
        F.col(f"`{at}`").alias("_at"),
        F.struct(*_named(facts.columns)).alias(fact),
    )
    keys = [f"_key_{i}" for i in range(len(key))]
    known = has_key([*keys, "_at"])

    counts = keyed.where(known).groupBy(*keys).agg(F.count("*").alias("_n")).where(F.col("_n") > split)
    path = fresh_dir(facts.sparkSession, "hot-keys")
    counts.select(*keys, F.ceil(F.col("_n") / split).cast("int").alias("_slots")).write.parquet(path)
    hot = facts.sparkSession.read.parquet(path)
    n_hot = hot.count()
    if 0 < n_hot <= BROADCAST_KEYS:
        hot = F.broadcast(hot)

    def dealt(rows: DataFrame, place: Column) -> DataFrame:
        if not n_hot:
            return rows.withColumn(slot, F.lit(0))
        slots = F.coalesce(F.col("_slots"), F.lit(1))
        return rows.join(hot, keys, "left").withColumn("_slots", slots).withColumn(slot, place).drop("_slots")

    # Any spread does, so long as a row that is worked out again gets the same slot.
    own = F.pmod(F.xxhash64("_at", fact), F.col("_slots")).cast("int")
    right = versions.where(has_key([*key, valid_from])).select(
        *(F.col(f"`{c}`").alias(f"_key_{i}") for i, c in enumerate(key)),
        F.col(f"`{valid_from}`").alias("_at"),
        F.struct(*_named(columns)).alias(version),
    )
    left = dealt(keyed, own).withColumns({late: F.lit(1), version: F.lit(None).cast(right.schema[version].dataType)})
    copies = dealt(right, F.explode(F.sequence(F.lit(0), F.col("_slots") - 1)))
    copies = copies.withColumns({late: F.lit(0), fact: F.lit(None).cast(keyed.schema[fact].dataType)})
    # Facts without a key or a time are not sent to one task together.
    unknown = left.where(~known)
    both = left.where(known).unionByName(copies)
    # Versions come before facts of the same time, lesser ones first.
    order = [F.col("_at"), F.col(late), F.col(version)]
    forward = Window.partitionBy(*keys, slot).orderBy(*order).rowsBetween(Window.unboundedPreceding, Window.currentRow)
    met = both.withColumn(version, F.last(version, ignorenulls=True).over(forward)).where(F.col(late) == 1)
    return met.unionByName(unknown).select(f"{fact}.*", *(F.col(f"{version}.`{c}`").alias(c) for c in columns))

