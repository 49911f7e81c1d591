"""One spelling for each value of a text column.

Spellings that agree but for case, accents, punctuation and the order of words have one key. A rare key that is one letter
away from a frequent one, with the same digits, is a slip and counts as the frequent one. The most frequent
spelling of a key stands for all.

Only the different spellings, with their counts, are compared, and no pair of them is ever listed: a key stands under each
string that leaves out one of its letters, together with the place left out, and just the most frequent key of each such
group is kept. Keys that differ by a letter replaced share the group of that place; keys that differ by a letter
more or less meet where the shorter one stands as a whole. So every key meets its most frequent neighbour.
"""

from __future__ import annotations

import unicodedata

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemark.workspace import fresh_dir

#: How many times as frequent a key must be for a neighbour to count as a slip of it.
TIMES = 2
#: Letters that a key has at least for a slip to be looked for: short words have true neighbours.
LEAST_LETTERS = 4


def _folding() -> tuple[str, str]:
    """Latin letters with marks, and the same letters without."""
    pairs = [(chr(c), unicodedata.normalize("NFD", chr(c))[0]) for c in range(0xC0, 0x250)]
    pairs = [(a, b) for a, b in pairs if a != b and a == a.lower()]
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def collision_key(value: Column) -> Column:
    """What spellings of one value have in common: their words, in lower case without accents, sorted."""
    marked, plain = _folding()
    folded = F.translate(F.lower(value), marked, plain)
    # Marks that stand behind their letter, and all that is neither letter nor digit.
    words = F.split(F.regexp_replace(F.regexp_replace(folded, r"\p{M}", ""), r"[^\p{L}\p{N}]+", " "), " ")
    return F.array_join(F.array_sort(F.array_distinct(F.filter(words, lambda w: w != ""))), " ")


def _stored(rows: DataFrame, label: str) -> DataFrame:
    path = fresh_dir(rows.sparkSession, label)
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _slips(keys: DataFrame, times: float, least_letters: int) -> DataFrame:
    """Rows (key, into): keys that are a slip of a more frequent one, and the most frequent such."""
    # Letters and digits apart: a slip in a number is another number.
    letters = F.regexp_replace("key", r"[\p{N}]", "")
    known = keys.select("key", "n", letters.alias("letters"), F.regexp_replace("key", r"[^\p{N}]", "").alias("digits"))
    known = known.where(F.length("letters") >= least_letters)
    # The more frequent is the lesser struct; of equals the lesser key.
    rank = F.struct((-F.col("n")).alias("down"), "key")
    without = F.expr(
        "transform(sequence(1, length(letters)), i -> struct(i as place, "
        "concat(substring(letters, 1, i - 1), substring(letters, i + 1)) as rest))"
    )
    exploded = known.select("key", "n", "digits", F.explode(without).alias("_")).select("key", "n", "digits", "_.*")
    left_out = _stored(exploded, "letters-left-out")
    best = F.min(rank).alias("best")
    replaced = left_out.join(left_out.groupBy("digits", "place", "rest").agg(best), ["digits", "place", "rest"])
    longer = left_out.groupBy("digits", "rest").agg(best).withColumnRenamed("rest", "letters")
    shorter = known.groupBy("digits", "letters").agg(best).withColumnRenamed("letters", "rest")
    found = (
        replaced.select("key", "n", "best")
        .unionByName(known.join(longer, ["digits", "letters"]).select("key", "n", "best"))
        .unionByName(left_out.join(shorter, ["digits", "rest"]).select("key", "n", "best"))
        .where(-F.col("best.down") >= F.col("n") * times)
    )
    return found.groupBy("key").agg(F.min("best")["key"].alias("into"))


def standard_spellings(
    df: DataFrame, column: str, times: float = TIMES, least_letters: int = LEAST_LETTERS
) -> DataFrame:
    """Rows (spelling, standard, rows), one for each different value of a text column.

    ``standard`` is the most frequent spelling of the key that the value's key comes to, of equals the lesser one. Values
    without letters and digits stand for themselves; nulls are left out. ``times`` must be above one, so that slips of
    slips come to an end. An empty table gives no rows.
    """
    if times <= 1:
        raise ValueError("a slip must be rarer than what it is a slip of")
    value = F.col(f"`{column}`")
    counts = df.where(value.isNotNull()).groupBy(value.alias("spelling")).agg(F.count(F.lit(1)).alias("rows"))
    key = collision_key(F.col("spelling"))
    counts = _stored(counts.select("*", F.when(key != "", key).alias("key")), "spellings")
    keyed = counts.where("key IS NOT NULL")
    most = F.min(F.struct((-F.col("rows")).alias("down"), "spelling"))["spelling"]
    keys = _stored(keyed.groupBy("key").agg(F.sum("rows").alias("n"), most.alias("own")), "keys")
    into = _stored(_slips(keys, times, least_letters), "slips")
    # A slip of a slip: counts grow at least ``times`` fold with each step, so there are few steps, and each pass halves them.
    while True:
        further = into.select("key", F.col("into").alias("_at")).join(into.toDF("_at", "_on"), "_at", "left")
        if further.where("_on IS NOT NULL").isEmpty():
            break
        into = _stored(further.select("key", F.coalesce("_on", "_at").alias("into")), "slips")
    ends = keyed.join(into, "key", "left").withColumn("key", F.coalesce("into", "key")).drop("into")
    named = ends.join(keys.select("key", "own"), "key")
    known = named.select("spelling", F.col("own").alias("standard"), "rows")
    return known.unionByName(counts.where("key IS NULL").select("spelling", F.col("spelling").alias("standard"), "rows"))


def with_standard(df: DataFrame, column: str, spellings: DataFrame) -> DataFrame:
    """The rows with every value of the column replaced by its standard spelling; nulls stay."""
    own = spellings.select(F.col("spelling").alias("_spelling"), F.col("standard").alias("_standard"))
    joined = df.join(own, F.col(f"`{column}`") == F.col("_spelling"), "left")
    standard = F.coalesce("_standard", F.col(f"`{column}`")).alias(column)
    return joined.select(*(standard if c == column else F.col(f"`{c}`") for c in df.columns))
