"""Secrets in texts: known forms, and strings too random to be words.

Known forms are found by pattern. Beyond them, a window of fixed length slides over every candidate string of a
character class. The counts of its characters change by one that comes and one that goes, and with them the sum of
c * log2(c), which gives the window's Shannon entropy. Windows at or above the class's limit are joined
into spans. The allow-list judges the parts of a candidate between ``+ / _ = -``: a part that is a plain number, a word or
name, or holds a placeholder or alphabet ends the window, and so does a UUID; what stands beside it is still looked
at. Spans inside a known form are left out.

All of this is column expressions over one row: nothing is shuffled and no Python runs. Patterns repeat single
characters only, never groups, so that they need no stack, and time grows with a string's length however long it is.
Positions count code points, ends are exclusive. Null counts as an empty text, which has no spans. Rows may repeat;
other columns are kept by ``redact`` and left out by ``find``. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass
from math import log2

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

#: The known forms, in the order in which spans with one start are listed.
ASSIGN = r"""((?:[pP][aA][sS][sS][wW][oO][rR][dD]|[pP][aA][sS][sS][wW][dD]|[sS][eE][cC][rR][eE][tT]|[tT][oO][kK][eE][nN]|[aA][pP][iI]_?[kK][eE][yY]))["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)"""
ACCESS = r"AKIA[A-Z0-9]+"
HEX = r"[0-9a-f]+"
LEAST = {"assign": 6, "access": 20, "hex": 24}


@dataclass(frozen=True)
class CharacterClass:
    """Strings of ``window`` or more such characters are candidates; ``bits`` is the entropy to reach."""

    kind: str
    characters: str
    window: int
    bits: float

    @property
    def pattern(self) -> str:
        return f"[{self.characters}]{{{self.window},}}"

    @property
    def weights(self) -> list[int]:
        """c * log2(c) for each count, in millionths, so that sums are exact."""
        return [0, *(round(c * log2(c) * 1e6) for c in range(1, self.window + 1))]

    @property
    def most(self) -> int:
        """The largest sum of weights that a window with enough entropy has."""
        return round((log2(self.window) - self.bits) * self.window * 1e6)


CLASSES = (
    CharacterClass("entropy_hex", "0-9A-Fa-f", 24, 3.0),
    CharacterClass("entropy_base64", "A-Za-z0-9+/_=-", 24, 4.0),
)
#: What separates the parts of a candidate, and the parts that are no secrets.
SEPARATOR = "[+/_=-]"
ALLOWED = (r"[0-9]+", r"[A-Za-z]{3,}[0-9]{0,4}")
PLACEHOLDERS = ("EXAMPLE", "example", "XXXX", "xxxx", "0123456789", "ABCDEFGH", "abcdefgh")
UUID = "[0-9a-fA-F]{8}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{4}-[0-9a-fA-F]{12}"
#: Words as long as a UUID's parts, which stand in for one.
WORDS = "aaaaaaaa-aaaa-aaaa-aaaa-aaaaaaaaaaaa"
KINDS = ("assign", "access", "hex", *(c.kind for c in CLASSES))
_BLOCK = 256


def _running(values: Column, add: Callable[[Column, Column], Column], zero: int) -> Column:
    """The sum, or what ``add`` makes, of the numbers of an array up to and with each.

    Appending copies an array, so the results are made in blocks and these put together.
    """
    blocks = F.when(F.size(values) == 0, F.array().cast("array<array<bigint>>")).otherwise(
        F.transform(
            F.sequence(F.lit(0), F.expr("0") + F.floor((F.size(values) - 1) / _BLOCK).cast("int")),
            lambda b: F.slice(values, b * _BLOCK + 1, F.lit(_BLOCK)),
        )
    )
    nothing = F.lit(zero).cast("bigint").alias("all")

    def inside(block: Column) -> Column:
        return F.aggregate(
            block,
            F.struct(nothing, F.array().cast("array<bigint>").alias("each")),
            lambda s, x: F.struct(add(s["all"], x).alias("all"), F.array_append(s["each"], add(s["all"], x)).alias("each")),
        )

    def shifted(done: Column, part: Column) -> Column:
        ahead = done["all"]
        return F.struct(
            add(ahead, part["all"]).alias("all"),
            F.array_append(done["parts"], F.transform(part["each"], lambda x: add(ahead, x))).alias("parts"),
        )

    start = F.struct(nothing, F.array().cast("array<array<bigint>>").alias("parts"))
    return F.aggregate(F.transform(blocks, inside), start, shifted, lambda s: F.flatten(s["parts"]))


def _running_sums(values: Column) -> Column:
    return _running(values, lambda a, b: a + b, 0)


def _located(rows: DataFrame, name: str, pattern: str) -> DataFrame:
    """Adds array ``name`` of (start, end, found) of the leftmost non-overlapping matches in ``_text``.

    The parts between the matches give the places of these.
    """
    found, ends = f"_{name}_found", f"_{name}_ends"
    rows = rows.withColumn(found, F.regexp_extract_all("_text", F.lit(pattern), F.lit(0)))
    gaps = F.split("_text", pattern, -1)
    before = F.slice(gaps, F.lit(1), F.size(found))
    steps = F.zip_with(found, before, lambda m, g: (F.length(g) + F.length(m)).cast("bigint"))
    none = F.array().cast("array<bigint>")
    # Hardly any text has matches; the others are not split.
    rows = rows.withColumn(f"_{name}_steps", F.when(F.size(found) > 0, steps).otherwise(none))
    rows = rows.withColumn(ends, F.when(F.size(found) > 0, _running_sums(F.col(f"_{name}_steps"))).otherwise(none))
    spans = F.zip_with(
        found,
        ends,
        lambda m, end: F.struct((end - F.length(m)).alias("start"), end.alias("end"), m.alias("found")),
    )
    return rows.withColumn(name, spans).drop(found, ends, f"_{name}_steps")


def _with_kind(spans: Column, kind: str) -> Column:
    rank = KINDS.index(kind)
    return F.transform(
        spans,
        lambda s: F.struct(
            s["start"].cast("bigint").alias("start"),
            F.lit(rank).alias("rank"),
            s["end"].cast("bigint").alias("end"),
            F.lit(kind).alias("kind"),
        ),
    )


def allowed_places(candidate: Column) -> Column:
    """A string as long as the candidate: a blank where a character is in an allowed part, else an x."""
    fits = "^(?:" + "|".join(ALLOWED) + ")$|" + "|".join(PLACEHOLDERS)
    parts = F.transform(
        F.split(candidate, SEPARATOR, -1), lambda p: F.repeat(F.when(p.rlike(fits), " ").otherwise("x"), F.length(p))
    )
    return F.array_join(parts, "x")


def _bound(value: Column, use: Callable[[Column], Column]) -> Column:
    """``use`` of a value that is worked out once, however often it is used.

    An aggregate over nothing hands its start to its last step as it is; a transform would copy the result.
    """
    return F.aggregate(F.array().cast("array<int>"), value, lambda held, _: held, use)


def _touching_joined(spans: Column) -> Column:
    """Sorted spans, those that touch or overlap as one."""
    starts = F.filter(spans, lambda s, i: F.coalesce(F.get(spans, i - 1)["end"] < s["start"], F.lit(True)))
    ends = F.filter(spans, lambda s, i: F.coalesce(F.get(spans, i + 1)["start"] > s["end"], F.lit(True)))
    return F.zip_with(starts, ends, lambda a, b: F.struct(a["start"].alias("start"), b["end"].alias("end")))


def random_windows(candidate: Column, places: Column, kind: CharacterClass) -> Column:
    """The spans (start, end) of a string in which some window without a blank in ``places`` has the class's entropy.

    The state holds the counts of the window's characters, by their place among the string's different
    characters, several packed into one number; a step changes two of them. An allowed part starts the window anew.
    """
    spans = "array<struct<start:bigint,end:bigint>>"
    weight = F.array(*(F.lit(w) for w in kind.weights))
    width = kind.window
    bits = width.bit_length()
    packed = 62 // bits

    def count(counts: Column, code: Column) -> Column:
        word = F.call_function("shiftright", F.get(counts, code["word"]), code["shift"])
        return word.bitwiseAND((1 << bits) - 1).cast("int")

    def steps(parts: Column) -> Column:
        codes, none = parts["codes"], parts["none"]
        zero = F.struct(
            none.alias("counts"),
            F.lit(0).cast("bigint").alias("sum"),
            F.lit(0).alias("run"),
            F.lit(-1).cast("bigint").alias("from"),
            F.lit(-1).cast("bigint").alias("to"),
            F.array().cast(spans).alias("closed"),
        )

        def step(state: Column, i: Column) -> Column:
            """Character i, from 0, comes in; if the window is full, character i - width goes out."""

            def counted(moved: Column) -> Column:
                comes, goes = moved["comes"], moved["goes"]
                more = count(state["counts"], comes)
                less = count(state["counts"], goes)
                gain = F.get(weight, more + 1) - F.get(weight, more)
                loss = F.when(goes.isNull(), 0).otherwise(F.get(weight, less) - F.get(weight, less - 1))
                same = F.coalesce(comes == goes, F.lit(False))
                counts = F.transform(
                    state["counts"],
                    lambda c, k: c
                    + F.when(k == comes["word"], comes["unit"]).otherwise(0)
                    - F.when(k == goes["word"], goes["unit"]).otherwise(0),
                )
                return _bound(
                    F.struct(
                        F.when(same, state["sum"]).otherwise(state["sum"] + gain - loss).cast("bigint").alias("sum"),
                        F.when(same, state["counts"]).otherwise(counts).alias("counts"),
                        F.least(state["run"] + 1, F.lit(width)).alias("run"),
                    ),
                    advanced,
                )

            def advanced(now: Column) -> Column:
                hit = (now["run"] >= width) & (now["sum"] <= kind.most)
                begins = (i - width + 1).cast("bigint")
                joined = begins <= state["to"]
                opened = state["from"] >= 0
                closed = F.struct(state["from"].alias("start"), state["to"].alias("end"))
                return F.struct(
                    now["counts"].alias("counts"),
                    now["sum"].alias("sum"),
                    now["run"].alias("run"),
                    F.when(hit & ~(joined & opened), begins).otherwise(state["from"]).alias("from"),
                    F.when(hit, (i + 1).cast("bigint")).otherwise(state["to"]).alias("to"),
                    F.when(hit & opened & ~joined, F.array_append(state["closed"], closed))
                    .otherwise(state["closed"])
                    .alias("closed"),
                )

            comes = F.element_at(codes, i + 1)
            full = state["run"] >= width
            goes = F.when(full, F.element_at(codes, F.greatest(i - width + 1, F.lit(1))))
            emptied = F.struct(
                none.alias("counts"), zero["sum"].alias("sum"), zero["run"].alias("run"),
                state["from"].alias("from"), state["to"].alias("to"), state["closed"].alias("closed"),
            )
            moved = F.struct(comes.alias("comes"), goes.alias("goes"))
            return F.when(comes["word"] < 0, emptied).otherwise(_bound(moved, counted))

        def close(state: Column) -> Column:
            last = F.struct(state["from"].alias("start"), state["to"].alias("end"))
            return F.when(state["from"] >= 0, F.array_append(state["closed"], last)).otherwise(state["closed"])

        def block(b: Column) -> Column:
            """The windows that end in a block; those before only fill its first one."""
            first = F.greatest(b * _BLOCK - (width - 1), F.lit(0))
            last = F.least((b + 1) * _BLOCK, F.size(codes)) - 1
            return F.aggregate(F.sequence(first, last), zero, step, close)

        # Every step copies the state with its closed spans, so a state lives for one block only.
        blocks = F.sequence(F.lit(0), F.floor((F.size(codes) - 1) / _BLOCK).cast("int"))
        return _bound(F.flatten(F.transform(blocks, block)), _touching_joined)

    def coded(read: Column) -> Column:
        def code(letter: Column, place: Column) -> Column:
            return _bound(
                F.when(place == " ", -1).otherwise(F.array_position(read["kinds"], letter).cast("int") - 1),
                lambda n: F.struct(
                    F.floor(n / packed).cast("int").alias("word"),
                    (F.pmod(n, F.lit(packed)) * bits).alias("shift"),
                    F.call_function("shiftleft", F.lit(1).cast("bigint"), F.pmod(n, F.lit(packed)) * bits).alias("unit"),
                ),
            )

        words = F.floor((F.size(read["kinds"]) - 1) / packed).cast("int") + 1
        return F.struct(
            F.zip_with(read["letters"], read["places"], code).alias("codes"),
            F.array_repeat(F.lit(0).cast("bigint"), words).alias("none"),
        )

    def read(letters: Column) -> Column:
        return F.struct(
            letters.alias("letters"), F.array_distinct(letters).alias("kinds"), F.split(places, "").alias("places")
        )

    return _bound(F.split(candidate, ""), lambda letters: _bound(read(letters), lambda r: _bound(coded(r), steps)))


def _random_spans(rows: DataFrame, kind: CharacterClass) -> DataFrame:
    rows = _located(rows, f"_{kind.kind}", kind.pattern)
    judged = F.transform(
        F.transform(
            f"_{kind.kind}",
            lambda s: F.struct(s["start"].alias("start"), F.regexp_replace(s["found"], UUID, WORDS).alias("found")),
        ),
        lambda s: F.struct(s["start"], s["found"], allowed_places(s["found"]).alias("places")),
    )
    # Most candidates are words and numbers all through; no window is slid over these.
    kept = F.filter(judged, lambda s: s["places"].rlike(f"x{{{kind.window}}}"))
    rows = rows.withColumn(f"_{kind.kind}", kept)
    spans = F.flatten(
        F.transform(
            f"_{kind.kind}",
            lambda s: F.transform(
                random_windows(s["found"], s["places"], kind),
                lambda w: F.struct((s["start"] + w["start"]).alias("start"), (s["start"] + w["end"]).alias("end")),
            ),
        )
    )
    outside = F.filter(
        spans, lambda s: ~F.exists("_base", lambda b: (b["start"] <= s["start"]) & (b["end"] >= s["end"]))
    )
    none = F.array().cast("array<struct<start:bigint,end:bigint>>")
    return rows.withColumn(
        f"_{kind.kind}", _with_kind(F.when(F.size(f"_{kind.kind}") > 0, outside).otherwise(none), kind.kind)
    )


def _group_of(pattern: str, group: int, least: int) -> Callable[[Column], Column]:
    """Whether a match's group has enough characters."""
    return lambda s: F.length(F.regexp_extract(s["found"], pattern, group)) >= least


def with_spans(docs: DataFrame, text_col: str = "text") -> DataFrame:
    """Adds ``_text``, ``_base`` and ``_spans``; spans are (start, rank, end, kind), in that order."""
    rows = docs.withColumn("_text", F.coalesce(F.col(f"`{text_col}`"), F.lit("")))
    for kind, pattern in (("assign", ASSIGN), ("access", ACCESS), ("hex", "[0-9a-f]{24,}")):
        rows = _located(rows, f"_{kind}", pattern)
    for kind, least in LEAST.items():
        group = 2 if kind == "assign" else 0
        pattern = {"assign": ASSIGN, "access": ACCESS, "hex": HEX}[kind]
        long_enough = F.filter(f"_{kind}", _group_of(pattern, group, least))
        rows = rows.withColumn(f"_{kind}", _with_kind(long_enough, kind))
    rows = rows.withColumn("_base", F.array_sort(F.concat("_assign", "_access", "_hex")))
    for kind in CLASSES:
        rows = _random_spans(rows, kind)
    spans = F.array_sort(F.concat("_base", *(f"_{c.kind}" for c in CLASSES)))
    return rows.withColumn("_spans", spans).drop("_assign", "_access", "_hex", *(f"_{c.kind}" for c in CLASSES))


def _listed(spans: str) -> Column:
    def spelled(s: Column) -> Column:
        return F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))

    return F.array_join(F.transform(spans, spelled), ",")


def find(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Rows (id, found, n_assign, n_access, n_hex, base_sha256, spans), one for each row of ``docs``.

    ``found`` holds all spans with their text.
    """
    rows = with_spans(docs.select(F.col(f"`{id_col}`").alias("id"), F.col(f"`{text_col}`").alias("text")))

    def number(kind: str) -> Column:
        return F.size(F.filter("_base", lambda s: s["kind"] == kind)).cast("bigint").alias(f"n_{kind}")

    return rows.select(
        "id",
        F.transform(
            "_spans",
            lambda s: F.struct(
                s["kind"].alias("kind"),
                s["start"].alias("start"),
                s["end"].alias("end"),
                F.substring("_text", s["start"].cast("int") + 1, (s["end"] - s["start"]).cast("int")).alias("text"),
            ),
        ).alias("found"),
        *(number(kind) for kind in LEAST),
        F.sha2(_listed("_base"), 256).alias("base_sha256"),
        _listed("_spans").alias("spans"),
    )


def redact(
    docs: DataFrame, text_col: str = "text", mark: str = "[secret]", length_col: str | None = None
) -> DataFrame:
    """The rows of ``docs`` with every span of their text replaced by ``mark``.

    ``length_col`` names a column that gets the new number of characters where the text has changed.
    """
    # The given columns wait in a struct, so that none of their names meets one used here.
    given = docs.select(F.struct(*(f"`{c}`" for c in docs.columns)).alias("_row"), F.col(f"`{text_col}`").alias("_given"))
    rows = with_spans(given, "_given").withColumn("_to", _running(F.col("_spans.end"), F.greatest, -1))
    # Overlapping spans become one: it ends at the furthest end up to where the next span starts beyond that.
    starts = F.filter("_spans", lambda s, i: F.coalesce(F.get("_to", i - 1) <= s["start"], F.lit(True)))
    ends = F.filter("_to", lambda to, i: F.coalesce(F.get("_spans", i + 1)["start"] >= to, F.lit(True)))
    joined = F.zip_with(starts, ends, lambda s, to: F.struct(s["start"].alias("start"), to.alias("end")))
    rows = rows.withColumn("_spans", joined)
    n = F.size("_spans")
    begins = F.transform(F.sequence(F.lit(0), n), lambda i: F.when(i == 0, 0).otherwise(F.get("_spans", i - 1)["end"]))
    ends = F.transform(
        F.sequence(F.lit(0), n), lambda i: F.when(i == n, F.length("_text")).otherwise(F.get("_spans", i)["start"])
    )
    between = F.zip_with(begins, ends, lambda b, e: F.substring("_text", b.cast("int") + 1, (e - b).cast("int")))
    rows = rows.withColumn("_new", F.when(n > 0, F.array_join(between, mark)))
    changed = {text_col: F.coalesce("_new", "_given")}
    if length_col is not None:
        kind = docs.schema[length_col].dataType
        changed[length_col] = F.coalesce(F.length("_new").cast(kind), F.col(f"_row.`{length_col}`"))
    return rows.select(*(changed.get(c, F.col(f"_row.`{c}`")).alias(c) for c in docs.columns))


def _sql_spans(kind: str, pattern: str) -> str:
    return f"""
        SELECT row, '{kind}' AS kind, {KINDS.index(kind)} AS rank, found, until - length(found) AS start, until AS "end"
        FROM (
            SELECT row, found, sum(length(gap) + length(found)) OVER (PARTITION BY row ORDER BY i) AS until
            FROM (
                SELECT row, unnest(ms) AS found, unnest(gaps[:len(ms)]) AS gap, unnest(range(len(ms))) AS i
                FROM (
                    SELECT row, regexp_extract_all(t, '{pattern.replace("'", "''")}') AS ms,
                           regexp_split_to_array(t, '{pattern.replace("'", "''")}') AS gaps
                    FROM texts
                )
            )
        )"""


def _sql_windows(kind: CharacterClass) -> str:
    """Each window's entropy from its own counts."""
    fits = "^(?:" + "|".join(ALLOWED) + ")$|" + "|".join(PLACEHOLDERS)
    return f"""
        SELECT row, kind, rank, min(place) AS start, max(place) + {kind.window} AS "end"
        FROM (
            SELECT *, sum(fresh) OVER (PARTITION BY row, kind, start ORDER BY place) AS island
            FROM (
                SELECT *, CASE WHEN place - lag(place) OVER (PARTITION BY row, kind, start ORDER BY place) <= {kind.window}
                          THEN 0 ELSE 1 END AS fresh
                FROM (
                    SELECT row, kind, rank, start, start + w AS place,
                           list_transform(
                               list_distinct(string_split(substr(judged, w + 1, {kind.window}), '')),
                               lambda x: {kind.weights}[1 + {kind.window}
                                   - length(replace(substr(judged, w + 1, {kind.window}), x, ''))]) AS weights
                    FROM (
                        SELECT *, unnest(range(length(judged) - {kind.window} + 1)) AS w,
                               array_to_string(list_transform(
                                   regexp_split_to_array(judged, '{SEPARATOR}'),
                                   lambda p: repeat(CASE WHEN regexp_matches(p, '{fits}') THEN ' ' ELSE 'x' END, length(p))
                               ), 'x') AS places
                        FROM (
                            SELECT *, regexp_replace(found, '{UUID}', '{WORDS}', 'g') AS judged
                            FROM ({_sql_spans(kind.kind, kind.pattern)})
                        )
                    )
                    WHERE strpos(substr(places, w + 1, {kind.window}), ' ') = 0
                )
                WHERE list_sum(weights) <= {kind.most}
            )
        )
        GROUP BY row, kind, rank, start, island"""


ORACLE_SQL = f"""
    WITH texts AS (SELECT row_number() OVER () AS row, doc_id, coalesce(text, '') AS t FROM documents),
    base AS (
        SELECT row, kind, rank, start, "end" FROM ({_sql_spans("assign", ASSIGN)})
        WHERE length(regexp_extract(found, '{ASSIGN.replace("'", "''")}', 2)) >= {LEAST["assign"]}
        UNION ALL SELECT row, kind, rank, start, "end" FROM ({_sql_spans("access", ACCESS)})
        WHERE length(found) >= {LEAST["access"]}
        UNION ALL SELECT row, kind, rank, start, "end" FROM ({_sql_spans("hex", HEX)})
        WHERE length(found) >= {LEAST["hex"]}
    ),
    random AS ({" UNION ALL ".join(_sql_windows(c) for c in CLASSES)}),
    every AS (
        SELECT *, true AS known FROM base
        UNION ALL SELECT row, kind, rank, start, "end", false AS known FROM random r
        WHERE NOT EXISTS (SELECT 1 FROM base b WHERE b.row = r.row AND b.start <= r.start AND b."end" >= r."end")
    ),
    listed AS (
        SELECT row, count(*) FILTER (known AND kind = 'assign') AS n_assign,
               count(*) FILTER (known AND kind = 'access') AS n_access, count(*) FILTER (known AND kind = 'hex') AS n_hex,
               string_agg(kind || ':' || start || ':' || "end", ',' ORDER BY start, rank) FILTER (known) AS base_spans,
               string_agg(kind || ':' || start || ':' || "end", ',' ORDER BY start, rank) AS spans
        FROM every GROUP BY row
    )
    SELECT doc_id, coalesce(n_assign, 0)::BIGINT AS n_assign, coalesce(n_access, 0)::BIGINT AS n_access,
           coalesce(n_hex, 0)::BIGINT AS n_hex, sha256(coalesce(base_spans, '')) AS base_sha256,
           coalesce(spans, '') AS spans
    FROM texts LEFT JOIN listed USING (row)
"""
