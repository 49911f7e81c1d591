"""Headered CSV: one file, many files, or a directory that keeps growing.

A quote inside a quoted value is written twice, as spreadsheets and data-frame tools do; pass ``escape`` for
files with another habit.  Line breaks inside quotes need ``multiLine=True``, which makes each file one task.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType, StructField, StructType

from tidemark.functions.text import map_null_tokens

NUMBER = r"(?i)^\s*[+-]?(\d+\.?\d*|\.\d+)([eE][+-]?\d+)?\s*$|^\s*[+-]?inf(inity)?\s*$"
#: Holds the whole line where a value is not of its type or the number of fields is not the header's.
MALFORMED = "_malformed"


class MalformedRows(ValueError):
    """Lines that are not what the header and the types say."""


def _declared(schema: StructType | str) -> StructType:
    return schema if isinstance(schema, StructType) else StructType.fromDDL(schema)


def _strict(schema: StructType, keep_malformed: bool) -> tuple[StructType, dict[str, str | bool]]:
    """Schema and options under which lines with another number of fields, and bad values that are read, are noticed."""
    options = {"header": True, "escape": '"', "enforceSchema": False, "columnPruning": False}
    if not keep_malformed:
        return schema, {**options, "mode": "FAILFAST"}
    flagged = StructType([*schema, StructField(MALFORMED, StringType())])
    return flagged, {**options, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": MALFORMED}


def _flagged(rows: DataFrame, schema: StructType) -> DataFrame:
    """The scan notices bad values only in the columns that a query reads, so the flag is made to read them all."""
    every = F.xxhash64(*(F.col(f"`{c}`") for c in schema.names))
    flag = F.when(every % 2 == 0, F.col(MALFORMED)).otherwise(F.concat(F.col(MALFORMED), F.lit("")))
    return rows.withColumn(MALFORMED, flag)


def read_csv(
    spark: SparkSession,
    path: str | list[str],
    schema: StructType | str | None = None,
    *,
    infer: bool = False,
    keep_malformed: bool = False,
    **options: str | bool,
) -> DataFrame:
    """Read headered, comma-separated UTF-8 files.

    With a ``schema`` the header of every file is checked against it, so a file with moved columns
    fails rather than filling the wrong columns.  A line with too many or too few fields fails as well, and one
    with a value that is not of its type as soon as a query reads that column; with ``keep_malformed`` both are
    kept instead, as text in the column ``_malformed``, which is null for sound lines.

    Without a schema the first header gives the names, which the other files must repeat.
    ``infer=True`` reads the input an extra time to find the types; otherwise every column is text.
    """
    if schema is None:
        settings = {"header": True, "escape": '"', **options}
        names = spark.read.options(inferSchema=infer, **settings).csv(path).schema
        return spark.read.schema(names).options(enforceSchema=False, **settings).csv(path)
    schema = _declared(schema)
    wanted, strict = _strict(schema, keep_malformed)
    rows = spark.read.schema(wanted).options(**strict).options(**options).csv(path)
    return _flagged(rows, schema) if keep_malformed else rows


def read_csv_loose(spark: SparkSession, path: str | list[str], **options: str | bool) -> DataFrame:
    """Read a CSV for profiling: loose null spellings, numbers typed, dates left as text.

    One pass over the input decides each column's type (integer, decimal number,
    true/false, text) from the values left after null tokens are mapped, so ``NA`` in
    a number column does not turn the column into text.  The same pass counts lines with another number of
    fields than the header; if there are any, ``MalformedRows`` is raised.
    """
    names = read_csv(spark, path, **options).schema
    raw = read_csv(spark, path, names, keep_malformed=True, **options)
    text = map_null_tokens(raw, names.names)
    measures = [_narrowest_type(c).alias(c) for c in names.names]
    found = text.agg(*measures, F.count(MALFORMED).alias(MALFORMED)).first()
    if found[MALFORMED]:
        raise MalformedRows(
            f"{found[MALFORMED]} lines have another number of fields than the header; "
            "quoted line breaks need multiLine=True"
        )
    return text.select(*(_typed(c, found[c]).alias(c) for c in names.names))


def _narrowest_type(name: str) -> Column:
    value = F.col(f"`{name}`")

    def always(test: Column) -> Column:
        return F.bool_and(F.when(value.isNotNull(), test))

    return (
        F.when(F.count(value) == 0, "double")
        .when(always(value.try_cast("bigint").isNotNull() & value.rlike(r"^\s*[+-]?\d+\s*$")), "bigint")
        .when(always(value.rlike(NUMBER)), "double")
        .when(always(F.lower(value).isin("true", "false")), "boolean")
        .otherwise("string")
    )


def _typed(name: str, kind: str) -> Column:
    value = F.col(f"`{name}`")
    return value if kind == "string" else value.cast(kind)


def stream_csv(
    spark: SparkSession,
    directory: str,
    schema: StructType | str,
    *,
    max_files_per_trigger: int | None = None,
    keep_malformed: bool = False,
    **options: str | bool,
) -> DataFrame:
    """Follow a directory of headered CSV files as a stream; malformed lines as in ``read_csv``."""
    schema = _declared(schema)
    wanted, strict = _strict(schema, keep_malformed)
    reader = spark.readStream.schema(wanted).options(**strict)
    if max_files_per_trigger is not None:
        reader = reader.option("maxFilesPerTrigger", max_files_per_trigger)
    rows = reader.options(**options).csv(directory)
    return _flagged(rows, schema) if keep_malformed else rows
