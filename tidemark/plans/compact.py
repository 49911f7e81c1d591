"""Few large files where many loads have left small ones."""

from __future__ import annotations

from dataclasses import dataclass
from functools import reduce
from operator import and_

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from tidemark.operators.sinks import overwrite
from tidemark.plans.marks import read_mark, write_mark
from tidemark.sources.history import read_history
from tidemark.tables import TableSpec

#: Bytes that a file should have.
FILE_BYTES = 128 << 20
#: Directories named one by one in a scan's filter; more are looked up by a join.
NAMED_DIRECTORIES = 10_000


@dataclass(frozen=True)
class Compaction:
    """Directories that were rewritten, and files in these before and after."""

    directories: int
    files_before: int
    files_after: int


def directory_files(table: DataFrame, partition_by: tuple[str, ...]) -> DataFrame:
    """Rows (partition columns, files, bytes) of a stored table; reads footers and no column.

    Files without rows are not counted.
    """
    place = [F.col(f"`{c}`") for c in partition_by]
    files = table.select(*place, F.col("_metadata.file_path").alias("_path"), F.col("_metadata.file_size").alias("_size"))
    single = files.groupBy(*place, "_path").agg(F.first("_size").alias("_size"))
    return single.groupBy(*place).agg(F.count("*").alias("files"), F.sum("_size").alias("bytes"))


def fragmented(files: DataFrame, file_bytes: int) -> DataFrame:
    """The directories with more than twice as many files as their bytes need, which is ``bins``.

    Ranges that were cut by a sample may give a directory a file more than it needs, which is no reason to start over.
    """
    bins = F.greatest(F.ceil(F.col("bytes") / file_bytes), F.lit(1)).cast("bigint")
    return files.withColumn("bins", bins).where("files > 2 * bins")


def compact(spark: SparkSession, uri: str, spec: TableSpec, *, file_bytes: int = FILE_BYTES) -> Compaction:
    """Rewrite the directories of a stored table that hold many small files; the others stay as they are.

    The rows of these directories are first copied beside the table; from the copy their new files are made, in key
    order, and swapped in directory by directory. A run that dies before the copy is complete has changed nothing;
    one that dies later is carried on by the next call from the copy, which also keeps rows that were appended in
    between. Like ingestion, this needs to be the table's only writer while it runs; readers that look at a directory in the
    moment of its swap may miss it, so give them a time of their own.

    The table must have declared types, a key that is unique and not null, and directories. A null directory value is one
    like any other. A table that was never stored, or is empty, has nothing to rewrite.
    """
    if spec.schema is None or not spec.partition_by:
        raise ValueError(f"{spec.name} needs declared types and partition columns")
    schema = StructType.fromDDL(spec.schema)
    if read_history(spark, uri, schema) is None:
        return Compaction(0, 0, 0)
    carried_on = _swap(spark, uri, spec, schema, file_bytes)
    table = read_history(spark, uri, schema)
    found = fragmented(directory_files(table, spec.partition_by), file_bytes)
    run = (read_mark(spark, uri, "compaction") or 0) + 1
    copy = f"{uri}/_compaction/{run}"
    directories = _kept(found, f"{copy}-fragmented")
    if directories.isEmpty():
        return carried_on
    rows = _among(_pruned(table, directories, spec.partition_by), directories, spec.partition_by)
    rows.write.mode("overwrite").parquet(copy)
    # Odd numbers stand for a complete copy that waits, even ones for none.
    write_mark(spark, uri, "compaction", run)
    return _swap(spark, uri, spec, schema, file_bytes)


def _kept(rows: DataFrame, path: str) -> DataFrame:
    rows.write.mode("overwrite").parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


def _pruned(table: DataFrame, directories: DataFrame, partition_by: tuple[str, ...]) -> DataFrame:
    """The table without directories that differ in some column from all of those given, if these can be named."""
    named = directories.select(*(f"`{c}`" for c in partition_by)).limit(NAMED_DIRECTORIES + 1).collect()
    if len(named) > NAMED_DIRECTORIES:
        return table
    for i, c in enumerate(partition_by):
        values = {r[i] for r in named}
        test = F.col(f"`{c}`").isin([v for v in values if v is not None])
        table = table.where(test | F.col(f"`{c}`").isNull() if None in values else test)
    return table


def _among(rows: DataFrame, directories: DataFrame, partition_by: tuple[str, ...]) -> DataFrame:
    wanted = directories.select(*(F.col(f"`{c}`").alias(f"_directory_{i}") for i, c in enumerate(partition_by)))
    same = reduce(and_, (F.col(f"`{c}`").eqNullSafe(F.col(f"_directory_{i}")) for i, c in enumerate(partition_by)))
    return rows.join(wanted, same, "left_semi")


def _n_files(table: DataFrame, directories: DataFrame, partition_by: tuple[str, ...]) -> int:
    files = directory_files(_pruned(table, directories, partition_by), partition_by)
    return _among(files, directories, partition_by).agg(F.sum("files")).first()[0] or 0


def _swap(spark: SparkSession, uri: str, spec: TableSpec, schema: StructType, file_bytes: int) -> Compaction:
    """Put the rows of a waiting copy, and others that came into its directories since, in place of these directories."""
    run = read_mark(spark, uri, "compaction") or 0
    if run % 2 == 0:
        return Compaction(0, 0, 0)
    by, copy_uri = spec.partition_by, f"{uri}/_compaction/{run}"
    names = [f"`{f.name}`" for f in schema]
    copy = spark.read.schema(schema).parquet(copy_uri)
    size = copy.select("_metadata.file_path", "_metadata.file_size").distinct().agg(F.sum("file_size")).first()[0] or 0
    copy = copy.select(*names)
    directories = _kept(copy.select(*(f"`{c}`" for c in by)).distinct(), f"{copy_uri}-directories")
    n_directories = directories.count()
    table = read_history(spark, uri, schema)
    before = _n_files(table, directories, by)
    current = _among(_pruned(table, directories, by), directories, by)
    added = current.join(copy.select(*(f"`{c}`" for c in spec.key)), [*spec.key], "left_anti").select(*names)
    added = _kept(added, f"{copy_uri}-added")
    # A task for each file's worth of bytes: small directories share one, and a large one gets its share of them.
    tasks = max(1, -(-size // file_bytes))
    overwrite(copy.unionByName(added), uri, by, spec.key, only_written_partitions=True, tasks=tasks)
    write_mark(spark, uri, "compaction", run + 1)
    after = _n_files(read_history(spark, uri, schema), directories, by)
    for done in (copy_uri, f"{copy_uri}-added"):
        spark.createDataFrame([], schema).write.mode("overwrite").parquet(done)
    return Compaction(n_directories, before, after)
