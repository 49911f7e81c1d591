"""Near duplicates among vectors.

The signs of a vector's products with random hyperplanes make a code in each of several tables. Two vectors at
angle x agree in a bit with probability 1 - x / pi, so the number of bits (from the number of vectors) and tables (from
the recall wanted for pairs that just reach the threshold) follow. Vectors with one label and one code stand in a
bucket. All pairs of a bucket are measured by their exact cosine, block by block, and a pair counts in
the first table that brings it together. A block passes on only each vector's number of links and its
root in a spanning forest of the block, so the output grows with the vectors and not with the pairs. Spark joins
the forests to connected components.

Equal vectors are measured once. Vectors that are null, zero or hold null or non-finite components, and vectors without
a label, link with nothing; nor do vectors of different lengths. Rows may repeat, and each counts. Null ids are never
the smallest. Other columns are not looked at. An empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterable, Iterator
from math import acos, ceil, log, log2, pi

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidemark.llm.common import in_parts, saved, whole_groups
from tidemark.llm.components import connected_components

THRESHOLD = 0.98
#: Part of the pairs at the threshold that some table brings together; more for closer pairs.
RECALL = 0.999
#: Vectors for each code that the number of bits aims at.
BUCKET = 32
#: Rows measured against each other at a time; larger buckets are cut into blocks.
BLOCK = 1024
_KEY = ["label", "dim", "t", "code", "i", "j"]


def tables_needed(vectors: int, threshold: float = THRESHOLD, recall: float = RECALL) -> tuple[int, int]:
    """(bits, tables) for that many vectors of one label."""
    bits = min(48, max(4, ceil(log2(max(2, vectors) / BUCKET))))
    together = (1 - acos(threshold) / pi) ** bits
    return bits, max(1, ceil(log(1 - recall) / log(1 - together)))


def _unit(vectors: np.ndarray) -> np.ndarray:
    """Rows of length one, safe for very large and very small components."""
    vectors = vectors / np.abs(vectors).max(1, keepdims=True)
    return vectors / np.linalg.norm(vectors, axis=1, keepdims=True)


def _codes(classes: DataFrame, bits: int, tables: int, seed: int) -> DataFrame:
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        planes: dict[int, np.ndarray] = {}
        weights = 1 << np.arange(bits, dtype=np.int64)
        for batch in batches:
            dims = batch["dim"].to_numpy(zero_copy_only=False)
            codes = np.zeros((len(dims), tables), np.int64)
            for dim in np.unique(dims).tolist():
                if dim not in planes:
                    planes[dim] = np.random.default_rng([seed, dim]).standard_normal((dim, tables * bits))
                at = np.flatnonzero(dims == dim)
                vectors = batch["embedding"].take(pa.array(at)).flatten().to_numpy(zero_copy_only=False)
                signs = _unit(vectors.reshape(-1, dim).astype(np.float64)) @ planes[dim] > 0
                codes[at] = signs.reshape(-1, tables, bits) @ weights
            lists = pa.ListArray.from_arrays(np.arange(len(dims) + 1, dtype=np.int32) * tables, pa.array(codes.ravel()))
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, lists], names=[*batch.schema.names, "codes"]
            )

    schema = ", ".join(f"{c} {t}" for c, t in classes.dtypes)
    return classes.mapInArrow(run, f"{schema}, codes array<bigint>")


def measured(ids, vectors, codes, sizes, left, right, table: int, threshold: float) -> Iterator[tuple[int, int, int]]:
    """(id, links, root) of the rows of one cell that have links there.

    ``left`` and ``right`` tell which rows are compared with which; a row may be on both sides.
    """
    near = np.zeros((len(ids), len(ids)), bool)
    rows, columns = np.flatnonzero(left), np.flatnonzero(right)
    units = _unit(vectors)
    near[np.ix_(rows, columns)] = units[rows] @ units[columns].T >= threshold
    near |= near.T
    np.fill_diagonal(near, False)
    a, b = np.nonzero(near)
    if table and len(a):
        seen = (codes[a, :table] == codes[b, :table]).any(1)
        near[a[seen], b[seen]] = False
        a, b = a[~seen], b[~seen]
    links = near @ sizes
    root = np.arange(len(ids))
    while True:
        lower = root.copy()
        np.minimum.at(lower, a, root[b])
        lower = lower[lower]
        if (lower == root).all():
            break
        root = lower
    for i in np.flatnonzero(links).tolist():
        yield int(ids[i]), int(links[i]), int(ids[root[i]])


def _cells(threshold: float):
    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        out = pa.schema([(c, pa.int64()) for c in ("cid", "links", "root")])

        def cell(rows: pa.Table) -> Iterator[tuple[int, int, int]]:
            def numbers(c):
                return rows[c].combine_chunks().to_numpy(zero_copy_only=False)

            def matrix(c):
                return rows[c].combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(len(rows), -1)

            own, i, j = numbers("own"), numbers("i"), numbers("j")
            yield from measured(
                numbers("cid"), matrix("embedding").astype(np.float64), matrix("codes"), numbers("size"),
                own == i, own == j, int(numbers("t")[0]), threshold,
            )

        for groups in whole_groups(batches, _KEY):
            yield from in_parts((x for rows in groups if len(rows) > 1 for x in cell(rows)), out)

    return run


def near_duplicates(
    vectors: DataFrame,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    id_col: str = "vec_id",
    vector_col: str = "embedding",
    label_col: str = "label",
    seed: int = 7,
    block: int = BLOCK,
) -> DataFrame:
    """Rows (id, n_links, component_id), one for each row of ``vectors``."""
    rows = vectors.select(
        F.col(f"`{id_col}`").cast("bigint").alias("id"),
        F.col(f"`{vector_col}`").alias("embedding"),
        F.col(f"`{label_col}`").cast("bigint").alias("label"),
    )
    sound = (
        F.col("label").isNotNull()
        & F.forall("embedding", lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
        & F.exists("embedding", lambda x: x != 0)
    )
    # A vector is known by 128 bits of hash.
    rows = rows.withColumn("sound", F.coalesce(sound, F.lit(False))).select(
        "id", "label", F.when(F.col("sound"), F.col("embedding")).alias("embedding"), "sound",
        F.xxhash64("embedding").alias("h1"), F.xxhash64(F.lit(1), "embedding", F.lit(2)).alias("h2"),
    )
    same = ["label", "h1", "h2"]
    classes = rows.where("sound").groupBy(*same).agg(
        F.count("*").alias("size"), F.min("id").alias("low"), F.first("embedding").alias("embedding")
    )
    classes = classes.withColumns({"dim": F.size("embedding").cast("bigint"), "cid": F.monotonically_increasing_id()})
    classes = saved(classes, "vectors")
    most = classes.groupBy("label", "dim").count().agg(F.max("count")).first()[0] or 0
    bits, tables = tables_needed(most, threshold, recall)
    coded = saved(_codes(classes.select("label", "dim", "cid", "size", "embedding"), bits, tables, seed), "codes")

    cell = coded.select("label", "dim", "cid", F.posexplode("codes").alias("t", "code"))
    large = cell.groupBy("label", "dim", "t", "code").count().where(F.col("count") > block)
    large = saved(large.withColumn("blocks", F.ceil(F.col("count") / block).cast("int")).drop("count"), "large-buckets")
    bucket = ["label", "dim", "t", "code"]
    spread = coded.select("*", F.posexplode("codes").alias("t", "code")).join(large, bucket, "left")
    # A large bucket is cut into blocks, and each pair of its blocks is a cell.
    own = F.coalesce(F.pmod(F.xxhash64("cid"), F.col("blocks")), F.lit(0)).cast("int")
    spread = spread.withColumn("own", own).withColumn(
        "other", F.explode(F.sequence(F.lit(0), F.coalesce(F.col("blocks"), F.lit(1)) - 1))
    )
    cells = spread.select(
        "label", "dim", "t", "code", F.least("own", "other").alias("i"), F.greatest("own", "other").alias("j"),
        "own", "cid", "size", "embedding", "codes",
    )
    cells = cells.repartition(*_KEY).sortWithinPartitions(*_KEY)
    links = saved(cells.mapInArrow(_cells(threshold), "cid bigint, links bigint, root bigint"), "links")

    per_class = links.groupBy("cid").agg(F.sum("links").alias("links"))
    component = connected_components(links.select(F.col("cid").alias("a"), F.col("root").alias("b")))
    found = (
        classes.select(*same, "cid", "size", "low")
        .join(per_class, "cid", "left")
        .join(component.withColumnRenamed("node", "cid"), "cid", "left")
        .withColumn("component", F.coalesce("component", "cid"))
    )
    # Stored, the smallest ids meet their rows in a join whose large partitions Spark can split.
    lowest = saved(found.groupBy("component").agg(F.min("low").alias("component_id")), "lowest")
    found = found.join(lowest, "component").select(
        *(F.col(c).alias(f"_{c}") for c in same),
        (F.coalesce(F.col("links"), F.lit(0)) + F.col("size") - 1).alias("n_links"),
        "component_id",
    )
    joined = rows.drop("embedding").join(found, F.expr("sound and label = _label and h1 = _h1 and h2 = _h2"), "left")
    return joined.select(
        "id",
        F.coalesce(F.col("n_links"), F.lit(0)).cast("bigint").alias("n_links"),
        F.when(F.col("n_links").isNull(), F.col("id")).otherwise(F.col("component_id")).alias("component_id"),
    )


#: All pairs; for small tables.
ORACLE_SQL = f"""
    WITH RECURSIVE rows AS (
        SELECT row_number() OVER () AS row, vec_id, embedding::DOUBLE[] AS v, label FROM embeddings
    ),
    sound AS (
        SELECT * FROM rows
        WHERE label IS NOT NULL AND v IS NOT NULL AND len(list_filter(v, lambda x: x IS NULL OR NOT isfinite(x))) = 0
              AND len(list_filter(v, lambda x: x <> 0)) > 0
    ),
    links AS (
        SELECT a.row AS a, b.row AS b
        FROM sound a JOIN sound b ON a.label = b.label AND len(a.v) = len(b.v) AND a.row <> b.row
        WHERE list_cosine_similarity(a.v, b.v) >= {THRESHOLD}
    ),
    reach AS (
        SELECT row AS a, row AS b FROM rows
        UNION SELECT r.a, l.b FROM reach r JOIN links l ON r.b = l.a
    ),
    component AS (
        SELECT r.a AS row, min(o.vec_id) AS component_id FROM reach r JOIN rows o ON o.row = r.b GROUP BY r.a
    ),
    degree AS (SELECT a AS row, count(*) AS n FROM links GROUP BY a)
    SELECT vec_id, coalesce(n, 0)::BIGINT AS n_links, component_id,
           vec_id IS NOT DISTINCT FROM component_id AS kept
    FROM rows JOIN component USING (row) LEFT JOIN degree USING (row)
"""
