"""Web archives, and an audit of their replicas by Merkle trees.

Pages become records of archives: WARC/1.1, one after another, written as files. An audit reads the bytes of two replicas
again, each record at the offset where it stands. Bytes that are no record, by damage or a cut, are one leaf up to where the next
record begins, so nothing stops the reading. The leaves of a tree are the SHA-256 of records and of such stretches. A range
of offsets is known by the hash of what begins in it, in order, with offsets and lengths; ranges are put together 16 at a time,
up to the whole archive. Two replicas whose roots agree are equal. Where they differ, only ranges with different hashes are
opened, one level after the other, down to the records.

Pages are shuffled once, to their archives; the audit shuffles hashes. Archives are dealt by a hash of the record, and copies of
one record in great number by the task they came from as well, so an archive has about its size whatever repeats. A node has as
many children as records begin in 64 KiB, or 16, so no group grows with the corpus.

Null html is an empty record, a null url leaves its header out, a null id is empty. Rows may repeat: equal records stand
beside each other in an archive. Other columns are not looked at; an empty table gives no archives. A very long page makes
its archive as much longer.
"""

from __future__ import annotations

import hashlib
import re
import zlib
from collections.abc import Callable, Iterable, Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from tidemark.llm.common import in_parts, saved

#: Bytes of an archive, about; a task reads some of them at once.
ARCHIVE = 4 << 20
#: Copies of a record beyond which they are dealt to several archives.
COPIES = 1000
#: Logarithms of the ranges' lengths, from the leaves up; an archive of any length is one root.
RANGES = (16, 20, 24, 28)
DATE = "2024-01-01T00:00:00Z"
_END = "\r\n\r\n"


def record(page_id: Column, url: Column, html: Column) -> Column:
    """The text of a page's record; line breaks in a url are written as %0D and %0A."""
    target = F.regexp_replace(F.regexp_replace(url, "\r", "%0D"), "\n", "%0A")
    body = F.coalesce(html, F.lit(""))
    return F.concat(
        F.lit("WARC/1.1\r\nWARC-Type: resource\r\nWARC-Record-ID: <urn:page:"),
        F.coalesce(page_id.cast("string"), F.lit("")),
        F.lit(">\r\n"),
        F.coalesce(F.concat(F.lit("WARC-Target-URI: "), target, F.lit("\r\n")), F.lit("")),
        F.lit(f"WARC-Date: {DATE}\r\nContent-Type: text/html\r\nContent-Length: "),
        F.octet_length(body).cast("string"),
        F.lit(_END),
        body,
        F.lit(_END),
    )


def archive(
    pages: DataFrame, size: int = ARCHIVE, id_col: str = "page_id", url_col: str = "url", html_col: str = "html"
) -> DataFrame:
    """Rows (file, id, record): the records of all pages, dealt by id to archives of about ``size`` bytes."""
    page_id = F.col(f"`{id_col}`").cast("bigint")
    text = record(page_id, F.col(f"`{url_col}`"), F.col(f"`{html_col}`"))
    rows = pages.select(page_id.alias("id"), text.alias("record")).withColumn("mark", F.md5("record"))
    total = rows.agg(F.sum(F.octet_length("record").cast("bigint"))).first()[0] or 0
    files = max(1, -(-total // size))
    many = rows.groupBy("mark").agg(F.count("*").alias("n")).where(F.col("n") > COPIES)
    many = saved(many.select("mark", F.lit(True).alias("many")), "frequent-records")
    salt = F.lit(0)
    if not many.isEmpty():
        rows = rows.withColumn("_task", F.spark_partition_id()).join(many, "mark", "left")
        salt = F.when(F.col("many"), F.col("_task")).otherwise(0)
    number = F.conv(F.substring("mark", 1, 8), 16, 10).cast("bigint")
    return rows.select(F.pmod(number + salt, F.lit(files)).alias("file"), "id", "record")


def write_archives(records: DataFrame, path: str, compression: str = "gzip") -> None:
    """The archives of rows (file, id, record) as files ``file=N/...``, one for each, records in the order of ``leaves``.

    ``compression`` is gzip, or none.
    """
    # The writer ends each row as a record ends.
    rows = records.select("file", "id", F.sha2("record", 256).alias("digest"), F.expr("left(record, length(record) - 2)").alias("value"))
    rows = rows.repartition("file").sortWithinPartitions("file", F.col("id").asc_nulls_first(), "digest")
    rows.select("file", "value").write.partitionBy("file").options(lineSep="\r\n", compression=compression).text(path)


def leaves(records: DataFrame) -> DataFrame:
    """Rows (file, id, offset, length, digest): where each record stands in its archive, and its hash."""
    hashed = records.select(
        "file", "id", F.octet_length("record").cast("bigint").alias("length"), F.sha2("record", 256).alias("digest")
    )
    # Unknown ids come first; equal records are interchangeable.
    order = Window.partitionBy("file").orderBy(F.col("id").asc_nulls_first(), "digest")
    ahead = F.sum("length").over(order.rowsBetween(Window.unboundedPreceding, -1))
    return hashed.select("file", "id", F.coalesce(ahead, F.lit(0)).alias("offset"), "length", "digest")


@dataclass
class Tree:
    """``levels`` are (file, node, start, end, digest): first the ranges above the leaves, last the roots."""

    leaves: DataFrame
    levels: list[DataFrame]


def _spelled(child: Column) -> Column:
    return F.concat_ws(":", child["start"].cast("string"), child["end"].cast("string"), child["digest"])


def tree(found: DataFrame, ranges: tuple[int, ...] = RANGES) -> Tree:
    """The Merkle trees over the leaves of all archives."""
    below = found.withColumns({"start": F.col("offset"), "end": F.col("offset") + F.col("length")})
    levels = []
    for log2 in (*ranges, None):
        node = F.lit(0).cast("bigint") if log2 is None else F.shiftright("start", log2)
        children = F.sort_array(F.collect_list(F.struct("start", "end", "digest")))
        spelled = F.transform("children", _spelled)
        nodes = (
            below.withColumn("node", node)
            .groupBy("file", "node")
            .agg(children.alias("children"), F.min("start").alias("start"), F.max("end").alias("end"))
            .select("file", "node", "start", "end", F.sha2(F.array_join(spelled, ","), 256).alias("digest"))
        )
        below = saved(nodes, "merkle")
        levels.append(below)
    return Tree(found, levels)


def _unequal(one: DataFrame, other: DataFrame, inside: DataFrame | None, key: Column) -> DataFrame:
    """The nodes (file, node) below unequal ones that only one side has or that differ."""
    sides = []
    for rows in (one, other):
        rows = rows.withColumn("parent", key)
        if inside is not None:
            rows = rows.join(inside.select("file", F.col("node").alias("parent")), ["file", "parent"], "left_semi")
        sides.append(rows.select("file", "node", "digest"))
    both = sides[0].alias("x").join(sides[1].alias("y"), ["file", "node"], "full")
    return both.where("not x.digest <=> y.digest").select("file", "node")


def audit(one: Tree, other: Tree, ranges: tuple[int, ...] = RANGES) -> DataFrame:
    """The records of ``one`` and ``other`` that do not agree: (file, id, offset, length, digest, found, status).

    ``found`` is the hash in ``other``. A record with another hash at its offset is corrupt; one that stands elsewhere
    in its archive has moved; others are missing or, if only in ``other``, extra. Offset, length and digest are
    those of ``one`` but for extra records.
    """
    inside = None
    steps = [None, *reversed(ranges)]
    for level in range(len(ranges), -1, -1):
        above = steps[len(ranges) - level - 1] if level < len(ranges) else None
        key = F.lit(0).cast("bigint") if above is None else F.shiftright("start", above)
        inside = saved(_unequal(one.levels[level], other.levels[level], inside, key), "unequal")
    key = F.shiftright("offset", ranges[0]) if ranges else F.lit(0).cast("bigint")
    x, y = (
        t.leaves.withColumn("node", key).join(inside, ["file", "node"], "left_semi").drop("node") for t in (one, other)
    )
    # Repeated records of one id are told apart by their order.
    turn = F.row_number().over(Window.partitionBy("file", "id", "digest").orderBy("offset"))
    x, y = x.withColumn("turn", turn), y.withColumn("turn", turn)
    same = F.expr("x.file = y.file and x.id <=> y.id and x.digest = y.digest and x.turn = y.turn")
    at_x, at_y = x.alias("x").join(y.alias("y"), same, "left_anti"), y.alias("x").join(x.alias("y"), same, "left_anti")
    moved = x.alias("x").join(y.alias("y"), same).where("x.offset <> y.offset")
    columns = ["file", "id", "offset", "length", "digest"]
    moved = moved.select(*(f"x.{c}" for c in columns), F.col("y.digest").alias("found"), F.lit("moved").alias("status"))
    place = F.expr("x.file = y.file and x.offset = y.offset")
    status = F.expr("case when x.file is null then 'extra' when y.file is null then 'missing' else 'corrupt' end")
    changed = at_x.alias("x").join(at_y.alias("y"), place, "full").select(
        *(F.coalesce(f"x.{c}", f"y.{c}").alias(c) for c in columns),
        F.col("y.digest").alias("found"),
        status.alias("status"),
    )
    return changed.unionByName(moved)


def fixity(records: DataFrame, replica: DataFrame, ranges: tuple[int, ...] = RANGES) -> DataFrame:
    """Rows (file, id, offset, length, digest, status): every record of both, ``intact`` where the audit finds nothing.

    ``records`` and ``replica`` have (file, id, offset, length, digest), as ``leaves`` gives them.
    """
    one, other = tree(saved(records, "leaves"), ranges), tree(saved(replica, "leaves"), ranges)
    found = saved(audit(one, other, ranges), "audit")
    key = F.expr("x.file = y.file and x.offset = y.offset")
    known = one.leaves.alias("x").join(found.where("status <> 'extra'").alias("y"), key, "left")
    columns = ["file", "id", "offset", "length", "digest"]
    rows = known.select(*(f"x.{c}" for c in columns), F.coalesce("y.status", F.lit("intact")).alias("status"))
    return rows.unionByName(found.where("status = 'extra'").select(*columns, "status"))


# The bytes of archives.

_MAGIC = b"WARC/1.1\r\n"
_HEAD = re.compile(rb"WARC/1\.1\r\n((?:[^\r\n]+\r\n)*+)\r\n")
_LENGTH = re.compile(rb"^Content-Length:[ \t]*(\d+)[ \t]*\r$", re.IGNORECASE | re.MULTILINE)
_ID = re.compile(rb"^WARC-Record-ID:[ \t]*<urn:page:(-?\d+)>[ \t]*\r$", re.IGNORECASE | re.MULTILINE)


def records_in(data: bytes) -> Iterator[tuple[int, int, int | None, int]]:
    """(start, end, page, start of the content) of the records of an archive, without gaps.

    Bytes that are no whole record go up to where the next one begins; they have no page, and their end for content.
    """
    at = 0
    while at < len(data):
        head = _HEAD.match(data, at)
        length = head and _LENGTH.search(head[0])
        end = head.end() + int(length[1]) + 4 if length else 0
        if length and data[end - 4 : end] == b"\r\n\r\n":
            page = _ID.search(head[0])
            yield at, end, int(page[1]) if page else None, head.end()
        else:
            following = data.find(_MAGIC, at + 1)
            end = following if following >= 0 else len(data)
            yield at, end, None, end
        at = end


_GZIP = b"\x1f\x8b"


def unpacked(stored: bytes) -> bytes:
    """An archive's bytes, whether stored as they are or in gzip members; of damaged members what comes before the damage."""
    if stored[:2] != _GZIP:
        return stored
    parts = []
    while stored[:2] == _GZIP:
        member = zlib.decompressobj(31)
        try:
            for start in range(0, len(stored), 1 << 16):
                parts.append(member.decompress(stored[start : start + (1 << 16)]))
                if member.eof:
                    stored = member.unused_data + stored[start + (1 << 16) :]
                    break
            else:
                break
        except zlib.error:
            break
    return b"".join(parts)


def read_archives(spark: SparkSession, path: str) -> DataFrame:
    """Rows (file, content): the bytes of the archives that ``write_archives`` has written, as they are stored."""
    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.txt*").load(path)
    name = F.regexp_extract("path", "/file=([0-9]+)/[^/]*$", 1).try_cast("bigint")
    return files.select(name.alias("file"), "content").where("file IS NOT NULL")


_LEAF = "file bigint, id bigint, offset bigint, length bigint, digest string"


def read_leaves(archives: DataFrame, stored: Callable[[bytes], bytes] | None = None) -> DataFrame:
    """Rows (file, id, offset, length, digest) from the bytes of rows (file, content), plain or in gzip members.

    Offsets are those in the unpacked archive. ``stored`` gives the bytes that a replica has instead of these, for trying
    out what storage may do.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kinds = (*(pa.int64() for _ in range(4)), pa.string())
        out = pa.schema(list(zip(("file", "id", "offset", "length", "digest"), kinds, strict=True)))

        def rows(batch: pa.RecordBatch) -> Iterator[tuple]:
            for name, content in zip(batch["file"], batch["content"], strict=True):
                data = unpacked(content.as_py())
                data = stored(data) if stored else data
                view = memoryview(data)
                for start, end, page, _ in records_in(data):
                    yield name.as_py(), page, start, end - start, hashlib.sha256(view[start:end]).hexdigest()

        for batch in batches:
            yield from in_parts(rows(batch), out)

    return archives.mapInArrow(run, _LEAF)


def damage(data: bytes) -> bytes:
    """An archive as bad storage may keep it, by a rule on the hash of each record.

    Of 256 records one has a wrong byte in its content, one a wrong length in its header, one is lost, and after one
    another was slipped in. The last thirty-second of the archive is cut off.
    """
    parts = []
    for start, end, _, content in records_in(data):
        record = data[start:end]
        mark = hashlib.md5(record).hexdigest()
        kind, size = mark[:2], end - 4 - content
        if kind == "00":
            at = content - start + int(mark[8:12], 16) % size if size else len(_MAGIC)
            record = record[:at] + (b"\x01" if record[at] == 0 else b"\x00") + record[at + 1 :]
        elif kind == "01":
            record = record.replace(b"Content-Length: ", b"Content-Length: 9", 1)
        elif kind == "02":
            record = b""
        parts.append(record)
        if kind == "03":
            parts.append(record.replace(b"<urn:page:", b"<urn:page:-9", 1))
    whole = b"".join(parts)
    return whole[: len(whole) - len(whole) // 32]


_SQL_RECORD = (
    "'WARC/1.1' || chr(13) || chr(10) || 'WARC-Type: resource' || chr(13) || chr(10) || 'WARC-Record-ID: <urn:page:' || page_id"
    " || '>' || chr(13) || chr(10) || 'WARC-Target-URI: ' || url || chr(13) || chr(10)"
    f" || 'WARC-Date: {DATE}' || chr(13) || chr(10) || 'Content-Type: text/html' || chr(13) || chr(10) || 'Content-Length: '"
    " || strlen(html) || chr(13) || chr(10) || chr(13) || chr(10) || html || chr(13) || chr(10) || chr(13) || chr(10)"
)
ORACLE_SQL = f"""
    WITH records AS (SELECT page_id, strlen(html) AS size, {_SQL_RECORD} AS record FROM pages),
    placed AS (
        SELECT page_id, size, record, md5(record) AS mark, ('0x' || md5(record)[1:8])::BIGINT % files AS file
        FROM records, (SELECT greatest(1, ceil(sum(strlen(record)) / {ARCHIVE}.0))::BIGINT AS files FROM records)
    ),
    one AS (
        SELECT file, page_id, strlen(record) AS length, sha256(record) AS digest,
               (sum(strlen(record)) OVER (PARTITION BY file ORDER BY page_id ROWS UNBOUNDED PRECEDING) - strlen(record))::BIGINT AS start
        FROM placed
    ),
    flipped AS (
        SELECT *, strlen(record) - 4 - size + ('0x' || mark[9:12])::BIGINT % greatest(size, 1) AS body_place FROM placed
    ),
    kept AS (
        SELECT file, page_id, 0 AS part, CASE WHEN mark[1:2] <> '01' THEN page_id END AS id,
               CASE mark[1:2]
               WHEN '00' THEN array_slice(encode(record), 1, CASE WHEN size > 0 THEN body_place ELSE 10 END) || '\\x00'::BLOB
                              || array_slice(encode(record), CASE WHEN size > 0 THEN body_place ELSE 10 END + 2, strlen(record))
               WHEN '01' THEN encode(regexp_replace(record, 'Content-Length: ', 'Content-Length: 9'))
               ELSE encode(record) END AS bytes
        FROM flipped WHERE mark[1:2] <> '02'
        UNION ALL
        SELECT file, page_id, 1, ('-9' || page_id)::BIGINT, encode(regexp_replace(record, '<urn:page:', '<urn:page:-9'))
        FROM placed WHERE mark[1:2] = '03'
    ),
    laid AS (
        SELECT *, octet_length(bytes) AS length,
               (sum(octet_length(bytes)) OVER (PARTITION BY file ORDER BY page_id, part ROWS UNBOUNDED PRECEDING)
                - octet_length(bytes))::BIGINT AS start,
               sum(octet_length(bytes)) OVER (PARTITION BY file)::BIGINT AS total
        FROM kept
    ),
    other AS (
        SELECT file, start, least(length, total - total // 32 - start) AS length,
               CASE WHEN start + length <= total - total // 32 THEN id END AS id,
               sha256(array_slice(bytes, 1, least(length, total - total // 32 - start))) AS digest
        FROM laid WHERE start < total - total // 32
    ),
    found AS (
        SELECT one.*, other.start AS there FROM one LEFT JOIN other
        ON one.file = other.file AND one.page_id = other.id AND one.digest = other.digest
    ),
    left_over AS (
        SELECT * FROM other WHERE NOT EXISTS (
            SELECT 1 FROM one WHERE one.file = other.file AND one.page_id = other.id AND one.digest = other.digest)
    )
    SELECT page_id, file, start AS "offset", length, digest, CASE WHEN start = there THEN 'intact' ELSE 'moved' END AS status
    FROM found WHERE there IS NOT NULL
    UNION ALL
    SELECT coalesce(x.page_id, CASE WHEN x.file IS NULL THEN y.id END), coalesce(x.file, y.file), coalesce(x.start, y.start),
           coalesce(x.length, y.length), coalesce(x.digest, y.digest),
           CASE WHEN x.file IS NULL THEN 'extra' WHEN y.file IS NULL THEN 'missing' ELSE 'corrupt' END
    FROM (SELECT * FROM found WHERE there IS NULL) x FULL JOIN left_over y ON x.file = y.file AND x.start = y.start
"""
