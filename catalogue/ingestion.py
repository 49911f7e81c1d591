"""Sources, sinks, duplicate removal and repeatable ingestion."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from catalogue.common import EARLIER, LINES, ORDERS, ORDERS_SQL, Entries, lines, orders, table
from tidemark.functions import map_null_tokens
from tidemark.operators import append, column_info, dedupe, new_rows, overwrite
from tidemark.operators.clustering import append_clustered
from tidemark.plans import ingest, with_load_columns
from tidemark.plans.compact import FILE_BYTES, compact, directory_files, fragmented
from tidemark.plans.gold import month_of
from tidemark.sources import MALFORMED, read_csv, read_csv_loose, read_history, stream_csv
from tidemark.streaming import ingest_available
from tidemark.workspace import fresh_dir


def _stored(spark: SparkSession, uri: str) -> DataFrame:
    return read_history(spark, uri, ORDERS.schema).select(*_names(ORDERS.schema))


def _names(ddl: str) -> list[str]:
    return [column.split()[0] for column in ddl.split(", ")]


def _preloaded(spark: SparkSession, sf_dir: str, label: str) -> tuple[DataFrame, str]:
    """All orders, and a table that already holds the earlier ones."""
    every, uri = orders(spark, sf_dir), fresh_dir(spark, label)
    ingest(spark, every.where(EARLIER), ORDERS, uri)
    return every, uri


# --- sources -----------------------------------------------------------------------------------


def _orders_csv(spark: SparkSession, sf_dir: str) -> str:
    path = fresh_dir(spark, "orders_csv")
    table(spark, sf_dir, "orders").write.csv(path, header=True)
    return path


def csv_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = read_csv(spark, _orders_csv(spark, sf_dir), infer=True)
    wanted = table(spark, sf_dir, "orders")
    return found.select(*(F.col(c).cast(t).alias(c) for c, t in wanted.dtypes))


def csv_scan_declared(spark: SparkSession, sf_dir: str) -> DataFrame:
    return read_csv(spark, _orders_csv(spark, sf_dir), table(spark, sf_dir, "orders").schema)


def csv_null_tokens(spark: SparkSession, sf_dir: str) -> DataFrame:
    lang = F.when(F.col("lang") == "de", "NA").when(F.col("lang") == "fr", "null").otherwise(F.col("lang"))
    documents = table(spark, sf_dir, "documents")
    path = _foreign_csv(documents.withColumn("lang", lang), "documents_csv")
    found = map_null_tokens(read_csv(spark, path, documents.schema, multiLine=True), ["lang"])
    return found


def _foreign_csv(rows: DataFrame, label: str) -> str:
    """Written as other tools do: quotes doubled, blanks kept, empty texts quoted."""
    path = fresh_dir(rows.sparkSession, label)
    rows.write.options(
        header=True, escape='"', ignoreLeadingWhiteSpace=False, ignoreTrailingWhiteSpace=False
    ).csv(path)
    return path


def _events_csv(spark: SparkSession, sf_dir: str) -> str:
    value = F.when(F.col("event_type") == "error", "N/A").otherwise(F.col("value").cast("string"))
    return _foreign_csv(table(spark, sf_dir, "events").withColumn("value", value), "events_csv")


def csv_loose_types(spark: SparkSession, sf_dir: str) -> DataFrame:
    return column_info(read_csv_loose(spark, _events_csv(spark, sf_dir)))


def csv_loose_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All columns of two tables, with quotes inside values and line breaks inside texts."""
    events = read_csv_loose(spark, _events_csv(spark, sf_dir))
    texts = _foreign_csv(table(spark, sf_dir, "documents"), "documents_csv")
    documents = read_csv_loose(spark, texts, multiLine=True)
    return events.select(
        F.col("event_id").alias("id"), F.concat_ws("|", F.col("user_id").cast("string"), "event_type").alias("name"),
        "value", F.col("props").alias("text"),
    ).unionByName(
        documents.select(
            F.col("doc_id").alias("id"), F.concat_ws("|", "lang", "source").alias("name"),
            F.col("n_chars").cast("double").alias("value"), "text",
        )
    )


_SOUND, _WORD, _SURPLUS, _SHORT, _DAY = range(5)


def _damaged_orders_csv(spark: SparkSession, sf_dir: str) -> str:
    """Orders as lines of text, some of them damaged: a word for a price, a field too many, one too few, a wrong day."""
    every = table(spark, sf_dir, "orders")
    fault = F.pmod(F.col("o_orderkey"), F.lit(40))
    price = F.when(fault == _WORD, "much").otherwise(F.col("o_totalprice").cast("string"))
    day = F.when(fault == _DAY, "31/01/2025").otherwise(F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss"))
    fields = [
        F.col("o_orderkey").cast("string"), F.col("o_custkey").cast("string"), F.col("o_orderstatus"), price, day,
        F.when(fault != _SHORT, F.col("o_orderpriority")), F.when(fault == _SURPLUS, "surplus"),
    ]
    # Without quotes a line may have a field more or less than the header that Spark gives each file.
    line = F.concat_ws(",", *fields).alias(",".join(every.columns))
    path = fresh_dir(spark, "orders_lines")
    every.select(line).write.csv(path, header=True, quote="", sep="\x01", emptyValue="")
    return path


def csv_malformed_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = read_csv(
        spark, _damaged_orders_csv(spark, sf_dir), table(spark, sf_dir, "orders").schema, keep_malformed=True
    )
    sound = F.col(MALFORMED).isNull()
    return found.select(
        F.split_part(F.coalesce(MALFORMED, F.col("o_orderkey").cast("string")), F.lit(","), F.lit(1))
        .cast("bigint")
        .alias("o_orderkey"),
        sound.alias("sound"),
        F.when(sound, F.col("o_totalprice")).alias("o_totalprice"),
        F.when(sound, F.col("o_orderdate")).alias("o_orderdate"),
        F.when(sound, F.col("o_orderpriority")).alias("o_orderpriority"),
    )


def ingest_malformed_rejected(spark: SparkSession, sf_dir: str) -> DataFrame:
    batch = read_csv(
        spark, _damaged_orders_csv(spark, sf_dir), table(spark, sf_dir, "orders").schema, keep_malformed=True
    )
    uri, rejects = fresh_dir(spark, "orders"), fresh_dir(spark, "orders_rejected")
    for _ in range(2):
        result = ingest(spark, batch.withColumn("month", month_of("o_orderdate")), ORDERS, uri, rejects_uri=rejects)
    lines = spark.read.parquet(rejects).select(F.col(MALFORMED).alias("line"))
    stored = _stored(spark, uri).select("o_orderkey", "o_totalprice", "month", F.lit(None).cast("string").alias("line"))
    key = F.split_part("line", F.lit(","), F.lit(1)).cast("bigint").alias("o_orderkey")
    none = (F.lit(None).cast("double").alias("o_totalprice"), F.lit(None).cast("string").alias("month"))
    return stored.unionByName(lines.select(key, *none, "line")).withColumn("rejected", F.lit(result.rejected))


def ingest_empty_partition_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Loaded three times: nothing is added, whether or not a partition column is stable or part of the key."""
    month = F.when(F.col("o_orderstatus") == "P", "").otherwise(F.col("month"))
    batch = orders(spark, sf_dir).withColumn("month", month)
    ways = {
        "plain": ORDERS,
        "stable": replace(ORDERS, stable=("month",)),
        "in key": replace(ORDERS, key=("o_orderkey", "month")),
    }
    found = []
    for way, spec in ways.items():
        uri = fresh_dir(spark, "orders")
        results = [ingest(spark, batch, spec, uri, rejects_uri=fresh_dir(spark, "rejected")) for _ in range(3)]
        added = F.lit(sum(r.appended for r in results)).cast("bigint")
        rejected = F.lit(results[-1].rejected).cast("bigint")
        counts = _stored(spark, uri).groupBy("month").agg(F.count(F.lit(1)).alias("rows"))
        totals = (added.alias("added"), rejected.alias("rejected"))
        found.append(counts.select(F.lit(way).alias("way"), "month", "rows", *totals))
    return found[0].unionByName(found[1]).unionByName(found[2])


def parquet_history_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = fresh_dir(spark, "orders")
    append(orders(spark, sf_dir), uri, ["month"])
    return _stored(spark, uri).where("month >= '2000-01'")


def inline_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = spark.createDataFrame(
        [("O", "open"), ("F", "finished"), ("P", "pending")], ["o_orderstatus", "label"]
    )
    counted = table(spark, sf_dir, "orders").groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("orders"))
    return counted.join(labels, "o_orderstatus").select("label", "orders")


# --- duplicates and stored keys ----------------------------------------------------------------


def dedupe_by_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe(table(spark, sf_dir, "events"), ["user_id"], [F.desc("ts"), F.desc("event_id")])


def dedupe_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    return dedupe(
        table(spark, sf_dir, "lineitem"),
        ["l_orderkey", "l_linenumber"],
        [F.desc("l_shipdate"), F.asc("l_partkey"), F.asc("l_suppkey")],
    )


def anti_join_new_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return new_rows(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"), ["doc_id"])


# --- ingestion ---------------------------------------------------------------------------------


def ingest_first_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    every, uri = orders(spark, sf_dir), fresh_dir(spark, "orders")
    ingest(spark, every.unionByName(every), ORDERS, uri)
    return _stored(spark, uri)


def ingest_incremental(spark: SparkSession, sf_dir: str) -> DataFrame:
    every, uri = _preloaded(spark, sf_dir, "orders")
    ingest(spark, every.unionByName(every), ORDERS, uri)
    return (
        _stored(spark, uri)
        .groupBy("o_orderstatus")
        .agg(
            F.count(F.lit(1)).alias("orders"),
            F.sum(F.col("o_totalprice").cast("decimal(12,2)")).cast("double").alias("total"),
        )
    )


def ingest_large_batch(spark: SparkSession, sf_dir: str) -> DataFrame:
    """As ``ingest_incremental``, taking the way for batches whose keys are too many to broadcast or for a bitmap."""
    every, uri = _preloaded(spark, sf_dir, "orders")
    ingest(spark, every.unionByName(every), ORDERS, uri, broadcast_key_bytes=0, bitmap_bits=0)
    return _stored(spark, uri)


def ingest_bitmap_reduced(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Hashed ids, which ranges do not tell apart: a bitmap of the batch's keys thins out the history."""
    hashed = replace(ORDERS, schema=ORDERS.schema.replace("o_orderkey bigint", "o_orderkey string"))
    every = orders(spark, sf_dir).withColumn("o_orderkey", F.sha2(F.col("o_orderkey").cast("string"), 256))
    uri = fresh_dir(spark, "orders")
    ingest(spark, every.where(EARLIER), hashed, uri)
    batch = every.where("month >= '1997-07'")
    ingest(spark, batch.unionByName(batch), hashed, uri, broadcast_key_bytes=0)
    return read_history(spark, uri, hashed.schema).select(*_names(hashed.schema))


def ingest_stable_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """An order never changes its month, so only the batch's months of the history are read."""
    every, uri = _preloaded(spark, sf_dir, "orders")
    ingest(spark, every.where("month >= '1997-06'"), replace(ORDERS, stable=("month",)), uri)
    return _stored(spark, uri)


def ingest_composite_key(spark: SparkSession, sf_dir: str) -> DataFrame:
    every, uri = lines(spark, sf_dir), fresh_dir(spark, "lineitem")
    ingest(spark, every.where("l_returnflag = 'R'"), LINES, uri)
    ingest(spark, every, LINES, uri)
    return read_history(spark, uri, LINES.schema).select(*_names(LINES.schema))


def ingest_idempotent_rerun(spark: SparkSession, sf_dir: str) -> DataFrame:
    every, uri = _preloaded(spark, sf_dir, "orders")
    for _ in range(2):
        ingest(spark, every.unionByName(every), ORDERS, uri)
    return _stored(spark, uri)


def ingest_changed_row_ignored(spark: SparkSession, sf_dir: str) -> DataFrame:
    every, uri = orders(spark, sf_dir), fresh_dir(spark, "orders")
    ingest(spark, every, ORDERS, uri)
    ingest(spark, every.withColumn("o_totalprice", F.col("o_totalprice") + 1), ORDERS, uri)
    return _stored(spark, uri)


def ingest_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    every, uri = _preloaded(spark, sf_dir, "orders")
    result = ingest(spark, every.unionByName(every), ORDERS, uri)
    return spark.createDataFrame(
        [(result.read, result.rejected, result.appended)], "read bigint, rejected bigint, appended bigint"
    )


def ingest_null_keys(spark: SparkSession, sf_dir: str) -> DataFrame:
    key = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey"))
    batch = orders(spark, sf_dir).withColumn("o_orderkey", key)
    uri, rejects = fresh_dir(spark, "orders"), fresh_dir(spark, "orders_rejected")
    for _ in range(2):
        ingest(spark, batch, ORDERS, uri, rejects_uri=rejects)
    places = {"stored": _stored(spark, uri), "rejected": read_history(spark, rejects, ORDERS.schema)}
    parts = [rows.select(F.lit(place).alias("place"), "o_orderpriority") for place, rows in places.items()]
    return parts[0].unionByName(parts[1]).groupBy("place", "o_orderpriority").agg(F.count(F.lit(1)).alias("rows"))


def ingest_daily_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    every = table(spark, sf_dir, "orders")
    inbox, uri, progress = (fresh_dir(spark, label) for label in ("inbox", "orders", "progress"))

    def run(checkpoint: str) -> None:
        files = stream_csv(spark, inbox, every.schema)
        ingest_available(files.withColumn("month", month_of("o_orderdate")), ORDERS, uri, checkpoint)

    for arrival in (every.where(EARLIER), every.where(f"NOT ({EARLIER})")):
        arrival.write.mode("append").csv(inbox, header=True)
        run(progress)
    run(fresh_dir(spark, "progress"))
    return _stored(spark, uri)


def daily_load_history(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One load by command, then two days of files, all with their load history in one table."""
    every, spec = table(spark, sf_dir, "orders"), ORDERS.with_load_columns()
    inbox, uri, progress = (fresh_dir(spark, label) for label in ("inbox", "orders", "progress"))
    first = every.where("o_orderstatus = 'P'").withColumn("month", month_of("o_orderdate"))
    ingest(spark, with_load_columns(first, "start", from_files=False), spec, uri)
    for day, status in (("monday", "F"), ("tuesday", "O")):
        every.where(f"o_orderstatus IN ('P', '{status}')").write.mode("append").csv(inbox, header=True)
        files = stream_csv(spark, inbox, every.schema).withColumn("month", month_of("o_orderdate"))
        ingest_available(files, spec, uri, progress, batch_id=day)
    return (
        read_history(spark, uri, spec.schema)
        .groupBy("_batch_id", "o_orderstatus")
        .agg(
            F.count(F.lit(1)).alias("rows"),
            F.count_if(F.col("_source_file").like("%.csv")).alias("with_file"),
            F.count("_ingested_at").alias("with_time"),
        )
    )


def daily_rejects(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rejected rows of every run, also after a run with a new checkpoint."""
    every = table(spark, sf_dir, "orders")
    key = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey"))
    inbox, uri, rejects = (fresh_dir(spark, label) for label in ("inbox", "orders", "rejected"))
    for status in ("P", "F"):
        every.where(F.col("o_orderstatus") == status).withColumn("o_orderkey", key).write.mode("append").csv(
            inbox, header=True
        )
        files = stream_csv(spark, inbox, every.schema).withColumn("month", month_of("o_orderdate"))
        ingest_available(files, ORDERS, uri, fresh_dir(spark, "progress"), rejects_uri=rejects)
    found = spark.read.parquet(rejects)
    return found.groupBy("o_orderstatus").agg(
        F.count(F.lit(1)).alias("rows"), F.count_distinct("run").alias("runs")
    )


def daily_watermarked(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Two days of files, then both days' rows once more under other names: stored once and rejected once."""
    every = table(spark, sf_dir, "orders")
    key = F.when(F.col("o_orderpriority") != "5-LOW", F.col("o_orderkey"))
    inbox, uri, rejects, progress = (fresh_dir(spark, label) for label in ("inbox", "orders", "rejected", "progress"))
    for statuses in (["P"], ["F", "O"], ["P", "F", "O"]):
        arrived = every.where(F.col("o_orderstatus").isin(statuses)).withColumn("o_orderkey", key)
        arrived.write.mode("append").csv(inbox, header=True)
        files = stream_csv(spark, inbox, every.schema).withColumn("month", month_of("o_orderdate"))
        ingest_available(files, ORDERS, uri, progress, rejects_uri=rejects, repeats_within="7 days")
    stored = _stored(spark, uri).select("o_orderkey", "o_custkey", "o_orderdate", F.lit("stored").alias("place"))
    refused = spark.read.parquet(rejects).select("o_orderkey", "o_custkey", "o_orderdate", F.lit("rejected").alias("place"))
    return stored.unionByName(refused)


# --- sinks -------------------------------------------------------------------------------------


def partitioned_append(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = fresh_dir(spark, "orders")
    append(orders(spark, sf_dir), uri, ["month"], ["o_orderkey"])
    return _stored(spark, uri)


def partitioned_append_clustered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines, laid out for look-ups by order, by product and by day."""
    every, uri = table(spark, sf_dir, "lineitem"), fresh_dir(spark, "lineitem")
    append_clustered(every, uri, ["l_orderkey", "l_partkey", "l_shipdate"], ["l_returnflag"])
    return spark.read.schema(every.schema).parquet(uri).select(every.columns)


def partition_inventory(spark: SparkSession, sf_dir: str) -> DataFrame:
    uri = fresh_dir(spark, "orders")
    append(orders(spark, sf_dir), uri, ["month", "o_orderstatus"])
    return _stored(spark, uri).groupBy("month", "o_orderstatus").agg(F.count(F.lit(1)).alias("rows"))


def partition_compacted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Six loads leave six files in a directory; compaction leaves the same rows in few."""
    spec = replace(ORDERS, partition_by=("month", "o_orderstatus"))
    every, uri = orders(spark, sf_dir), fresh_dir(spark, "orders")
    for part in range(6):
        append(every.where(F.pmod("o_orderkey", F.lit(6)) == part), uri, spec.partition_by, spec.key)
    compact(spark, uri, spec)
    files = directory_files(read_history(spark, uri, spec.schema), spec.partition_by)
    many = fragmented(files, FILE_BYTES).count()
    return _stored(spark, uri).withColumn("fragmented", F.lit(many).cast("bigint"))


def overwrite_static(spark: SparkSession, sf_dir: str) -> DataFrame:
    every, uri = orders(spark, sf_dir), fresh_dir(spark, "orders")
    overwrite(every, uri, ["o_orderstatus"])
    overwrite(every.where("o_orderstatus = 'P'"), uri, ["o_orderstatus"])
    return _stored(spark, uri)


def overwrite_dynamic(spark: SparkSession, sf_dir: str) -> DataFrame:
    every, uri = orders(spark, sf_dir), fresh_dir(spark, "orders")
    overwrite(every, uri, ["o_orderstatus"])
    cheap = every.where("o_orderstatus = 'P' AND o_totalprice < 100000")
    overwrite(cheap, uri, ["o_orderstatus"], only_written_partitions=True)
    return _stored(spark, uri).groupBy("o_orderstatus").agg(F.count(F.lit(1)).alias("rows"))


_FIRST_LINE = """
    SELECT *, row_number() OVER (PARTITION BY l_orderkey, l_linenumber ORDER BY {order}) AS rn FROM {rows}
"""
_LINE_ORDER = "l_shipdate DESC, l_partkey, l_suppkey, l_quantity, l_extendedprice, l_discount, l_tax"

ENTRIES: Entries = {
    "csv_scan": (csv_scan, "SELECT * FROM orders"),
    "csv_scan_declared": (csv_scan_declared, "SELECT * FROM orders"),
    "csv_null_tokens": (
        csv_null_tokens,
        "SELECT * REPLACE (CASE WHEN lang NOT IN ('de', 'fr') THEN lang END AS lang) FROM documents",
    ),
    "csv_loose_values": (
        csv_loose_values,
        """
        SELECT event_id AS id, user_id || '|' || event_type AS name,
               CASE WHEN event_type <> 'error' THEN value END AS value, props AS text FROM events
        UNION ALL SELECT doc_id, lang || '|' || source, n_chars::DOUBLE, text FROM documents
        """,
    ),
    "csv_malformed_rows": (
        csv_malformed_rows,
        """
        SELECT o_orderkey, sound, CASE WHEN sound THEN o_totalprice END AS o_totalprice,
               CASE WHEN sound THEN o_orderdate END AS o_orderdate,
               CASE WHEN sound THEN o_orderpriority END AS o_orderpriority
        FROM (SELECT *, o_orderkey % 40 NOT IN (1, 2, 3, 4) AS sound FROM orders)
        """,
    ),
    "ingest_malformed_rejected": (
        ingest_malformed_rejected,
        """
        WITH faults AS (SELECT *, o_orderkey % 40 AS fault FROM orders),
        lines AS (
          SELECT o_orderkey, concat_ws(',', o_orderkey, o_custkey, o_orderstatus,
                   CASE WHEN fault = 1 THEN 'much' ELSE o_totalprice::VARCHAR END,
                   CASE WHEN fault = 4 THEN '31/01/2025' ELSE strftime(o_orderdate, '%Y-%m-%dT%H:%M:%S') END,
                   CASE WHEN fault <> 3 THEN o_orderpriority END, CASE WHEN fault = 2 THEN 'surplus' END) AS line
          FROM faults WHERE fault IN (1, 2, 3, 4)),
        everything AS (
          SELECT o_orderkey, o_totalprice, strftime(o_orderdate, '%Y-%m') AS month, NULL AS line FROM faults
          WHERE fault NOT IN (1, 2, 3, 4)
          UNION ALL SELECT o_orderkey, NULL, NULL, line FROM lines)
        SELECT o_orderkey, o_totalprice, month, line, (SELECT count(*) FROM lines)::INT AS rejected FROM everything
        """,
    ),
    "ingest_empty_partition_value": (
        ingest_empty_partition_value,
        """
        WITH months AS (
          SELECT CASE WHEN o_orderstatus <> 'P' THEN strftime(o_orderdate, '%Y-%m') END AS month FROM orders),
        ways AS (SELECT unnest(['plain', 'stable', 'in key']) AS way)
        SELECT way, month, count(*) AS rows,
               (SELECT count(*) FROM months WHERE month IS NOT NULL OR way <> 'in key') AS added,
               (SELECT count(*) FROM months WHERE month IS NULL AND way = 'in key') AS rejected
        FROM months, ways WHERE month IS NOT NULL OR way <> 'in key' GROUP BY way, month
        """,
    ),
    "daily_load_history": (
        daily_load_history,
        """
        SELECT CASE o_orderstatus WHEN 'P' THEN 'start' WHEN 'F' THEN 'monday' ELSE 'tuesday' END AS _batch_id,
               o_orderstatus, count(*) AS rows, count(*) FILTER (WHERE o_orderstatus <> 'P') AS with_file,
               count(*) AS with_time
        FROM orders GROUP BY o_orderstatus
        """,
    ),
    "daily_watermarked": (
        daily_watermarked,
        """
        SELECT o_orderkey, o_custkey, o_orderdate, CASE WHEN o_orderpriority <> '5-LOW' THEN 'stored' ELSE 'rejected' END AS place
        FROM (SELECT DISTINCT * REPLACE (CASE WHEN o_orderpriority <> '5-LOW' THEN o_orderkey END AS o_orderkey) FROM orders)
        """,
    ),
    "daily_rejects": (
        daily_rejects,
        """
        SELECT o_orderstatus, CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 1 END * count(*) AS rows,
               CASE WHEN o_orderstatus = 'P' THEN 2 ELSE 1 END::BIGINT AS runs
        FROM orders WHERE o_orderpriority = '5-LOW' AND o_orderstatus IN ('P', 'F') GROUP BY o_orderstatus
        """,
    ),
    "csv_loose_types": (
        csv_loose_types,
        """
        SELECT 0::INT AS pos, 'event_id' AS "column", 'bigint' AS dtype, count(event_id) AS non_null FROM events
        UNION ALL SELECT 1, 'ts', 'string', count(ts) FROM events
        UNION ALL SELECT 2, 'user_id', 'bigint', count(user_id) FROM events
        UNION ALL SELECT 3, 'event_type', 'string', count(event_type) FROM events
        UNION ALL SELECT 4, 'value', 'double', count(*) FILTER (WHERE event_type <> 'error') FROM events
        UNION ALL SELECT 5, 'props', 'string', count(props) FROM events
        """,
    ),
    "parquet_history_scan": (
        parquet_history_scan,
        f"SELECT * FROM ({ORDERS_SQL}) WHERE o_orderdate >= TIMESTAMP '2000-01-01'",
    ),
    "inline_rows": (
        inline_rows,
        """
        SELECT label, count(*) AS orders
        FROM orders JOIN (VALUES ('O', 'open'), ('F', 'finished'), ('P', 'pending')) AS t(status, label)
          ON o_orderstatus = status
        GROUP BY label
        """,
    ),
    "dedupe_by_key": (
        dedupe_by_key,
        """
        SELECT event_id, ts, user_id, event_type, value, props FROM (
          SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY ts DESC, event_id DESC) AS rn FROM events)
        WHERE rn = 1
        """,
    ),
    "dedupe_composite_key": (
        dedupe_composite_key,
        f"SELECT * EXCLUDE (rn) FROM ({_FIRST_LINE.format(order=_LINE_ORDER, rows='lineitem')}) WHERE rn = 1",
    ),
    "anti_join_new_rows": (
        anti_join_new_rows,
        "SELECT * FROM documents d WHERE NOT EXISTS (SELECT 1 FROM labels l WHERE l.doc_id = d.doc_id)",
    ),
    "ingest_first_load": (ingest_first_load, ORDERS_SQL),
    "ingest_incremental": (
        ingest_incremental,
        """
        SELECT o_orderstatus, count(*) AS orders, sum(o_totalprice::DECIMAL(12,2))::DOUBLE AS total
        FROM orders GROUP BY o_orderstatus
        """,
    ),
    "ingest_large_batch": (ingest_large_batch, ORDERS_SQL),
    "ingest_bitmap_reduced": (
        ingest_bitmap_reduced,
        f"SELECT * REPLACE (sha256(o_orderkey::VARCHAR) AS o_orderkey) FROM ({ORDERS_SQL})",
    ),
    "ingest_stable_partitions": (ingest_stable_partitions, ORDERS_SQL),
    "ingest_composite_key": (
        ingest_composite_key,
        f"""
        WITH stored AS (
          SELECT * EXCLUDE (rn) FROM ({_FIRST_LINE.format(
              order=_LINE_ORDER, rows="(SELECT * FROM lineitem WHERE l_returnflag = 'R')")}) WHERE rn = 1),
        fresh AS (
          SELECT * EXCLUDE (rn) FROM ({_FIRST_LINE.format(order=_LINE_ORDER, rows="lineitem")}) WHERE rn = 1)
        SELECT *, strftime(l_shipdate, '%Y-%m') AS month FROM (
          SELECT * FROM stored UNION ALL
          SELECT * FROM fresh f WHERE NOT EXISTS (
            SELECT 1 FROM stored s WHERE s.l_orderkey = f.l_orderkey AND s.l_linenumber = f.l_linenumber))
        """,
    ),
    "ingest_idempotent_rerun": (ingest_idempotent_rerun, ORDERS_SQL),
    "ingest_changed_row_ignored": (ingest_changed_row_ignored, ORDERS_SQL),
    "ingest_metrics": (
        ingest_metrics,
        """
        SELECT 2 * count(*) AS read, 0::BIGINT AS rejected,
               count(*) FILTER (WHERE o_orderdate >= TIMESTAMP '1998-01-01') AS appended
        FROM orders
        """,
    ),
    "ingest_null_keys": (
        ingest_null_keys,
        """
        SELECT CASE WHEN o_orderpriority = '5-LOW' THEN 'rejected' ELSE 'stored' END AS place,
               o_orderpriority, count(*) AS rows
        FROM orders GROUP BY 1, 2
        """,
    ),
    "ingest_daily_files": (ingest_daily_files, ORDERS_SQL),
    "partitioned_append": (partitioned_append, ORDERS_SQL),
    "partitioned_append_clustered": (partitioned_append_clustered, "SELECT * FROM lineitem"),
    "partition_inventory": (
        partition_inventory,
        f"SELECT month, o_orderstatus, count(*) AS rows FROM ({ORDERS_SQL}) GROUP BY month, o_orderstatus",
    ),
    "partition_compacted": (partition_compacted, f"SELECT *, 0::BIGINT AS fragmented FROM ({ORDERS_SQL})"),
    "overwrite_static": (overwrite_static, f"SELECT * FROM ({ORDERS_SQL}) WHERE o_orderstatus = 'P'"),
    "overwrite_dynamic": (
        overwrite_dynamic,
        """
        SELECT o_orderstatus, count(*) AS rows FROM orders
        WHERE o_orderstatus <> 'P' OR o_totalprice < 100000 GROUP BY o_orderstatus
        """,
    ),
}
