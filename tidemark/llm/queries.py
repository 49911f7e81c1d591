"""The operators' registered queries: each applies its operator to a whole table."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tidemark.llm import chat, divergence, embedding_dedup, secrets, vector_codes, warc
from tidemark.llm.common import saved, table
from tidemark.llm.exact_dedup import exact_groups
from tidemark.llm.importance import select
from tidemark.llm.jaccard_join import similar_groups
from tidemark.llm.packing import pack_documents
from tidemark.llm.pages import extract
from tidemark.llm.piece_codec import encode_documents
from tidemark.llm.suffix_dedup import remove_repeats
from tidemark.workspace import fresh_dir

Query = Callable[[SparkSession, str], DataFrame]


def op1_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.find(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_assign", "n_access", "n_hex", "base_sha256", "spans")


def op2_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = similar_groups(table(spark, sf_dir, "documents"))
    return found.select(F.col("id").alias("doc_id"), "n_shingles", "component_id")


def op3_warc_fixity(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All pages as archives in files, held against a replica whose bytes storage has damaged."""
    path = fresh_dir(spark, "archives")
    warc.write_archives(warc.archive(table(spark, sf_dir, "pages")), path)
    archives = warc.read_archives(spark, path)
    found = warc.fixity(warc.read_leaves(archives), warc.read_leaves(archives, warc.damage))
    return found.withColumnRenamed("id", "page_id")


def op4_suffix_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = remove_repeats(table(spark, sf_dir, "documents"))
    sha = F.sha2("kept", 256).alias("kept_sha256")
    return found.select(F.col("id").alias("doc_id"), "n_bytes", "n_removed", "n_spans", sha)


def op5_best_fit_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = pack_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("byte_bpe_50k.json"))
    return found.withColumnRenamed("id", "doc_id")


def op6_embedding_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = embedding_dedup.near_duplicates(table(spark, sf_dir, "embeddings"))
    kept = F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    return found.select(F.col("id").alias("vec_id"), "n_links", "component_id", kept)


def op7_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = extract(table(spark, sf_dir, "pages"))
    return found.select(F.col("id").alias("page_id"), "url", "text", F.length("text").cast("bigint").alias("n_chars"))


def op8_sentencepiece(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = encode_documents(table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return found.withColumnRenamed("id", "doc_id")


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_groups(table(spark, sf_dir, "documents")).select(
        F.col("id").alias("doc_id"), "keep_id", "group_size", "kept", F.col("sha").alias("text_sha256")
    )


OP9_SQL = r"""
    WITH bare AS (
        SELECT doc_id, length(coalesce(text, '')) AS n,
               regexp_replace(coalesce(text, ''), '[\x20\x09-\x0D]', '', 'g') AS bare
        FROM documents
    ), ranked AS (
        SELECT doc_id, bare, count(*) OVER (PARTITION BY bare) AS group_size,
               first_value(doc_id) OVER (PARTITION BY bare ORDER BY n DESC, doc_id NULLS LAST) AS keep_id,
               row_number() OVER (PARTITION BY bare ORDER BY n DESC, doc_id NULLS LAST) = 1 AS kept
        FROM bare
    )
    SELECT doc_id, keep_id, group_size, kept, sha256(bare) AS text_sha256 FROM ranked
"""

def op10_importance_resampling(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = select(table(spark, sf_dir, "documents"), table(spark, sf_dir, "labels"))
    return found.withColumnRenamed("id", "doc_id")


def op11_vector_codes(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = vector_codes.compress(table(spark, sf_dir, "embeddings"))
    return found.select(F.col("id").alias("vec_id"), "code", "error", "label_error", "codebooks_sha256")


def op12_source_divergence(spark: SparkSession, sf_dir: str) -> DataFrame:
    return divergence.audit(table(spark, sf_dir, "documents"))


def op13_chat_formatting(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All conversations and a hostile one, read back from their stored formatted texts."""
    columns = ["conv_id", "turn", "role", "text"]
    turns = table(spark, sf_dir, "conversations").select(*columns).unionByName(chat.hostile_rows(spark))
    return chat.read_back(saved(chat.format_turns(turns), "formatted"))


ENTRIES: dict[str, tuple[Query, str | None]] = {
    "op1_secret_scan": (op1_secret_scan, secrets.ORACLE_SQL),
    "op2_jaccard_join": (op2_jaccard_join, None),
    "op3_warc_fixity": (op3_warc_fixity, warc.ORACLE_SQL),
    "op4_suffix_dedup": (op4_suffix_dedup, None),
    "op5_best_fit_packing": (op5_best_fit_packing, None),
    "op6_embedding_dedup": (op6_embedding_dedup, embedding_dedup.ORACLE_SQL),
    "op7_html_extraction": (op7_html_extraction, None),
    "op8_sentencepiece": (op8_sentencepiece, None),
    "op9_exact_dedup": (op9_exact_dedup, OP9_SQL),
    "op10_importance_resampling": (op10_importance_resampling, None),
    "op11_vector_codes": (op11_vector_codes, vector_codes.ORACLE_SQL),
    "op12_source_divergence": (op12_source_divergence, divergence.ORACLE_SQL),
    "op13_chat_formatting": (op13_chat_formatting, chat.ORACLE_SQL),
}
