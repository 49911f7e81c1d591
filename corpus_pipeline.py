"""From raw documents to packed training sequences.

Every stage reads what the one before has kept, and all but the last return the columns of ``documents``. Copies
are dropped before similar documents are looked for, and secrets are taken out last, so that a replaced secret makes
no two documents alike.

A null text counts as an empty one. Empty texts are exact copies of each other, so one of them stays; texts without words are
similar to nothing. Rows that agree in id and text are copies; of equal texts of different ids the longest stays, then the
one with the smallest id, a null id last. Null ids are ids like any other. An empty table gives empty stages and no
sequences. Every stage reads texts whole, however long, and keeps further columns, whatever their names.
"""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from tidemark.llm.common import saved, table
from tidemark.llm.exact_dedup import drop_exact_copies
from tidemark.llm.importance import keep_selected
from tidemark.llm.jaccard_join import drop_similar
from tidemark.llm.packing import pack_documents
from tidemark.llm.secrets import redact

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents unlike the ones labelled as good go."""
    return keep_selected(docs, table(spark, sf_dir, "labels"))


def exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of texts equal but for white space, the longest stays."""
    return drop_exact_copies(docs)


def similar_documents(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of documents linked by a similarity of 0.8 on five-word shingles, the one with the smallest id stays."""
    return drop_similar(docs, percent=80, n_words=5)


def secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every secret is replaced by a mark; ``n_chars`` follows the text."""
    return redact(docs, length_col="n_chars")


def packing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The documents' pieces with their places in sequences of 2048 tokens."""
    packed = pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
    return packed.withColumnRenamed("id", "doc_id")


STAGES: list[tuple[str, Stage]] = [
    ("quality classifier", quality),
    ("exact dedup", exact_copies),
    ("n-gram Jaccard join", similar_documents),
    ("secret scans", secrets),
    ("best-fit packing", packing),
]

#: Packing needs a tokenizer, which SQL does not have.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    for k, (_, stage) in enumerate(STAGES):
        docs = stage(spark, docs, sf_dir)
        if k < len(STAGES) - 1:
            docs = saved(docs, "stage")
    return docs
