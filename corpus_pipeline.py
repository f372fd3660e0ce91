"""Training-data pipeline over ``documents``: filter, dedup, clean and pack.

Each stage is (name, function); a function takes (spark, docs, sf_dir) and
returns a DataFrame, which is written as Parquet and reread as the next one's
``docs``.  All stages but the last return the columns of ``documents``.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from quire.llm import exactdedup, neardedup, packing, qualityrules, secretscan
from quire.sources.checkpoint import shared_path

END_ID = 2
CAPACITY = 1024


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that pass the base rules and the boosted trees; the others go.

    A null or empty text has fewer than 50 words and goes; a text of any length
    is judged whole; repeated rows stay or go together; further columns stay; an
    empty table, or one without labels, gives what the base rules keep.
    """
    labels = spark.read.parquet(f"{sf_dir}/labels.parquet")
    return qualityrules.passing(docs, qualityrules.fit(docs, labels))


def exact_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of equal texts the row with the smallest doc_id.

    A null text is equal to an empty one; a null doc_id stays only where its text
    has no other; of repeated rows one stays; further columns stay; an empty table
    stays empty.
    """
    return exactdedup.without_copies(docs)


def near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of each group of near copies the document with the smallest doc_id.

    Near copies share four fifths of their five-word shingles (the operator's
    default).  Null and empty texts are nobody's copies and stay, as do rows
    without a doc_id; texts of fewer than five words are compared whole; further
    columns stay; an empty table stays empty.
    """
    return neardedup.without_near_copies(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, with the secrets in their texts masked and ``n_chars`` set anew.

    Null and empty texts stay as they are; spans that overlap become one mask;
    repeated rows and further columns stay; an empty table stays empty.
    """
    return secretscan.without_secrets(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents with their places in sequences of 1024 tokens.

    A null or empty text is its end id; a longer one is cut; repeated rows are
    packed one by one; only doc_id stays of the columns; an empty table gives no
    pieces.
    """
    return packing.pack(docs, public_tokenizers.path("byte_bpe_50k.json"), END_ID, CAPACITY)


STAGES = [
    ("quality_rules", quality_rules),
    ("exact_dedup", exact_dedup),
    ("near_dedup", near_dedup),
    ("secret_scan", secret_scan),
    ("pack", pack),
]

#: Trees, MinHash and packing can't be said in SQL; tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; what each returns lies in the shared folder until the process ends."""
    base = shared_path(spark, "pipeline")
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        stage(spark, docs, sf_dir).write.parquet(f"{base}/{name}")
        docs = spark.read.parquet(f"{base}/{name}")
    return docs
