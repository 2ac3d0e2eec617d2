"""Filters and packs a corpus in stages; the rows of each stage are written and read by the next.

Every stage takes (spark, docs, sf_dir) and works on all rows that its predecessor kept. All but
the last return the columns of the documents.
"""

from __future__ import annotations

import os
import uuid

from pyspark.sql import DataFrame, SparkSession

from ledgermill.llm import decontaminate, near_copies, packing, secret_scan, toxicity
from ledgermill.llm.queries import tokenizer_path
from ledgermill.session import shared_folder


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the toxicity network does not reject; it learns from the labels of this table."""
    network = toxicity.fit(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    return toxicity.without_toxic(docs, network)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each group of near copies: five-word shingles, similarity 0.8 or more.

    SimHash fingerprints link texts first; their links are verified, and what they miss is found exactly.
    """
    return near_copies.without_near_copies(docs)


def drop_leaks(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark passage."""
    return decontaminate.without_leaks(docs, spark.read.parquet(f"{sf_dir}/benchmark.parquet"))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, their secrets replaced by the kind in brackets and their lengths counted anew."""
    return secret_scan.redact_documents(docs)


def pack(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of all documents that are left, packed into training sequences."""
    return packing.pack_documents(docs, tokenizer_path("word_bpe_49k.json"), end_id=1)


STAGES = [
    ("toxicity", drop_toxic),
    ("near_copies", drop_near_copies),
    ("decontamination", drop_leaks),
    ("secrets", redact_secrets),
    ("packing", pack),
]

# SQL cannot express the network, the fingerprints or the alignment; tests use brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The result of the last stage over the documents in ``sf_dir``."""
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    folder = os.path.join(shared_folder(spark), "tables", spark.sparkContext.applicationId, f"pipeline-{uuid.uuid4().hex}")
    for name, stage in STAGES[:-1]:
        path = os.path.join(folder, name)
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
    return STAGES[-1][1](spark, docs, sf_dir)
