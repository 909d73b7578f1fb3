"""The corpus pipeline: STAGES over `documents`, each written as Parquet and read again by the next.

Every stage takes (spark, docs, sf_dir), works on all rows it is given and returns the columns of `documents`; the last
returns token ids. Their operators are in ``churnkit.llm`` and hold the rules for nulls, empty and long
texts, ties, repeated rows and empty tables.
"""

from __future__ import annotations

import uuid
from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from churnkit.llm.common import table
from churnkit.llm.mixing import mix_documents
from churnkit.llm.pieces import Model, encode
from churnkit.llm.quality import keep_good
from churnkit.llm.queries import piece_model_path
from churnkit.llm.secret_scan import redact_secrets
from churnkit.llm.simhash import keep_one
from churnkit.session import scratch_tables, stage_path

Stage = Callable[[SparkSession, DataFrame, str], DataFrame]


def quality_classifier(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the scorer rejects go."""
    return keep_good(docs)


def simhash_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate group stays, the one with the smallest doc_id."""
    return keep_one(docs)


def secret_scan(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Secrets are masked in the text; no document goes."""
    masked = redact_secrets(docs)
    return masked.withColumn("n_chars", F.length("text").cast("long")) if "n_chars" in docs.columns else masked


def source_mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Each document as often as the mix takes it."""
    return mix_documents(docs)


def sentencepiece(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """(doc_id, source, ids, n_tokens) of every document of the mix."""
    return encode(docs, Model.load(piece_model_path()), ["doc_id", "source"]).select("doc_id", "source", "ids", "n_tokens")


STAGES: list[tuple[str, Stage]] = [
    ("quality_classifier", quality_classifier),
    ("simhash_dedup", simhash_dedup),
    ("secret_scan", secret_scan),
    ("source_mix", source_mix),
    ("sentencepiece", sentencepiece),
]

# A trained model, XXH64 and merges of a vocabulary have no SQL form: tests hold run() against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    folder = stage_path(spark, f"pipeline-{uuid.uuid4().hex}")
    for name, stage in STAGES[:-1]:
        with scratch_tables(spark):                    # a stage's own tables go when its result is written
            stage(spark, docs, sf_dir).write.parquet(f"{folder}/{name}")
        docs = spark.read.parquet(f"{folder}/{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
