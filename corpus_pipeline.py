"""The corpus pipeline: five stages over ``documents``, each written before the next reads it.

Every stage takes (spark, docs, sf_dir) and returns the columns of ``documents``, but for the
last, which returns doc_id and the piece ids.  A rejected or repeated document is gone for
the later stages; secrets are replaced in the text; the mix repeats documents.
"""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession

from fulcrum.llm import mixing, near_duplicates, quality_rules, secrets, sentencepieces
from fulcrum.llm.scratch import Scratch


def quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the current policy of the rule ledger keeps."""
    return quality_rules.reject(docs)


def near_duplicate(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """One document of each near-duplicate class: the one with the smallest doc_id."""
    return near_duplicates.keep_one(docs, Scratch(spark))


def redact_secrets(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Every document, secrets replaced by their kind in brackets."""
    return secrets.redact_documents(docs, Scratch(spark))


def mix(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents as often as the sources' targets take them."""
    return mixing.emit_copies(docs, Scratch(spark))


def encode(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """doc_id, n_pieces, piece_ids, and whether decoding gives the text back."""
    return sentencepieces.encode_checked(docs, public_tokenizers.path("piece_bpe_32k.model")).drop("ids_crc32")


STAGES = [
    ("quality rules", quality),
    ("near duplicates", near_duplicate),
    ("secret scan", redact_secrets),
    ("mixing", mix),
    ("piece encoding", encode),
]

#: Near duplicates and piece ids have no SQL; tests hold the stages against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result reads the last stage's written table."""
    scratch = Scratch(spark)
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    for nr, (name, stage) in enumerate(STAGES):
        done = scratch.write(stage(spark, docs, sf_dir), name.replace(" ", "-"))
        if nr:
            scratch.remove(docs)
        docs = done
    return docs
