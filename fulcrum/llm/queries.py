"""The operators' registered queries: ``(spark, sf_dir) -> DataFrame`` over whole tables."""

from __future__ import annotations

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fulcrum.llm import collocations, learned_partitions, licenses, mixing, near_duplicates, quality_mil, quality_rules, secrets, sentencepieces, token_files, url_filter, warc, whitening
from fulcrum.llm.scratch import Scratch


def _table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def op1_learned_partitions(spark: SparkSession, sf_dir: str) -> DataFrame:
    vectors = learned_partitions.vectors_of(_table(spark, sf_dir, "embeddings"))
    return learned_partitions.search(vectors, vectors.where(F.col("id") % 20 == 0), Scratch(spark), k=20)


def op2_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    ledger = quality_rules.rule_ledger(_table(spark, sf_dir, "documents"))
    return ledger.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words",
        (~quality_rules.passes("base")).alias("base_failed"),
        quality_rules.passes().alias("kept"),
        "failed_bits",
    )


def quality_ablations(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What every policy rejects with and without each of its rules, from the stored ledger."""
    stored = Scratch(spark).write(quality_rules.rule_ledger(_table(spark, sf_dir, "documents")), "ledger")
    return quality_rules.ablations(stored)


def _count_of(kind: str):
    return lambda acc, k: acc + F.when(k == kind, 1).otherwise(0)


def op3_secrets(spark: SparkSession, sf_dir: str) -> DataFrame:
    found = secrets.scan(_table(spark, sf_dir, "documents"), Scratch(spark))
    kinds = [r.kind for r in secrets.BASE_RULES]
    base = F.filter("spans", lambda s: s["nr"] < len(kinds))
    each = F.transform("spans", lambda s: s["kind"])
    counts = [F.aggregate(each, F.lit(0), _count_of(kind)).cast("long").alias(f"n_{kind}") for kind in kinds]
    return found.select(
        "doc_id", *counts, F.sha2(secrets.span_string(base), 256).alias("base_sha256"),
        secrets.span_string(F.col("spans")).alias("spans"))


def op4_token_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    scratch = Scratch(spark)
    manifest, dictionary = token_files.token_files(
        _table(spark, sf_dir, "documents"), scratch.path("tokens"), scratch,
        tokenizer=public_tokenizers.path("word_bpe_49k.json"), end_id=2)
    return token_files.read_shards(manifest, dictionary)


def op5_near_duplicates(spark: SparkSession, sf_dir: str) -> DataFrame:
    return near_duplicates.near_duplicates(_table(spark, sf_dir, "documents"), Scratch(spark))


def op6_url_filter(spark: SparkSession, sf_dir: str) -> DataFrame:
    judged = url_filter.filter_urls(_table(spark, sf_dir, "pages"), Scratch(spark))
    return judged.select("page_id", "host", "path", "rule", "verdict")


def op7_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages, scratch = _table(spark, sf_dir, "pages"), Scratch(spark)
    archives = warc.write_archives(
        warc.deduplicated(pages, scratch, min_bytes=0), scratch.path("archives"), scratch, warc.train_dictionary(pages))
    return warc.read_archives(archives)


def op8_quality_mil(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs, labels = _table(spark, sf_dir, "documents"), _table(spark, sf_dir, "labels")
    held_out = F.crc32(F.col("doc_id").cast("string").cast("binary")) % 3 == 1
    net = quality_mil.train(docs, labels.where(~held_out).select("doc_id", "quality"))
    return quality_mil.score(docs, net).select(
        "doc_id", F.coalesce(held_out, F.lit(False)).alias("held_out"), "score",
        F.when(F.col("score") >= 0.5, 1).otherwise(0).alias("predicted"))


def op9_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    mixed = mixing.systematic_mix(_table(spark, sf_dir, "documents"), Scratch(spark))
    return mixed.select(
        "doc_id", "size", "source_size", "target",
        (F.col("size") * F.col("copies")).alias("taken"),
        "copies",
    )


def op10_sentencepieces(spark: SparkSession, sf_dir: str) -> DataFrame:
    coded = sentencepieces.encode_checked(
        _table(spark, sf_dir, "documents"), public_tokenizers.path("piece_bpe_32k.model"))
    return coded.select("doc_id", "n_pieces", "ids_crc32", "round_trip")


def op11_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.report(licenses.scan(_table(spark, sf_dir, "documents")))


def op12_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows, dim = whitening.usable(_table(spark, sf_dir, "embeddings"))
    return whitening.whiten(rows, dim, whitening.fit(rows, dim, Scratch(spark)))


def op13_collocations(spark: SparkSession, sf_dir: str) -> DataFrame:
    return collocations.collocations(_table(spark, sf_dir, "documents"), Scratch(spark))


QUERIES = {
    "op1_learned_partitions": op1_learned_partitions,
    "op2_quality_rules": op2_quality_rules,
    "op3_secrets": op3_secrets,
    "op4_token_files": op4_token_files,
    "op5_near_duplicates": op5_near_duplicates,
    "op6_url_filter": op6_url_filter,
    "op7_warc": op7_warc,
    "op8_quality_mil": op8_quality_mil,
    "op9_mixing": op9_mixing,
    "op10_sentencepieces": op10_sentencepieces,
    "op11_licenses": op11_licenses,
    "op12_whitening": op12_whitening,
    "op13_collocations": op13_collocations,
    "quality_ablations": quality_ablations,
}
