"""Registered queries of the subpackage and their oracle SQL."""

from __future__ import annotations

from collections.abc import Callable

import public_tokenizers
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.llm import chat, exact_dedup, hard_negatives, licenses, minhash, mixing, packing, quality, spans, topk, toxicity, wavelet, whitening
from blotter.llm.common import table

Query = Callable[[SparkSession, str], DataFrame]


def op1_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    stats = quality.document_statistics(table(spark, sf_dir, "documents"))
    return quality.quality_scores(stats, quality.train(stats, table(spark, sf_dir, "labels")))


def op2_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(table(spark, sf_dir, "documents"))


def op3_chat(spark: SparkSession, sf_dir: str) -> DataFrame:
    return chat.chat_format(table(spark, sf_dir, "conversations"))


def op4_topk(spark: SparkSession, sf_dir: str) -> DataFrame:
    return topk.top_k(table(spark, sf_dir, "embeddings"), F.col("vec_id") % 50 == 0)


def op5_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return mixing.mix_plan(table(spark, sf_dir, "documents"))


def op6_licenses(spark: SparkSession, sf_dir: str) -> DataFrame:
    return licenses.license_scan(table(spark, sf_dir, "documents")).drop("spans")


def op7_spans(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return spans.span_dedup(docs).select("doc_id", "sentences_removed", "words_removed", "text")


def op8_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return toxicity.toxicity_scores(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def op9_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_groups(table(spark, sf_dir, "documents"))


def op10_minhash(spark: SparkSession, sf_dir: str) -> DataFrame:
    return minhash.near_groups(table(spark, sf_dir, "documents"))


def op11_wavelet(spark: SparkSession, sf_dir: str) -> DataFrame:
    return wavelet.token_files(table(spark, sf_dir, "documents"), public_tokenizers.path("word_bpe_49k.json"))


def op12_hard_negatives(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = table(spark, sf_dir, "embeddings")
    shifted = F.when(F.col("vec_id") % 7 == 0, (F.col("label") + 1) % 10).otherwise(F.col("label"))
    return hard_negatives.hard_negatives(rows.select("vec_id", shifted.alias("label"), "embedding"), F.col("vec_id") % 100 == 0)


def op13_whitening(spark: SparkSession, sf_dir: str) -> DataFrame:
    return whitening.whitened(table(spark, sf_dir, "embeddings"))


def queries() -> dict[str, Query]:
    return {
        "op1_quality": op1_quality,
        "op2_packing": op2_packing,
        "op3_chat": op3_chat,
        "op4_topk": op4_topk,
        "op5_mixing": op5_mixing,
        "op6_licenses": op6_licenses,
        "op7_spans": op7_spans,
        "op8_toxicity": op8_toxicity,
        "op9_exact_dedup": op9_exact_dedup,
        "op10_minhash": op10_minhash,
        "op11_wavelet": op11_wavelet,
        "op12_hard_negatives": op12_hard_negatives,
        "op13_whitening": op13_whitening,
    }


def oracle_sql() -> dict[str, str]:
    return {
        "op3_chat": chat.ORACLE,
        "op4_topk": topk.ORACLE,
        "op5_mixing": mixing.ORACLE,
        "op9_exact_dedup": exact_dedup.ORACLE,
        "op10_minhash": minhash.ORACLE,
        "op12_hard_negatives": hard_negatives.ORACLE,
    }
