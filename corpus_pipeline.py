"""From raw documents to packed training sequences in five stages.

Every stage takes ``(spark, docs, sf_dir)`` and returns a DataFrame that is
written as Parquet and read again as the ``docs`` of the next one.  All stages
but the last return the columns of ``documents``.

1. toxicity: fits on the labels and drops the documents it rejects;
2. exact_dedup: one document of each text stays;
3. minhash: one document of each group of near copies stays;
4. mixing: sources are brought to their target weights, repeating documents of
   sources that weigh more than they hold (a copy is a row of its own);
5. packing: pieces of at most 2048 words in bins, one row per piece with its
   text.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from blotter.llm import exact_dedup, minhash, mixing, packing, toxicity
from blotter.llm.common import materialize, table


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return toxicity.drop_toxic(docs, toxicity.train(docs, table(spark, sf_dir, "labels")))


def drop_exact_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return exact_dedup.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return minhash.near_dedup(docs)


def mix_sources(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return mixing.mix(docs)


def pack_bins(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    return packing.pack(docs, with_text=True)


STAGES = [
    ("toxicity", drop_toxic),
    ("exact_dedup", drop_exact_copies),
    ("minhash", drop_near_copies),
    ("mixing", mix_sources),
    ("packing", pack_bins),
]

# Scores, near copies and packing are not SQL.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; the result of the last one."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = materialize(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
