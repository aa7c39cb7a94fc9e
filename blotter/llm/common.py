"""Helpers shared by the operators: tables, written intermediate tables, words."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from blotter.session import write_out

# Fixed value: a word is a run of characters other than blanks (space, \t \n \v \f \r).
WORD = r"[^\x20\x09-\x0D]+"
# A document is held out when crc32(doc_id as text) mod 5 is 0.
FOLDS = 5


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def materialize(df: DataFrame, name: str, outlives: bool = False) -> DataFrame:
    """Write ``df`` as Parquet below the shared checkpoint folder and read it
    back: the lineage is cut, a lost executor loses nothing, and later readers
    fetch only the columns they need (``blotter.session.write_out``, whose
    ``scratch_tables`` deletes the folder when a result is written)."""
    return write_out(df, name, outlives)


def whole_text(text: str = "text") -> Column:
    """The text, a null one as the empty text."""
    return F.coalesce(F.col(text), F.lit(""))


def word_count(text: Column) -> Column:
    return F.regexp_count(text, F.lit(WORD)).cast("long")


def held_out(doc_id: str = "doc_id") -> Column:
    """True for documents no model learns from; a null id counts as the text ''."""
    return F.crc32(F.coalesce(F.col(doc_id).cast("string"), F.lit("")).cast("binary")) % FOLDS == 0


def one_label(labels: DataFrame, label: str) -> DataFrame:
    """``(__id, __y)``: one 0/1 label per document.  Rows whose id or label is
    null or whose label is neither 0 nor 1 are left out; of several labels the
    larger counts."""
    y = F.col(label).cast("int")
    rows = labels.select(F.col("doc_id").alias("__id"), y.alias("__y")).where(F.col("__id").isNotNull() & F.col("__y").isin(0, 1))
    return rows.groupBy("__id").agg(F.max("__y").alias("__y"))
