"""Exact dedup by skew-safe combining.

Equal texts are found in three steps, and every step groups by the digest
*and* the whole text, so full content is compared each time:

1. local: the partial aggregate of each task keeps one row per text;
2. salted: the local winners meet in ``salts`` groups per digest, so the copies
   of one text never meet in one task;
3. global: at most ``salts`` winners per text are combined.

A text that fills a third of the table costs one row per task and one per
salt.  Null texts count as empty.  Of equal texts the row with the largest
doc_id stays; a null doc_id is smaller than any other.  Rows that repeat both
doc_id and text are one document: ``exact_groups`` marks them alike, and
``exact_dedup`` keeps the one whose remaining columns are largest.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from blotter.llm.common import materialize, whole_text

SALTS = 16
Digest = Callable[[Column], Column]


def sha256(text: Column) -> Column:
    return F.sha2(text.cast("binary"), 256)


def _digested(docs: DataFrame, digest: Digest) -> DataFrame:
    rows = docs.select(F.col("doc_id").alias("__id"), whole_text().alias("__text"))
    return rows.withColumn("__digest", digest(F.col("__text")))


def _combine(rows: DataFrame, salts: int) -> DataFrame:
    """One row ``(__digest, __text, __keep, __n)`` per distinct text."""
    salt = F.pmod(F.xxhash64("__id"), F.lit(salts))
    salted = rows.groupBy("__digest", "__text", salt.alias("__salt")).agg(F.max("__id").alias("__keep"), F.count(F.lit(1)).alias("__n"))
    return salted.groupBy("__digest", "__text").agg(F.max("__keep").alias("__keep"), F.sum("__n").alias("__n"))


def exact_groups(docs: DataFrame, *, salts: int = SALTS, digest: Digest = sha256) -> DataFrame:
    """One row per document: ``doc_id, keep_id, group_size, kept, text_sha256``.

    Documents are matched to their group by digest alone, which is exact for
    every digest that the full comparison found to stand for one text; should
    a digest stand for several texts, its documents are matched by text."""
    rows = _digested(docs, digest)
    by_digest = _combine(rows, salts).groupBy("__digest").agg(
        F.count(F.lit(1)).alias("__texts"), F.max("__keep").alias("__keep"), F.max("__n").alias("__n")
    )
    known = materialize(by_digest.where((F.col("__n") > 1) | (F.col("__texts") > 1)), "exact-groups")
    single = F.col("__texts").isNull() | (F.col("__texts") == 1)
    out = (
        docs.select(F.col("doc_id").alias("__id"), whole_text().alias("__text"))
        .select("__id", sha256(F.col("__text")).alias("__sha"), digest(F.col("__text")).alias("__digest"))
        .join(known, "__digest", "left")
        .where(single)
        .select("__id", "__sha", F.when(F.col("__texts") == 1, F.col("__keep")).otherwise(F.col("__id")).alias("__keep"), F.coalesce("__n", F.lit(1)).alias("__n"))
    )
    clashes = known.where(F.col("__texts") > 1).select("__digest")
    if not clashes.isEmpty():
        some = rows.join(clashes, "__digest", "left_semi")
        groups = _combine(some, salts)
        by_text = some.join(groups, ["__digest", "__text"])
        out = out.unionByName(by_text.select("__id", sha256(F.col("__text")).alias("__sha"), "__keep", "__n"))
    return out.select(
        F.col("__id").alias("doc_id"),
        F.col("__keep").alias("keep_id"),
        F.col("__n").cast("long").alias("group_size"),
        F.col("__id").eqNullSafe(F.col("__keep")).alias("kept"),
        F.col("__sha").alias("text_sha256"),
    )


def _ordered(kind: T.DataType) -> bool:
    """Whether Spark can compare two values of the type: not maps and variants, nor what holds them."""
    if isinstance(kind, T.StructType):
        return all(_ordered(f.dataType) for f in kind)
    if isinstance(kind, T.ArrayType):
        return _ordered(kind.elementType)
    return not isinstance(kind, (T.MapType, T.VariantType))


def exact_dedup(docs: DataFrame, *, salts: int = SALTS, digest: Digest = sha256) -> DataFrame:
    """The documents that stay, with all their columns: the same three steps,
    carrying the winning row instead of its id.  Columns that cannot be compared
    (maps, variants) are carried beside the row and compared by their JSON text."""
    rest = [c for c in docs.columns if c not in ("doc_id", "text")]
    beside = [c for c in rest if not _ordered(docs.schema[c].dataType)]
    parts = [F.to_json(F.struct(F.col(f"`{c}`").alias("x"))).alias(c) if c in beside else F.col(f"`{c}`") for c in rest]
    row = F.struct(F.col("doc_id"), F.col("text").isNotNull().alias("__has_text"), *parts)
    side = [F.struct(*[F.col(f"`{c}`") for c in beside]).alias("__side")] if beside else []
    rows = docs.select(row.alias("__row"), *side, whole_text().alias("__text")).withColumn("__digest", digest(F.col("__text")))
    best = [F.max("__row").alias("__row"), *([F.max_by("__side", "__row").alias("__side")] if beside else [])]
    salt = F.pmod(F.xxhash64("__row.doc_id"), F.lit(salts))
    salted = rows.groupBy("__digest", "__text", salt.alias("__salt")).agg(*best)
    whole = salted.groupBy("__digest", "__text").agg(*best)
    text = F.when(F.col("__row.__has_text"), F.col("__text")).alias("text")
    return whole.select(*[text if c == "text" else F.col(f"{'__side' if c in beside else '__row'}.`{c}`").alias(c) for c in docs.columns])


ORACLE = """
SELECT doc_id,
       max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS keep_id,
       count(*) OVER (PARTITION BY coalesce(text, '')) AS group_size,
       doc_id IS NOT DISTINCT FROM max(doc_id) OVER (PARTITION BY coalesce(text, '')) AS kept,
       sha256(coalesce(text, '')) AS text_sha256
FROM documents
"""
