"""Ordered positions and running totals without a single-task window.

``row_number() over (order by ...)`` with no PARTITION BY moves every row into
one task, and ``partition by year`` moves a whole year into one task.  Here the
order is laid out across many tasks instead, at every size:

1. the input is written once, so that it is evaluated once although a range
   exchange reads it twice (to sample it and to deal it out);
2. it is range-partitioned on (group, order) and sorted inside each slice:
   slices are consecutive runs of the global order, and rows of one group are
   contiguous;
3. every row is tagged with its slice and a sequence number, and the layout (only
   the columns that are kept) is written to the shared checkpoint folder, so that a lost executor cannot
   re-create a slice with different content after its size was counted;
4. rows are counted (or weights summed) per (slice, group) - at most
   ``slices + groups`` rows - and the counts become the start offset of each
   (slice, group), which is added back to every row.

Joins are plain equi-joins: Spark broadcasts a side whose measured size allows
it and splits skewed partitions.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.session import write_out

_SLICE = "__slice"
_SEQ = "__seq"


def _as_col(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def lay_out(
    df: DataFrame,
    order: Sequence[Column | str],
    partition_by: Sequence[str] = (),
    slices: int | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Range-partition and sort ``df`` by (partition_by, order), tag slice and
    sequence, and write the result with the columns ``keep`` (default: all)."""
    kept = list(dict.fromkeys([*partition_by, *(df.columns if keep is None else keep)]))
    source = write_out(df, "ordered-input")
    sort_keys = [F.col(f"`{g}`").asc_nulls_first() for g in partition_by] + [_as_col(o) for o in order]
    # Without an explicit slice count AQE sizes the range exchange from the
    # data (coalescing only merges neighbouring ranges, so order is kept).
    ranged = source.repartitionByRange(slices, *sort_keys) if slices else source.repartitionByRange(*sort_keys)
    tags = (F.spark_partition_id().alias(_SLICE), F.monotonically_increasing_id().alias(_SEQ))
    laid = ranged.sortWithinPartitions(*sort_keys).select("*", *tags).select(*[F.col(f"`{c}`") for c in kept], _SLICE, _SEQ)
    return write_out(laid, "layout")


def _offsets(stats: DataFrame, partition_by: Sequence[str], amount: str) -> DataFrame:
    # At most one row per slice and one per group; ordered within a group, or
    # over the slices when there is no group.
    before = Window.partitionBy(*(partition_by or [F.lit(0)])).orderBy(_SLICE).rowsBetween(Window.unboundedPreceding, -1)
    return stats.withColumn("__before", F.coalesce(F.sum(amount).over(before), F.lit(0)))


def _attach(laid: DataFrame, stats: DataFrame, partition_by: Sequence[str]) -> DataFrame:
    keys = [_SLICE, *partition_by]
    # Give the offset table its own key names: it derives from ``laid``, and
    # a join of two lineages of one table must not mix up their columns.
    renamed = {k: f"__k{i}" for i, k in enumerate(keys)}
    stats = stats.select(*[F.col(f"`{c}`").alias(renamed.get(c, c)) for c in stats.columns])
    cond = [laid[f"`{k}`"].eqNullSafe(stats[renamed[k]]) for k in keys]
    return laid.join(stats, cond, "inner").drop(*renamed.values())


def with_positions(
    df: DataFrame,
    order: Sequence[Column | str],
    name: str = "pos",
    partition_by: Sequence[str] = (),
    slices: int | None = None,
    keep: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``name`` = 1-based row number within each ``partition_by`` group in
    ``order``.  ``order`` must make rows unique for the numbering to be
    deterministic (end it with a unique key).
    The result holds the columns ``keep`` (default: all) and ``name``."""
    keep = list(df.columns if keep is None else keep)
    laid = lay_out(df, order, partition_by, slices, keep)
    stats = laid.groupBy(_SLICE, *partition_by).agg(F.min(_SEQ).alias("__first"), F.count(F.lit(1)).alias("__rows"))
    joined = _attach(laid, _offsets(stats, partition_by, "__rows"), partition_by)
    pos = (F.col("__before") + (F.col(_SEQ) - F.col("__first")) + F.lit(1)).cast("long")
    return joined.select(*[F.col(f"`{c}`") for c in keep], pos.alias(name))


def with_running_total(
    df: DataFrame,
    order: Sequence[Column | str],
    weight: str,
    name: str = "running",
    partition_by: Sequence[str] = (),
    slices: int | None = None,
    total: str | None = None,
) -> DataFrame:
    """Add ``name`` = sum of ``weight`` over all rows up to and including this
    one in ``order`` (within each ``partition_by`` group), and under the name
    ``total``, if given, the sum over the whole group: it comes from the offset
    table, so the layout is read once."""
    laid = lay_out(df, order, partition_by, slices)
    local = Window.partitionBy(_SLICE, *partition_by).orderBy(_SEQ).rowsBetween(Window.unboundedPreceding, 0)
    laid = laid.withColumn("__local", F.sum(weight).over(local))
    stats = laid.groupBy(_SLICE, *partition_by).agg(F.sum(weight).alias("__total"))
    offsets = _offsets(stats, partition_by, "__total")
    if total is not None:
        offsets = offsets.withColumn("__all", F.sum("__total").over(Window.partitionBy(*(partition_by or [F.lit(0)]))))
    joined = _attach(laid, offsets, partition_by)
    sums = [(F.col("__before") + F.col("__local")).alias(name), *([F.col("__all").alias(total)] if total is not None else [])]
    return joined.select(*[F.col(f"`{c}`") for c in df.columns], *sums)
