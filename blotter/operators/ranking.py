"""Counting and ranking categories.

* ``ranked_counts``          one row per category with its count and rank
* ``grouped_ranked_counts``  the same inside each group (flat form)
* ``nested_ranked_lists``    one row per group holding the ordered list of
                             {category, count} structs
* ``nested_list_parts``      the same list in numbered parts of bounded length
* ``nested_list_text``       that list rendered as ``key:n,key:n`` text

Counting is ``groupBy().count()``: a partial aggregate runs before the
shuffle, so a hot category costs one row per task, not one row per record.
The list per group is collected only after that pre-aggregation, so it holds
distinct categories, never records.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.functions.text import non_empty
from blotter.operators.ordering import with_positions

# Parts into which a group is split before its first rows meet.
SALTS = 16
DESC = "desc"
ASC = "asc"


def _count_order(count_col: str, key: str, direction: str) -> list[Column]:
    n = F.col(count_col).desc() if direction == DESC else F.col(count_col).asc()
    return [n, F.col(key).asc_nulls_first()]


def count_by(df: DataFrame, *keys: str, count_col: str = "n") -> DataFrame:
    """Rows per distinct key combination, not counting rows whose keys are
    NULL or empty.

    The non-empty test is folded into the count (groups left with no counted
    row are dropped afterwards) instead of filtering rows first: a row filter
    would be pushed below the projection that computes the keys and evaluate
    the key expressions (trims, date parsing, ...) a second time per row."""
    cond = F.lit(True)
    for k in keys:
        cond = cond & non_empty(k)
    counts = df.groupBy(*keys).agg(F.count(F.when(cond, F.lit(1))).alias(count_col))
    return counts.where(F.col(count_col) > 0)


def ranked_counts(
    df: DataFrame,
    key: str,
    *,
    direction: str = DESC,
    count_col: str = "n",
    rank_col: str | None = "rk",
    top: int | None = None,
) -> DataFrame:
    """Count rows per ``key`` and rank the categories by count (ties: key ascending).

    Without a rank and without ``top`` the result is one lazy range sort.  A
    rank is numbered over the aggregated categories by the distributed layout;
    ``top`` keeps its first k.
    """
    counts = count_by(df, key, count_col=count_col)
    order = _count_order(count_col, key, direction)
    if rank_col is None and top is None:
        return counts.orderBy(*order)
    rk = rank_col or "__rk"
    ranked = with_positions(counts, order, name=rk)
    if top is not None:
        ranked = ranked.where(F.col(rk) <= top)
    return ranked.orderBy(rk).drop(rk) if rank_col is None else ranked


def _first_of_groups(counts: DataFrame, group: str, order: list[Column], rank: str, top: int) -> DataFrame:
    """The first ``top`` rows of each group with their rank.  Each task keeps its
    first rows of a group before anything is shuffled (Spark's window group limit); then each of ``SALTS`` parts of
    a group keeps its first, so that at most ``SALTS * top`` rows of a group meet, however large it is."""
    parts = counts.withColumn("__part", F.pmod(F.xxhash64(*[F.col(f"`{c}`") for c in counts.columns]), F.lit(SALTS)))
    some = parts.withColumn(rank, F.row_number().over(Window.partitionBy(group, "__part").orderBy(*order))).where(F.col(rank) <= top)
    ranked = some.withColumn(rank, F.row_number().over(Window.partitionBy(group).orderBy(*order)).cast("long"))
    return ranked.where(F.col(rank) <= top).drop("__part")


def grouped_ranked_counts(
    df: DataFrame,
    group: str,
    key: str,
    *,
    direction: str = DESC,
    count_col: str = "n",
    rank_col: str = "rk",
    top: int | None = None,
) -> DataFrame:
    """Count rows per (group, key); rank keys inside each group by count.

    Ranks are numbered over the pre-aggregated (group, key) pairs by the range
    layout, which splits a group with very many categories over several tasks.
    ``top`` keeps the first k of each group, for any k, without laying out the others.
    """
    counts = count_by(df, group, key, count_col=count_col)
    order = _count_order(count_col, key, direction)
    if top is not None:
        return _first_of_groups(counts, group, order, rank_col, top)
    return with_positions(counts, order, name=rank_col, partition_by=[group])


def nested_ranked_lists(
    df: DataFrame,
    group: str,
    key: str,
    *,
    group_name: str | None = None,
    list_name: str = "items",
    item_key: str | None = None,
    item_count: str = "NumberOfEvents",
    top: int | None = None,
) -> DataFrame:
    """One row per group: ``list_name`` = array of {item_key, item_count}
    sorted by count descending, then key ascending.

    Plan: partial+final aggregate on (group, key), then a partial+final
    ``collect_list`` on group over the distinct pairs, then an in-row
    ``array_sort`` - no window, no per-record list.  With ``top`` only the
    first k pairs of each group get there.
    """
    item_key = item_key or key
    counts = count_by(df, group, key, count_col="__n")
    if top is not None:
        # Keep only the first k categories of each group before collecting,
        # so a list never grows past k entries.
        counts = _first_of_groups(counts, group, _count_order("__n", key, DESC), "__rk", top).drop("__rk")
    packed = F.struct(
        (-F.col("__n")).alias("__neg"),
        F.col(key).alias("__key"),
        F.col("__n").alias("__cnt"),
    )
    lists = counts.groupBy(group).agg(F.array_sort(F.collect_list(packed)).alias("__sorted"))
    items = F.transform(
        F.col("__sorted"),
        lambda x: F.struct(x["__key"].alias(item_key), x["__cnt"].alias(item_count)),
    )
    out = lists.select(F.col(group).alias(group_name or group), items.alias(list_name))
    return out


def nested_list_parts(
    df: DataFrame,
    group: str,
    key: str,
    part_size: int,
    *,
    group_name: str | None = None,
    list_name: str = "items",
    item_key: str | None = None,
    item_count: str = "NumberOfEvents",
) -> DataFrame:
    """``(group, part, list)``: the lists of ``nested_ranked_lists`` cut into parts of
    ``part_size`` entries, numbered from 0, for groups whose whole list is too
    large for one row.  The places come from the distributed layout, so neither a
    task nor a row holds more of a group than a part."""
    if part_size < 1:
        raise ValueError("part_size must be at least 1")
    ranked = grouped_ranked_counts(df, group, key, count_col="__n", rank_col="__rk")
    part = F.floor((F.col("__rk") - F.lit(1)) / F.lit(part_size)).cast("long")
    told = F.array_sort(F.collect_list(F.struct("__rk", F.col(f"`{key}`").alias("__key"), "__n")))
    parts = ranked.groupBy(F.col(f"`{group}`").alias(group_name or group), part.alias("part")).agg(told.alias("__told"))
    item = lambda x: F.struct(x["__key"].alias(item_key or key), x["__n"].alias(item_count))
    return parts.select(F.col(f"`{group_name or group}`"), "part", F.transform("__told", item).alias(list_name))


def nested_list_text(lists: DataFrame, list_name: str, item_key: str, item_count: str = "NumberOfEvents") -> Column:
    """``key:n,key:n,...`` in list order (used to compare lists as data)."""
    return F.array_join(
        F.transform(
            F.col(list_name),
            lambda x: F.concat(x[item_key], F.lit(":"), x[item_count].cast("string")),
        ),
        ",",
    )
