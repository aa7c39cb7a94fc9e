"""All rankings of the incidents from one scan.

``count_rankings`` counts the categories of the ten rankings together, with
GROUPING SETS over their key columns: one read of the incidents, one
aggregation (partial before its shuffle).  ``rank_all`` numbers all of them in one layout, in which
each group of each ranking is a run of its own.  ``one_ranking`` gives a single
ranking from there, in the form of its job in ``blotter.plans.jobs``.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.functions.text import month_prefix, non_empty
from blotter.operators import ranking
from blotter.operators.ordering import with_positions
from blotter.plans import jobs

# The columns that some ranking counts by.
_KEYS = ("primary_type", "location", "arrest", "district", "year_text", "year_month")
# Ranking and the columns it counts by: the group, if any, and the category.
_SETS = {
    **{name: (None, spec.column) for name, spec in jobs.FLAT.items()},
    **{name: (spec.group, spec.key) for name, spec in jobs.NESTED.items()},
}


def _grouping_id(columns: tuple) -> int:
    """What grouping_id() gives for a set: a bit for each key column that is not in it, the first column highest."""
    return sum(0 if c in columns else 1 << (len(_KEYS) - 1 - i) for i, c in enumerate(_KEYS))


def count_rankings(incidents: DataFrame) -> DataFrame:
    """``(ranking, grp, category, n)`` of every ranking; ``grp`` is NULL in the flat ones.
    NULL and empty keys are not counted, as in the single jobs."""
    month = F.when(non_empty("year_text"), F.concat(F.col("year_text"), F.lit("/"), month_prefix("date_text")))
    keyed = incidents.select(*_KEYS[:-1], month.alias(_KEYS[-1]))
    sets = [[F.col(c) for c in columns if c] for columns in _SETS.values()]
    counts = keyed.groupingSets(sets, *_KEYS).agg(F.grouping_id().alias("__set"), F.count(F.lit(1)).alias("n"))

    def of_set(value) -> Column:
        out = None
        for name, columns in _SETS.items():
            hit, v = F.col("__set") == _grouping_id(columns), value(name, *columns)
            out = F.when(hit, v) if out is None else out.when(hit, v)
        return out

    named = counts.select(
        of_set(lambda name, group, key: F.lit(name)).alias("ranking"),
        of_set(lambda name, group, key: F.col(group) if group else F.lit(None).cast("string")).alias("grp"),
        of_set(lambda name, group, key: F.col(key)).alias("category"),
        "n",
    )
    flat = F.col("ranking").isin(*jobs.FLAT)
    return named.where(non_empty("category") & (flat | non_empty("grp")))


def rank_all(incidents: DataFrame) -> DataFrame:
    """``(ranking, grp, category, n, rk)``: rank 1 is the largest count, or the smallest in
    rankings that go upwards; ties by category."""
    upwards = F.col("ranking").isin(*[name for name, spec in jobs.FLAT.items() if spec.direction == ranking.ASC])
    order = [F.when(upwards, F.col("n")).otherwise(-F.col("n")).asc(), F.col("category").asc()]
    return with_positions(count_rankings(incidents), order, name="rk", partition_by=["ranking", "grp"])


def one_ranking(ranked: DataFrame, name: str, rank_col: str | None = "rk") -> DataFrame:
    """The documents of the job ``name``: flat rankings with their rank (without one, sorted, if ``rank_col`` is None),
    the others as one row per group with its ordered list."""
    own = ranked.where(F.col("ranking") == name)
    if name in jobs.FLAT:
        spec = jobs.FLAT[name]
        cols = [F.col("category").alias(spec.key_name), F.col("n").alias(spec.count_name)]
        return own.select(*cols, F.col("rk").alias(rank_col)) if rank_col else own.orderBy("rk").select(*cols)
    spec = jobs.NESTED[name]
    told = F.array_sort(F.collect_list(F.struct("rk", "category", "n")))
    item = lambda x: F.struct(x["category"].alias(spec.item_key), x["n"].alias(jobs.COUNT_NAME))
    return own.groupBy("grp").agg(told.alias("told")).select(F.col("grp").alias(spec.group_name), F.transform("told", item).alias(spec.list_name))
