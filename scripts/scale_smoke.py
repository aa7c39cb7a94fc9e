"""Exercise the distributed paths on generated data larger than the test tables.

Not a registered query (the data is generated): it checks that the layouts
hold up when the inputs exceed the single-window bound and one key holds a
third of the rows.  Usage: python scripts/scale_smoke.py [rows]
"""

from __future__ import annotations

import os
import sys
import time

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import functions as F  # noqa: E402

from blotter.operators.ordering import with_positions  # noqa: E402
from blotter.operators.ranking import grouped_ranked_counts, ranked_counts  # noqa: E402
from blotter.operators.stats import correlation, positional_pairs  # noqa: E402
from blotter.session import local_session  # noqa: E402


def timed(label, fn):
    t0 = time.perf_counter()
    out = fn()
    print(f"{label:45s} {time.perf_counter() - t0:7.2f}s  {out}")
    return out


def main(rows: int) -> None:
    spark = local_session(8, shuffle_partitions=64)
    base = spark.range(rows).select(
        F.col("id").alias("incident_id"),
        # a third of all rows share one category
        F.when(F.col("id") % 3 == 0, F.lit("HOT")).otherwise((F.col("id") * 7919 % 3_000_000).cast("string")).alias("k"),
        F.when(F.col("id") % 3 == 0, F.lit(2015)).otherwise(F.lit(2016) + (F.col("id") % 2)).alias("year"),
        ((F.col("id") * 2654435761) % 25 + 1).cast("double").alias("v"),
    )
    ranked = timed("ranked_counts (~2M categories)",
                   lambda: ranked_counts(base, "k", count_col="n"))
    top = timed("  top-3 of the ranking", lambda: [tuple(r) for r in ranked.where("rk <= 3").orderBy("rk").collect()])
    assert top[0][0] == "HOT"
    timed("  rank is 1..m", lambda: ranked.agg(F.min("rk"), F.max("rk"), F.count(F.lit(1))).first())
    grouped = timed("grouped_ranked_counts (year, category) pairs",
                    lambda: grouped_ranked_counts(base, "year", "k", count_col="n"))
    timed("  rank 1 per year", lambda: sorted(map(tuple, grouped.where("rk = 1").select("year", "k", "n").collect())))
    timed("  ranks are 1..m in every year",
          lambda: grouped.groupBy("year").agg(F.max("rk"), F.count(F.lit(1))).orderBy("year").collect())
    top5000 = timed("grouped_ranked_counts, top=5000", lambda: grouped_ranked_counts(base, "year", "k", count_col="n", top=5000))
    timed("  rows kept per year", lambda: sorted(map(tuple, top5000.groupBy("year").count().collect())))
    pos = timed("positions per year (hot year = 1/3)",
                lambda: with_positions(base, [F.col("incident_id").asc()], name="pos", partition_by=["year"]))
    timed("  max position per year", lambda: sorted(map(tuple, pos.groupBy("year").agg(F.max("pos")).collect())))
    pairs = positional_pairs(base, 2015, 2016)
    timed("pearson over positional pairs", lambda: tuple(correlation(pairs).drop("report").first()))
    timed("spearman over positional pairs", lambda: tuple(correlation(pairs, "spearman").drop("report").first()))
    # documents without ids: their order is their place in the files
    place = F.struct(F.lit("part-0").alias("file"), F.floor(F.col("incident_id") / 1_000_000).cast("long").alias("start"), F.col("incident_id").alias("row"))
    plain = base.withColumn("position", place).withColumn("incident_id", F.lit(None).cast("long"))
    by_place = timed("pearson over id-less documents", lambda: tuple(correlation(positional_pairs(plain, 2015, 2016)).drop("report").first()))
    by_id = tuple(correlation(pairs).drop("report").first())
    assert abs(by_place[0] - by_id[0]) < 1e-9 and by_place[1] == by_id[1]
    spark.stop()


if __name__ == "__main__":
    main(int(sys.argv[1]) if len(sys.argv) > 1 else 12_000_000)
