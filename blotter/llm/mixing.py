"""Mixing sources to target weights by Sainte-Laguë apportionment.

Words are dealt out in blocks of ``block`` words.  The blocks of the mix go to
the sources by highest quotients ``target / (2 s - 1)``, then each source's
blocks go to its shards in the same way (quotients of the shard sizes).  Inside
a shard the documents stand in a seeded order and the first blocks of that
order are taken, starting over when a shard is used more than once.

Sources and shards are units with a weight; ``apportion`` finds the highest
quotients without listing them all: a divisor too large by half a seat per
unit gives every unit seats that it surely gets, one too small gives every
seat it may get, and only the seats in between (at most two per unit on
average) are ranked.

Documents are hashed to ``sqrt(documents) / 2`` cells per source, so neither the cells of a
source nor the documents of a cell become a large group when one source holds
a third of the rows.  A shard is one cell or, in a source of few words, as many
neighbouring ones as give it ``SHARD_BLOCKS`` blocks on average: a shard gives at most ``max_use``
times its words, and of shards of many blocks only a part of one is lost by that limit, so that
small sources of short documents come near their target too.  All of it is DataFrame functions.

Null texts have size 0, null sources are one source of their own (last), null
ids are ordered as the empty text, repeated rows count each.  A source without
words gets target 0.  An empty table gives an empty result.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.llm.common import WORD, materialize, whole_text, word_count

# Weights of the sources in code point order, repeating.
WEIGHTS = (5, 2, 1)
# Fixed value: no source and no document is used more than so many times.
MAX_USE = 3
BLOCK = 8
# Blocks that a shard holds on average, where its source has so many.
SHARD_BLOCKS = 128
SEED = 17


def apportion(units: DataFrame, group: Sequence[str], unit: Sequence[str], weight: str, seats: str, name: str) -> DataFrame:
    """Add ``name`` = seats of each unit: the column ``seats`` (equal within a
    group) dealt out by Sainte-Laguë's highest quotients; ties go to the unit
    that comes first."""
    per = Window.partitionBy(*group) if group else Window.partitionBy(F.lit(0))
    has = F.col(weight) > 0
    total, half = F.sum(F.col(weight).cast("double")).over(per), F.sum(F.when(has, 1).otherwise(0)).over(per) / F.lit(2.0)
    held = lambda q: F.when(has, F.greatest(F.lit(0), F.floor(F.col(weight) * q / F.col("__total") + F.lit(0.5)))).otherwise(0).cast("long")
    wide = (
        units.withColumns({"__total": total, "__half": half})
        .withColumns({"__lo": held(F.col(seats) - F.col("__half")), "__hi": held(F.col(seats) + F.col("__half"))})
        .withColumn("__left", F.col(seats) - F.sum("__lo").over(per))
        .withColumn("__s", F.explode_outer(F.when(F.col("__hi") > F.col("__lo"), F.sequence(F.col("__lo") + 1, F.col("__hi")))))
        .withColumn("__quotient", F.col(weight) / (F.lit(2.0) * F.col("__s") - F.lit(1.0)))
    )
    won = F.row_number().over(per.orderBy(F.col("__quotient").desc_nulls_last(), *unit, "__s")) <= F.col("__left")
    one = F.when(won & F.col("__s").isNotNull(), 1).otherwise(0)
    return wide.withColumn("__one", one).groupBy(*units.columns, "__lo").agg(F.sum("__one").alias("__more")).select(*units.columns, (F.col("__lo") + F.col("__more")).alias(name))


def source_targets(shards: DataFrame, weights: Sequence[int] = WEIGHTS, max_use: int = MAX_USE) -> DataFrame:
    """``(__key, source_size, target)`` from the sizes of the shards: shares by
    weight, filled up to ``max_use`` times each source's size (the sources that
    fill up come first in the order of size / weight)."""
    sources = shards.groupBy("__key").agg(F.sum("__size").alias("source_size"))
    every = Window.partitionBy(F.lit(0))
    place = F.row_number().over(every.orderBy("__key"))
    w = F.element_at(F.array(*[F.lit(float(x)) for x in weights]), (F.pmod(place - 1, F.lit(len(weights))) + 1).cast("int"))
    filling = every.orderBy("__room", "__key").rowsBetween(Window.unboundedPreceding, -1)
    before = lambda c: F.coalesce(F.sum(c).over(filling), F.lit(0.0))
    return (
        sources.withColumn("__w", w)
        .withColumn("__cap", F.lit(float(max_use)) * F.col("source_size"))
        .withColumn("__room", F.col("__cap") / F.col("__w"))
        .withColumns({"__words": F.sum(F.col("source_size").cast("double")).over(every), "__weight": F.sum("__w").over(every)})
        .withColumns({"__cap_before": before("__cap"), "__w_before": before("__w")})
        .withColumn("__level", (F.col("__words") - F.col("__cap_before")) / (F.col("__weight") - F.col("__w_before")))
        .withColumn("__full", F.col("__room") <= F.col("__level"))
        .withColumn("__common", F.max(F.when(~F.col("__full"), F.col("__level"))).over(every))
        .select("__key", "source_size", F.when(F.col("__full"), F.col("__cap")).otherwise(F.col("__w") * F.col("__common")).alias("target"))
    )


def joined_cells(cells: DataFrame, words: int) -> DataFrame:
    """Adds ``__shard`` and ``__before``: the cells of a source dealt round-robin to shards of ``words`` words
    on average, and the words of the shard's cells that come before this one."""
    many = cells.withColumn("__words", F.sum("__size").over(Window.partitionBy("__key")))
    dealt = many.withColumn("__shard", F.pmod(F.col("__cell"), F.greatest(F.lit(1).cast("long"), F.expr(f"__words div {words}")))).drop("__words")
    earlier = Window.partitionBy("__key", "__shard").orderBy("__cell").rowsBetween(Window.unboundedPreceding, -1)
    return dealt.withColumn("__before", F.coalesce(F.sum("__size").over(earlier), F.lit(0)))


def cell_quotas(cells: DataFrame, weights: Sequence[int] = WEIGHTS, max_use: int = MAX_USE, block: int = BLOCK) -> DataFrame:
    """``(__key, __cell, __before, __shard_size, source_size, target, __quota)``: the words that
    the shard of each cell gives to the mix, and where the cell begins in it."""
    placed = joined_cells(cells, SHARD_BLOCKS * block)
    shards = placed.groupBy("__key", "__shard").agg(F.sum("__size").alias("__size"))
    targets = source_targets(shards, weights, max_use)
    blocks = F.floor(F.sum(F.col("source_size").cast("double")).over(Window.partitionBy(F.lit(0))) / F.lit(float(block)) + F.lit(0.5))
    sources = apportion(targets.withColumn("__blocks", blocks.cast("long")), [], ["__key"], "target", "__blocks", "__seats")
    dealt = shards.join(sources.select("__key", "source_size", "target", "__seats"), "__key")
    dealt = apportion(dealt, ["__key"], ["__shard"], "__size", "__seats", "__dealt")
    quota = F.least(F.col("__dealt") * F.lit(block), F.col("__size") * F.lit(max_use))
    quotas = dealt.select("__key", "__shard", F.col("__size").alias("__shard_size"), "source_size", "target", quota.alias("__quota"))
    return placed.select("__key", "__cell", "__shard", "__before").join(quotas, ["__key", "__shard"]).drop("__shard")


def _keyed(docs: DataFrame, seed: int, carry: bool = False) -> DataFrame:
    """The id, the source as a key that sorts nulls last, the size and the seeded
    order; with ``carry`` the whole row as ``__doc``."""
    key = F.coalesce(F.concat(F.lit("1"), F.col("source")), F.lit("2"))
    order = F.md5(F.concat(F.lit(f"{seed}:"), F.coalesce(F.col("doc_id").cast("string"), F.lit(""))).cast("binary"))
    row = [F.struct(*[F.col(f"`{c}`") for c in docs.columns]).alias("__doc")] if carry else []
    return docs.select("doc_id", key.alias("__key"), word_count(whole_text()).alias("__size"), order.alias("__order"), *row)


def _in_cells(rows: DataFrame, cells: int) -> DataFrame:
    return rows.withColumn("__cell", F.pmod(F.conv(F.substring("__order", 1, 8), 16, 10).cast("long"), F.lit(cells)))


def _taken(rows: DataFrame, quotas: DataFrame) -> DataFrame:
    """Adds ``__taken``: whole rounds of the shard, then the first words of its order (cell by cell)."""
    earlier = Window.partitionBy("__key", "__cell").orderBy("__order", "doc_id", "__size").rowsBetween(Window.unboundedPreceding, -1)
    rows = rows.withColumn("__inside", F.coalesce(F.sum("__size").over(earlier), F.lit(0)))
    rows = rows.join(quotas, ["__key", "__cell"]).withColumn("__start", F.col("__before") + F.col("__inside"))
    rounds = F.when(F.col("__shard_size") > 0, F.expr("__quota div __shard_size")).otherwise(0)
    rest = F.when(F.col("__shard_size") > 0, F.col("__quota") % F.col("__shard_size")).otherwise(0)
    part = F.least(F.greatest(rest - F.col("__start"), F.lit(0)), F.col("__size"))
    return rows.withColumn("__taken", (rounds * F.col("__size") + part).cast("long"))


def _quotas(docs: DataFrame, seed: int, weights: Sequence[int], max_use: int, block: int) -> tuple[DataFrame, DataFrame, int]:
    narrow = materialize(_keyed(docs, seed), "mix")
    cells = math.isqrt(narrow.count()) // 2 + 1
    narrow = _in_cells(narrow, cells)
    sizes = narrow.groupBy("__key", "__cell").agg(F.sum("__size").alias("__size"))
    return narrow, cell_quotas(sizes, weights, max_use, block), cells


def mix_plan(docs: DataFrame, *, seed: int = SEED, weights: Sequence[int] = WEIGHTS, max_use: int = MAX_USE, block: int = BLOCK) -> DataFrame:
    """One row per document: ``doc_id, size, source_size, target, taken``."""
    narrow, quotas, _ = _quotas(docs, seed, weights, max_use, block)
    out = _taken(narrow, quotas)
    return out.select("doc_id", F.col("__size").alias("size"), "source_size", "target", F.col("__taken").alias("taken"))


def _first_words(text: Column, n: Column) -> Column:
    """The text up to the end of its n-th word, blanks as they stand."""
    blanks = r"[\x20\x09-\x0D]+"
    leading = F.when(F.regexp_like(text, F.lit(r"^[\x20\x09-\x0D]")), 1).otherwise(0)
    tail = F.element_at(F.split(text, blanks, n + leading + 1), -1)
    return F.rtrim(F.left(text, F.length(text) - F.length(tail)))


def mix(docs: DataFrame, *, seed: int = SEED, weights: Sequence[int] = WEIGHTS, max_use: int = MAX_USE, block: int = BLOCK) -> DataFrame:
    """The mix itself, with the columns of ``docs``: a document taken t times
    its size stands there t times, and one of which the mix takes a part (at
    most one per shard) ends after the words taken; its ``n_chars``, if there
    is one, is set anew.  Documents without words or with nothing taken go."""
    _, quotas, cells = _quotas(docs, seed, weights, max_use, block)
    rows = _taken(_in_cells(_keyed(docs, seed, carry=True), cells), quotas).where(F.col("__taken") > 0)
    copies = F.sequence(F.lit(1).cast("long"), F.ceil(F.col("__taken") / F.col("__size")).cast("long"))
    rows = rows.select("__doc", "__size", "__taken", F.explode(copies).alias("__copy"))
    left = F.col("__taken") - (F.col("__copy") - 1) * F.col("__size")
    whole, text = left >= F.col("__size"), F.col("__doc.text")
    rows = rows.select("__doc", whole.alias("__whole"), F.when(whole, text).otherwise(_first_words(text, left.cast("int"))).alias("__text"))

    def column(c: str) -> Column:
        own = F.col(f"__doc.`{c}`")
        if c == "text":
            own = F.col("__text")
        elif c == "n_chars":
            own = F.when(F.col("__whole"), own).otherwise(F.length("__text").cast(docs.schema[c].dataType))
        return own.alias(c)

    return rows.select(*[column(c) for c in docs.columns])


# The same apportionment in DuckDB SQL (seeded order by md5, closed-form seats).
ORACLE = f"""
WITH keyed AS (
  SELECT doc_id, CASE WHEN source IS NULL THEN '2' ELSE '1' || source END AS k,
         len(regexp_extract_all(coalesce(text, ''), '{WORD}'))::BIGINT AS size,
         md5('{SEED}:' || coalesce(doc_id::VARCHAR, '')) AS ord
  FROM documents),
n AS (SELECT floor(sqrt(count(*)))::BIGINT // 2 + 1 AS cells FROM keyed),
rows AS (SELECT keyed.*, ('0x' || substr(ord, 1, 8))::BIGINT % cells AS cell FROM keyed, n),
cells AS (
  SELECT k, cell, size, cell % greatest(1, (sum(size) OVER (PARTITION BY k))::BIGINT // {SHARD_BLOCKS * BLOCK}) AS shard
  FROM (SELECT k, cell, sum(size)::BIGINT AS size FROM rows GROUP BY ALL)),
begins AS (
  SELECT k, cell, shard, coalesce(sum(size) OVER (PARTITION BY k, shard ORDER BY cell
                                                 ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS before FROM cells),
shards AS (SELECT k, shard, sum(size)::BIGINT AS size FROM cells GROUP BY ALL),
sources AS (
  SELECT *, (3.0 * c)::DOUBLE / w AS room FROM (
    SELECT k, sum(size)::BIGINT AS c, list_extract([5.0, 2.0, 1.0]::DOUBLE[], (row_number() OVER (ORDER BY k) - 1) % 3 + 1) AS w
    FROM shards GROUP BY k)),
filling AS (
  SELECT *, (sum(c) OVER () - coalesce(sum(3.0::DOUBLE * c) OVER f, 0))
            / (sum(w) OVER () - coalesce(sum(w) OVER f, 0)) AS level
  FROM sources
  WINDOW f AS (ORDER BY room, k ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
targets AS (
  SELECT k, c, CASE WHEN room <= level THEN 3.0::DOUBLE * c
                    ELSE w * max(CASE WHEN room > level THEN level END) OVER () END AS target
  FROM filling),
b1 AS (
  SELECT *, floor(sum(c) OVER ()::DOUBLE / {float(BLOCK)}::DOUBLE + 0.5)::BIGINT AS q,
         sum(target) OVER () AS total, sum((target > 0)::INT) OVER () / 2.0::DOUBLE AS half FROM targets),
b2 AS (
  SELECT *, CASE WHEN target > 0 THEN greatest(0, floor(target * (q - half) / total + 0.5)) ELSE 0 END::BIGINT AS lo,
         CASE WHEN target > 0 THEN greatest(0, floor(target * (q + half) / total + 0.5)) ELSE 0 END::BIGINT AS hi FROM b1),
b3 AS (
  SELECT k, row_number() OVER (ORDER BY target / (2.0::DOUBLE * s - 1.0) DESC, k, s) <= q - l AS won
  FROM (SELECT *, unnest(generate_series(lo + 1, hi)) AS s FROM (SELECT *, sum(lo) OVER () AS l FROM b2))),
seats AS (SELECT b2.*, lo + (SELECT count(*) FROM b3 WHERE b3.k = b2.k AND won) AS seats FROM b2),
d1 AS (
  SELECT s.k, s.shard, s.size, t.c, t.target, t.seats, sum(s.size) OVER p::DOUBLE AS total,
         sum((s.size > 0)::INT) OVER p / 2.0::DOUBLE AS half
  FROM shards s JOIN seats t USING (k) WINDOW p AS (PARTITION BY s.k)),
d2 AS (
  SELECT *, CASE WHEN size > 0 THEN greatest(0, floor(size * (seats - half) / total + 0.5)) ELSE 0 END::BIGINT AS lo,
         CASE WHEN size > 0 THEN greatest(0, floor(size * (seats + half) / total + 0.5)) ELSE 0 END::BIGINT AS hi FROM d1),
d3 AS (
  SELECT k, shard, row_number() OVER (PARTITION BY k ORDER BY size / (2.0::DOUBLE * s - 1.0) DESC, shard, s) <= seats - l AS won
  FROM (SELECT *, unnest(generate_series(lo + 1, hi)) AS s FROM (SELECT *, sum(lo) OVER (PARTITION BY k) AS l FROM d2))),
won AS (SELECT k, shard, count(*) AS more FROM d3 WHERE won GROUP BY ALL),
quotas AS (
  SELECT d2.k, d2.shard, size AS shard_size, c, target, least((lo + coalesce(more, 0)) * {BLOCK}, 3 * size)::BIGINT AS quota
  FROM d2 LEFT JOIN won USING (k, shard)),
placed AS (
  SELECT r.*, q.shard_size, q.c, q.target, q.quota,
         b.before + coalesce(sum(r.size) OVER (PARTITION BY r.k, r.cell ORDER BY ord, doc_id NULLS FIRST, r.size
                                               ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0)::BIGINT AS start
  FROM rows r JOIN begins b USING (k, cell) JOIN quotas q USING (k, shard))
SELECT doc_id, size, c AS source_size, target,
       (CASE WHEN shard_size = 0 THEN 0 ELSE
          (quota // shard_size) * size + least(greatest(quota % shard_size - start, 0), size) END)::BIGINT AS taken
FROM placed
"""
