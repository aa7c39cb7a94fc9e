"""Chat formatting with cumulative-snapshot collapse.

A log holds a conversation several times, once for every turn added.  Every
turn gets the hash of the conversation up to it: the running sum of hashes of
(position, role, text), so that the hash of a prefix does not depend on what
follows.  A conversation whose whole hash is the prefix hash of more turns than
whole conversations end there is a snapshot of a longer one and goes by
anti-join; of equal conversations the smallest id stays.  The maximal ones are
rendered.

Positions and running sums come from the range layout of
``blotter.operators.ordering``, so a conversation with very many turns is
spread over tasks; the sums run over hashes without texts.  Rendering gives a
row for each ``max_turns`` turns.

Turns stand in the order of (turn, role, SHA-256 of the text), null turns first, so that what
the range layout samples and compares stays small however long a text is; a null role or
text counts as empty.  Rows that repeat a turn are turns of their own.  Rows
with a null conv_id form one conversation, kept last among equals.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import materialize
from blotter.operators.ordering import with_positions, with_running_total

MAX_TURNS = 256
# The marks around a turn.
OPEN, CLOSE = "<|im_start|>", "<|im_end|>"


def _hash() -> Column:
    """104 bits of (position, role, text) as a decimal, so that sums over any
    number of turns neither wrap nor round."""
    high, low = F.xxhash64(F.lit(1), "pos", "role", "text"), F.xxhash64(F.lit(2), "pos", "role", "text")
    return high.cast("decimal(20,0)") * F.lit(1 << 40).cast("decimal(13,0)") + low.bitwiseAND(F.lit((1 << 40) - 1)).cast("decimal(13,0)")


def placed_turns(turns: DataFrame) -> DataFrame:
    """``conv_id, pos, role, text``: the turns with their place in the conversation."""
    text = lambda c: F.coalesce(F.col(c), F.lit("")).alias(c)
    rows = turns.select("conv_id", "turn", text("role"), text("text")).withColumn("digest", F.sha2("text", 256))
    return with_positions(rows, [F.col("turn").asc_nulls_first(), "role", "digest"], name="pos", partition_by=["conv_id"], keep=["conv_id", "role", "text"])


def prefix_hashes(placed: DataFrame) -> DataFrame:
    """``conv_id, pos, upto``: the hash of the turns up to each one, without their texts."""
    hashed = placed.select("conv_id", "pos", _hash().alias("h"))
    return with_running_total(hashed, ["pos"], "h", name="upto", partition_by=["conv_id"]).drop("h")


def maximal(prefixes: DataFrame) -> DataFrame:
    """``(conv_id)`` of the conversations that stay."""
    at = prefixes.groupBy("pos", "upto").agg(F.count(F.lit(1)).alias("rows"))
    whole = prefixes.groupBy("conv_id").agg(F.max(F.struct("pos", "upto")).alias("last")).select("conv_id", "last.*")
    ends = whole.groupBy("pos", "upto").agg(F.count(F.lit(1)).alias("ends"), F.min("conv_id").alias("conv_id"))
    longer = ends.join(at, ["pos", "upto"]).where(F.col("rows") > F.col("ends")).select("pos", "upto")
    return ends.join(longer, ["pos", "upto"], "left_anti").select("conv_id")


def render() -> Column:
    return F.concat(F.lit(OPEN), F.col("role"), F.lit("\n"), F.col("text"), F.lit(CLOSE), F.lit("\n"))


def chat_format(turns: DataFrame, *, max_turns: int = MAX_TURNS) -> DataFrame:
    """One row per maximal conversation and part: ``conv_id, part, n_turns, text``."""
    placed = placed_turns(turns)
    prefixes = materialize(prefix_hashes(placed), "prefixes")
    stay = maximal(prefixes).select(F.col("conv_id").alias("__stays"))
    rows = placed.join(stay, F.col("conv_id").eqNullSafe(F.col("__stays")), "left_semi")
    part = F.floor((F.col("pos") - 1) / F.lit(max_turns)).cast("long")
    told = F.sort_array(F.collect_list(F.struct("pos", render().alias("t"))))  # at most max_turns
    grouped = rows.groupBy("conv_id", part.alias("part")).agg(F.count(F.lit(1)).alias("n_turns"), told.alias("told"))
    return grouped.select("conv_id", "part", "n_turns", F.array_join(F.transform("told", lambda x: x["t"]), "").alias("text"))


ORACLE = f"""
WITH placed AS (
  SELECT conv_id, coalesce(role, '') AS role, coalesce(text, '') AS text,
         row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, coalesce(role, ''), sha256(coalesce(text, ''))) AS pos
  FROM conversations),
prefixes AS (
  SELECT *, list(role || chr(31) || text) OVER (PARTITION BY conv_id ORDER BY pos) AS upto FROM placed),
whole AS (SELECT conv_id, arg_max(upto, pos) AS all_turns, max(pos) AS n FROM prefixes GROUP BY conv_id),
stay AS (
  SELECT all_turns, min(conv_id) AS conv_id FROM whole w
  WHERE NOT EXISTS (SELECT 1 FROM prefixes p JOIN whole o ON o.conv_id IS NOT DISTINCT FROM p.conv_id
                    WHERE p.upto = w.all_turns AND o.n > p.pos)
  GROUP BY all_turns)
SELECT p.conv_id, ((p.pos - 1) // {MAX_TURNS})::BIGINT AS part, count(*) AS n_turns,
       string_agg('{OPEN}' || role || chr(10) || text || '{CLOSE}' || chr(10), '' ORDER BY pos) AS text
FROM placed p JOIN stay s ON s.conv_id IS NOT DISTINCT FROM p.conv_id
GROUP BY ALL
"""
