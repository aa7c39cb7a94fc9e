"""Exact top-k search by block-at-a-time pruning.

Components become integers ``floor(256 x)``; every dimension is a term.  The
collection is laid out in ranges of vec_id and cut into blocks of ``block``
vectors; a block keeps its forward index (ids and vectors) and the largest and
smallest value of each term.  For a query the bound of a block is the sum over
terms of the larger product of the query's value with the two; blocks are
scored through their forward index in the order of their bounds until a
bound falls below the query's k-th score so far.  A block whose bound equals it is
scored, as ties go to smaller ids.

No query meets all vectors.  Three steps decide which blocks it meets:

1. The summaries of the blocks (largest and smallest values), ``SUMMARY`` tiles of ``tile`` neighbouring blocks to a
   task, give each query the block with the highest bound, of those with more than k rows.
2. The query is scored against that block; its k-th score there is its floor.  A block that many queries
   start from is repeated once for every ``group`` of them.
3. The summaries are read again: a query travels to a tile only if the bound of one of its blocks reaches
   the floor.  Inside the tile the blocks are scored in the order of their bounds.

The k best of every tile are merged per query.  How many tiles a query reaches depends on the vectors: few where neighbouring ids
are alike, all where nothing tells blocks apart.  Nothing is broadcast or collected.

Vectors that are null or hold null or non-finite components take no part, nor
do rows without vec_id; shorter vectors count as if they ended in zeros.  Each
distinct (vec_id, vector) of the query set is a query; rows with its vec_id are
not its candidates.  Repeated candidate rows count each.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.llm.common import materialize

SCALE = 256
K = 5
BLOCK = 256
TILE = 16
GROUP = 2048
SUMMARY = 512
# Queries that a task bounds at once.
SLICE = 256
_LEAST = np.iinfo(np.int64).min


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, v``: integer components of the vectors that take part."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", finite))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(float(SCALE)))).alias("v"))


def _packed(size: int):
    """Rows in the order they come, ``size`` to a block."""

    def pack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        ids, vectors = [], []
        for b in batches:
            ids += b.column("vec_id").to_pylist()
            vectors += b.column("v").to_pylist()
            while len(ids) >= size:
                yield _block(ids[:size], vectors[:size])
                ids, vectors = ids[size:], vectors[size:]
        if ids:
            yield _block(ids, vectors)

    return pack


def _block(ids: list[int], vectors: list[list[int]]) -> pa.RecordBatch:
    dims = max(map(len, vectors))
    m = np.zeros((len(ids), dims), dtype=np.int64)
    for i, v in enumerate(vectors):
        m[i, : len(v)] = v
    return pa.RecordBatch.from_pydict(
        {
            "ids": pa.array([ids], type=pa.list_(pa.int64())),
            "dims": pa.array([dims], type=pa.int32()),
            "m": pa.array([m.ravel()], type=pa.list_(pa.int64())),
            "most": pa.array([m.max(axis=0)], type=pa.list_(pa.int64())),
            "least": pa.array([m.min(axis=0)], type=pa.list_(pa.int64())),
        }
    )


_BLOCKS = "ids array<long>, dims int, m array<long>, most array<long>, least array<long>"


def blocks(rows: DataFrame, size: int, name: str) -> DataFrame:
    """The rows as blocks of neighbouring ids, written, with a number each."""
    laid = rows.repartitionByRange("vec_id", F.xxhash64("v")).sortWithinPartitions("vec_id", F.xxhash64("v"))
    packed = laid.mapInArrow(_packed(size), _BLOCKS)
    return materialize(packed.withColumn("no", F.monotonically_increasing_id()), name)


def _exact(a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """a @ b.T in whole numbers: in double precision while every sum stays below
    2^53, else in Python's integers, held to the range of a long."""
    if not a.shape[1]:
        return np.zeros((len(a), len(b)), dtype=np.int64)
    if float(np.abs(a.astype(np.float64)).max(initial=0)) * float(np.abs(b.astype(np.float64)).max(initial=0)) * a.shape[1] < 2.0**53:
        return (a.astype(np.float64) @ b.astype(np.float64).T).astype(np.int64)
    whole = a.astype(object) @ b.astype(object).T
    return np.clip(whole, _LEAST + 1, np.iinfo(np.int64).max).astype(np.int64)


def _wide(flat: np.ndarray, rows: int, dims: int) -> np.ndarray:
    """The rows cut or filled up with zeros to ``dims``."""
    m = np.zeros((rows, dims), dtype=np.int64)
    if flat.size:
        own = flat.reshape(rows, -1)[:, :dims]
        m[:, : own.shape[1]] = own
    return m


def bounds(q: np.ndarray, most: np.ndarray, least: np.ndarray) -> np.ndarray:
    """At most this is the score of a query (row) in a block (column)."""
    return _exact(np.concatenate([np.maximum(q, 0), np.minimum(q, 0)], axis=1), np.concatenate([most, least], axis=1))


def search(q_ids: np.ndarray, q: np.ndarray, tile: list[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]], k: int, floor: np.ndarray | int = _LEAST) -> tuple[np.ndarray, np.ndarray, int]:
    """(ids, scores) of the k best of a tile for each query, and how many
    (query, block) pairs were scored.  A score of the smallest long: no candidate.
    Blocks whose bound is below the query's ``floor`` are left out."""
    reach = bounds(q, np.stack([x[2] for x in tile]), np.stack([x[3] for x in tile]))
    order = np.argsort(-reach, axis=1, kind="stable")
    floor = np.broadcast_to(floor, len(q))
    best = np.full((len(q), k), _LEAST, dtype=np.int64)
    best_ids = np.full((len(q), k), np.iinfo(np.int64).max, dtype=np.int64)
    active, scored = np.arange(len(q)), 0
    for step in range(len(tile)):
        block_of = order[active, step]
        active = active[reach[active, block_of] >= np.maximum(best[active, -1], floor[active])]
        if not len(active):
            break
        block_of = order[active, step]
        for which in np.unique(block_of):
            rows = active[block_of == which]
            ids, m, _, _ = tile[which]
            scored += len(rows)
            s = _exact(q[rows], m)
            s[q_ids[rows][:, None] == ids[None, :]] = _LEAST
            better = s.max(axis=1) >= best[rows, -1]
            rows, s = rows[better], s[better]
            if not len(rows):
                continue
            s = np.concatenate([best[rows], s], axis=1)
            i = np.concatenate([best_ids[rows], np.broadcast_to(ids, (len(rows), len(ids)))], axis=1)
            top = np.lexsort((i, -np.maximum(s, _LEAST + 1)), axis=1)[:, :k]
            best[rows] = np.take_along_axis(s, top, axis=1)
            best_ids[rows] = np.take_along_axis(i, top, axis=1)
    return best_ids, best, scored


_ROW = {"part": "long", "salt": "int", "query": "boolean", "no": "long", "n": "int", "i": "array<int>", "ids": "array<long>", "dims": "int", "m": "array<long>", "most": "array<long>", "least": "array<long>", "floors": "array<long>"}


def _row(rows: DataFrame, **columns: Column) -> DataFrame:
    """Blocks and queries as rows of one schema, so that a task reads both."""
    names = set(rows.columns)
    empty = {c: F.lit(0) if not t.startswith("array") else F.array() for c, t in _ROW.items()}
    return rows.select(*[columns.get(c, F.col(c) if c in names else empty[c]).cast(t).alias(c) for c, t in _ROW.items()])


def _together(found: DataFrame, queries: DataFrame, run, schema: str) -> DataFrame:
    both = found.unionByName(queries).repartition("part", "salt").sortWithinPartitions("part", "salt", "query", "no")
    return both.mapInArrow(run, schema)


def _values(column: pa.Array) -> list:
    if not pa.types.is_list(column.type):
        return column.to_numpy(zero_copy_only=False).tolist()
    at, flat = column.offsets.to_numpy(), column.values.to_numpy(zero_copy_only=False)
    return [flat[a:b] for a, b in zip(at[:-1], at[1:], strict=True)]


def _asked(batches: Iterator[pa.RecordBatch], prepare: Callable) -> Iterator[tuple]:
    """Rows of one part follow each other, first its blocks, then the queries:
    the prepared blocks with every row of queries."""
    key, blocks, ready = None, [], None
    for b in batches:
        for values in zip(*map(_values, b.columns), strict=True):
            r = dict(zip(b.schema.names, values, strict=True))
            if (r["part"], r["salt"]) != key:
                key, blocks, ready = (r["part"], r["salt"]), [], None
            if not r["query"]:
                blocks.append(r)
            elif blocks:
                ready = ready or prepare(blocks)
                yield ready, r


def _summary(blocks: list[dict]) -> tuple:
    dims = max(r["dims"] for r in blocks)
    most, least = (np.concatenate([_wide(r[c], 1, dims) for r in blocks]) for c in ("most", "least"))
    return dims, np.array([r["no"] for r in blocks]), np.array([r["n"] for r in blocks]), most, least


def _forward(blocks: list[dict]) -> tuple:
    dims = max(r["dims"] for r in blocks)
    return dims, [(r["ids"], _wide(r["m"], len(r["ids"]), dims), _wide(r["most"], 1, dims)[0], _wide(r["least"], 1, dims)[0]) for r in blocks]


def _lists(arrays: list[np.ndarray], kind: pa.DataType = pa.int64()) -> pa.Array:  # noqa: B008
    return pa.array(arrays, type=pa.list_(kind))


def _first_blocks(k: int):
    """Step 1: the best block of each query, of those of one task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (dims, no, n, most, least), r in _asked(batches, _summary):
            q, large = _wide(r["m"], len(r["ids"]), dims), n > k
            own = r["m"].reshape(len(q), -1)
            if not large.any():
                continue
            for a in range(0, len(q), SLICE):
                reach = bounds(q[a : a + SLICE], most[large], least[large])
                at = reach.argmax(axis=1)
                columns = (np.full(len(at), r["no"]), np.arange(a, a + len(at)), r["ids"][a : a + len(at)], reach.max(axis=1), no[large][at])
                yield pa.RecordBatch.from_arrays([*[pa.array(c, type=pa.int64()) for c in columns], _lists(list(own[a : a + len(at)]))], names=["g", "i", "query_id", "bound", "block", "v"])

    return run


def _floors(k: int):
    """Step 2: the k-th score of each query in its first block."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (dims, tile), r in _asked(batches, _forward):
            ids, m, _, _ = tile[0]
            scores = _exact(_wide(r["m"], 1, dims), m)[0][ids != r["ids"][0]]
            if len(scores) >= k:
                yield pa.RecordBatch.from_pydict({"g": pa.array([r["no"]]), "i": pa.array(r["i"][:1], type=pa.int32()), "floor": pa.array([np.partition(scores, -k)[-k]])})

    return run


def _reached(tile: int):
    """Step 3: the queries for each tile that one of its blocks may serve."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (dims, no, _, most, least), r in _asked(batches, _summary):
            q = _wide(r["m"], len(r["ids"]), dims)
            own = r["m"].reshape(len(q), -1)
            floor = np.full(len(q), _LEAST, dtype=np.int64)
            floor[r["i"]] = r["floors"]
            tiles, starts = np.unique(no // tile, return_index=True)
            for a in range(0, len(q), SLICE):
                best = np.maximum.reduceat(bounds(q[a : a + SLICE], most, least), starts, axis=1)
                for t in range(len(tiles)):
                    at = a + np.flatnonzero(best[:, t] >= floor[a : a + SLICE])
                    if len(at):
                        lists = [_lists([x]) for x in (r["ids"][at], own[at].ravel(), floor[at])]
                        yield pa.RecordBatch.from_arrays(
                            [pa.array([tiles[t]]), pa.array([r["no"]]), _lists([at], pa.int32()), lists[0], pa.array([r["dims"]], type=pa.int32()), *lists[1:]],
                            names=["part", "no", "i", "ids", "dims", "m", "floors"],
                        )

    return run


def _search(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for (dims, tile), r in _asked(batches, _forward):
            ids = r["ids"]
            found, scores, _ = search(ids, _wide(r["m"], len(ids), dims), tile, k, r["floors"])
            at, rank = np.nonzero(scores != _LEAST)
            columns = (np.full(len(at), r["no"]), r["i"][at], ids[at], found[at, rank], scores[at, rank])
            yield pa.RecordBatch.from_arrays([pa.array(c, type=pa.int64()) for c in columns], names=["g", "i", "query_id", "vec_id", "score"])

    return run


def reached(rows: DataFrame, is_query: Column, *, k: int = K, block: int = BLOCK, tile: int = TILE, group: int = GROUP) -> tuple[DataFrame, DataFrame]:
    """The blocks, and for each tile (``part``) rows of the queries that may find something in it."""
    index = blocks(rows, block, "forward-index").withColumn("tile", F.floor(F.col("no") / F.lit(tile)))
    queries = blocks(rows.where(is_query).distinct(), group, "queries")
    parts = max(1, -(-index.agg(F.count_distinct("tile")).first()[0] // SUMMARY))
    summaries = _row(index.drop("m"), part=F.pmod(F.xxhash64("tile"), F.lit(parts)), n=F.size("ids"), ids=F.array(), query=F.lit(False))
    everywhere = F.explode(F.sequence(F.lit(0), F.lit(parts - 1)))

    def asking(groups: DataFrame) -> DataFrame:
        return _row(groups.drop("most", "least").withColumn("part", everywhere), query=F.lit(True))

    first = _together(summaries, asking(queries), _first_blocks(k), "g long, i long, query_id long, bound long, block long, v array<long>")
    start = F.max(F.struct("bound", "block", "query_id", "v")).alias("s")
    starts = materialize(first.groupBy("g", "i").agg(start).select("g", "i", "s.block", "s.query_id", "s.v"), "first-blocks")
    wanted = starts.groupBy("block").agg(F.ceil(F.count(F.lit(1)) / F.lit(group)).cast("int").alias("copies"))
    copies = index.join(wanted, F.col("no") == F.col("block")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.col("copies") - 1)))
    lone = starts.join(wanted, "block").withColumn("salt", F.pmod(F.xxhash64("g", "i"), F.col("copies")))
    seeds = _row(lone, part=F.col("block"), query=F.lit(True), no=F.col("g"), i=F.array("i"), ids=F.array("query_id"), dims=F.size("v"), m=F.col("v"))
    floors = _together(_row(copies, part=F.col("no"), query=F.lit(False)), seeds, _floors(k), "g long, i int, floor long")
    listed = floors.groupBy("g").agg(F.sort_array(F.collect_list(F.struct("i", "floor"))).alias("l")).select("g", "l.i", F.col("l.floor").alias("floors"))
    known = queries.join(listed, F.col("no") == F.col("g"), "left").withColumns({c: F.coalesce(c, F.array().cast(t)) for c, t in (("i", "array<int>"), ("floors", "array<long>"))})
    schema = "part long, no long, i array<int>, ids array<long>, dims int, m array<long>, floors array<long>"
    return index, _together(summaries, asking(known), _reached(tile), schema)


def top_k(vectors: DataFrame, is_query: Column, *, k: int = K, block: int = BLOCK, tile: int = TILE, group: int = GROUP) -> DataFrame:
    """``query_id, rank, vec_id, score``: the k best candidates of each query row."""
    index, asking = reached(usable(vectors), is_query, k=k, block=block, tile=tile, group=group)
    found = _together(_row(index, part=F.col("tile"), query=F.lit(False)), _row(asking, query=F.lit(True)), _search(k), "g long, i long, query_id long, vec_id long, score long")
    per_query = Window.partitionBy("g", "i").orderBy(F.col("score").desc(), F.col("vec_id"))
    return found.withColumn("rank", F.row_number().over(per_query)).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


ORACLE = f"""
WITH v AS (
  SELECT vec_id, [floor({SCALE} * x::DOUBLE)::BIGINT FOR x IN embedding] AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT q.vec_id AS query_id, c.vec_id, list_sum([z[1] * z[2] FOR z IN list_zip(q.v, c.v)])::BIGINT AS score
  FROM v q JOIN v c ON q.vec_id % 50 = 0 AND q.vec_id <> c.vec_id),
ranked AS (SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS r FROM scored)
SELECT query_id, r::INT AS rank, vec_id, score FROM ranked WHERE r <= {K}
"""
