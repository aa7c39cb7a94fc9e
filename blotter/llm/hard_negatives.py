"""Hard negatives by an inverted multi-index.

Components become integers ``floor(256 x)``; a score is an integer inner
product.  The vectors' halves are quantised by two codebooks of ``half_cells``
centres each, fitted on about ``sample_rows`` rows; a pair of centres is a cell,
and every row stands in one, in a block of about ``block`` rows.  Each centre knows the radius of
its rows.  For an anchor, the score of a row is at most the sum over the halves
of (anchor . centre) + |anchor half| * radius, so a heap over the two sorted lists of half
bounds (the multi-sequence walk) yields the cells by falling bound.

A search has two steps.  The first visits the first cells, until they hold
``seed_rows`` rows, and gives each anchor a k-th best score.  The second goes on
along the same walk, through every cell whose bound reaches that score, and
stops there: no row of a cell behind can be among the best, so the
window is certified and the result exact.  Positives (best rows of the anchor's label)
are searched first; their scores set the windows, ``low`` to ``high`` per cent of each, in which
the best rows of other labels are searched.  Cells that lie wholly above all windows
of an anchor are passed over.

Anchors travel to the cells they ask for in groups of ``GROUP``; a task reads one block
and the groups that ask for it, one after the other.  Of rows with equal vector and label only the first
k + 1 by vec_id can be among anyone's best, so a vector that a third of all rows
share costs k + 1 rows.  The centres and the cells' sizes, at most ``half_cells``^2
rows, are all that the driver sees besides the sample.

Rows with a null vec_id, a null label, a null vector or null or non-finite
components take no part; shorter vectors count as if they ended in zeros.  Rows that repeat
a vec_id, label and vector are one row; rows of the anchor's own vec_id are not its
candidates.  Ties go to the smaller vec_id.  An anchor without positives, or whose windows are empty
(a negative positive score), has no row.  An empty table gives an empty result.
"""

from __future__ import annotations

import heapq
from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from blotter.llm.common import materialize
from blotter.llm.topk import SCALE, _exact

POSITIVES = 5
NEGATIVES = 10
LOW, HIGH = 30, 90
HALF_CELLS = 16
SAMPLE_ROWS = 20_000
SEED_ROWS = 2048
BLOCK = 512
GROUP = 512
_LEAST, _MOST = np.iinfo(np.int64).min, np.iinfo(np.int64).max


class Index(NamedTuple):
    """Bounded by ``half_cells``: centres and radii of the halves, rows per cell."""

    centres: tuple[np.ndarray, np.ndarray]
    radii: tuple[np.ndarray, np.ndarray]
    sizes: np.ndarray  # half_cells x half_cells
    dims: int
    block: int  # rows of a block, about


def usable(vectors: DataFrame) -> DataFrame:
    """``vec_id, label, v``: the rows that take part, each once."""
    finite = lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) != float("inf"))
    rows = vectors.where(F.col("vec_id").isNotNull() & F.col("label").isNotNull() & F.col("embedding").isNotNull() & F.forall("embedding", finite))
    whole = F.transform("embedding", lambda x: F.floor(x.cast("double") * F.lit(float(SCALE))))
    return rows.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("label").cast("long").alias("label"), whole.alias("v")).distinct()


def candidates(rows: DataFrame, k: int) -> DataFrame:
    """Of the rows of equal vector and label the first k + 1."""
    order = Window.partitionBy("v", "label").orderBy("vec_id")
    return rows.withColumn("at", F.row_number().over(order)).where(F.col("at") <= k + 1).drop("at")


def _matrix(column: pa.Array, dims: int) -> np.ndarray:
    """One row per vector, filled up with zeros."""
    sizes = np.diff(column.offsets.to_numpy())
    m = np.zeros((len(column), dims), dtype=np.int64)
    m[np.arange(dims)[None, :] < sizes[:, None]] = column.flatten().to_numpy(zero_copy_only=False)
    return m


def codebook(m: np.ndarray, centres: int, rounds: int = 10) -> np.ndarray:
    """Centres of ``m`` by k-means from a fixed seed; fewer if fewer rows differ."""
    rng = np.random.default_rng(0)
    m = m.astype(np.float64)
    found = m[:1].copy()
    far = ((m - found[0]) ** 2).sum(axis=1)
    while len(found) < centres and far.max(initial=0.0) > 0:
        found = np.concatenate([found, m[rng.choice(len(m), p=far / far.sum())][None]])
        far = np.minimum(far, ((m - found[-1]) ** 2).sum(axis=1))
    for _ in range(rounds):
        of = nearest(m, found)
        for c in range(len(found)):
            if (of == c).any():
                found[c] = m[of == c].mean(axis=0)
    return found


def nearest(m: np.ndarray, centres: np.ndarray) -> np.ndarray:
    return ((centres**2).sum(axis=1)[None, :] - 2 * (m.astype(np.float64) @ centres.T)).argmin(axis=1)


def fit(rows: DataFrame, half_cells: int, sample_rows: int) -> tuple[tuple[np.ndarray, np.ndarray], int]:
    """The two codebooks, on rows chosen by a hash of vec_id, and the dimensions."""
    n, dims = rows.agg(F.count(F.lit(1)), F.max(F.size("v"))).first()
    share = F.lit((1 << 63) - 1 if n <= sample_rows else (1 << 63) // n * sample_rows)
    sample = rows.where(F.xxhash64("vec_id", F.lit(1)).bitwiseAND(F.lit((1 << 63) - 1)) <= share).select("v").toArrow().column("v").combine_chunks()
    m = _matrix(sample, dims or 0) if len(sample) else np.zeros((1, dims or 0))
    half = m.shape[1] // 2
    return (codebook(m[:, :half], half_cells), codebook(m[:, half:], half_cells)), dims or 0


def _placed(centres: tuple[np.ndarray, np.ndarray], dims: int):
    """Rows with their cell and the distances of their halves to its centres."""
    half = dims // 2

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            m = _matrix(b.column("v"), dims)
            of = [nearest(x, c) for x, c in zip((m[:, :half], m[:, half:]), centres, strict=True)]
            away = [np.linalg.norm(x - c[o], axis=1) for x, c, o in zip((m[:, :half], m[:, half:]), centres, of, strict=True)]
            cell = of[0] * len(centres[1]) + of[1]
            yield pa.RecordBatch.from_arrays(
                [pa.array(cell.astype(np.int32)), b.column("vec_id"), b.column("label"), pa.array([x.tobytes() for x in m], type=pa.binary()), pa.array(away[0]), pa.array(away[1])],
                names=["cell", "vec_id", "label", "m", "away1", "away2"],
            )

    return run


_PLACED = "cell int, vec_id long, label long, m binary, away1 double, away2 double"


def _blocked(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of no and vec_id -> a row per block."""
    no, ids, labels, vectors = None, [], [], []

    def block() -> pa.RecordBatch:
        values = {"no": ([no], pa.int64()), "ids": ([ids], pa.list_(pa.int64())), "labels": ([labels], pa.list_(pa.int64())), "m": ([b"".join(vectors)], pa.binary())}
        return pa.RecordBatch.from_pydict({k: pa.array(v, type=t) for k, (v, t) in values.items()})

    for b in batches:
        for n, i, y, m in zip(*(b.column(c).to_pylist() for c in ("no", "vec_id", "label", "m")), strict=True):
            if ids and n != no:
                yield block()
                ids, labels, vectors = [], [], []
            no = n
            ids.append(i)
            labels.append(y)
            vectors.append(m)
    if ids:
        yield block()


def build(rows: DataFrame, keep: int, half_cells: int, sample_rows: int, block: int) -> tuple[Index, DataFrame]:
    """The index, and its blocks: ``no, ids, labels, m``.  The rows of a cell are dealt by
    hash to as many blocks as it needs, so ``no`` follows from cell and size."""
    centres, dims = fit(rows, half_cells, sample_rows)
    placed = materialize(candidates(rows, keep).mapInArrow(_placed(centres, dims), _PLACED), "placed")
    sizes = np.zeros((len(centres[0]), len(centres[1])), dtype=np.int64)
    radii = np.zeros(len(centres[0])), np.zeros(len(centres[1]))
    for r in placed.groupBy("cell").agg(F.count(F.lit(1)).alias("n"), F.max("away1").alias("r1"), F.max("away2").alias("r2")).collect():
        i, j = divmod(r["cell"], len(centres[1]))
        sizes[i, j] = r["n"]
        radii[0][i], radii[1][j] = max(radii[0][i], r["r1"]), max(radii[1][j], r["r2"])
    slots = F.element_at(F.array(*[F.lit(int(-(-n // block))) for n in sizes.ravel()]), F.col("cell") + 1)
    number = F.shiftleft(F.col("cell").cast("long"), 32) + F.pmod(F.xxhash64("vec_id", "label", "m"), slots)
    dealt = placed.select(number.alias("no"), "vec_id", "label", "m").repartition("no").sortWithinPartitions("no", "vec_id")
    blocks = materialize(dealt.mapInArrow(_blocked, "no long, ids array<long>, labels array<long>, m binary"), "cell-blocks")
    return Index(centres, radii, sizes, dims, block), blocks


def walk(highest: tuple[np.ndarray, np.ndarray]) -> Iterator[tuple[float, int, int]]:
    """(bound, i, j) of all pairs, by falling sum of the two half bounds."""
    first, second = (np.argsort(-h, kind="stable") for h in highest)
    a, b = highest[0][first].tolist(), highest[1][second].tolist()
    heap = [(-(a[0] + b[0]), 0, 0)] if a and b else []
    while heap:
        bound, i, j = heapq.heappop(heap)
        yield -bound, int(first[i]), int(second[j])
        if j + 1 < len(b):
            heapq.heappush(heap, (-(a[i] + b[j + 1]), i, j + 1))
        if not j and i + 1 < len(a):  # each pair enters once, from its left or from above
            heapq.heappush(heap, (-(a[i + 1] + b[0]), i + 1, 0))


def cells_of(q: np.ndarray, index: Index, reach: int, ceiling: int, seed_rows: int, again: bool) -> list[int]:
    """The cells that one anchor asks for: the first of its walk until they hold
    ``seed_rows`` rows, or, ``again``, those behind them whose bound is ``reach``
    at least.  Cells with no row at ``ceiling`` or below are passed over."""
    half = index.dims // 2
    highest, lowest = [], []
    for part, centres, radii in zip((q[:half], q[half:]), index.centres, index.radii, strict=True):
        part = part.astype(np.float64)
        at, spread = centres @ part, np.linalg.norm(part) * radii
        slack = 1e-9 * (np.abs(centres) @ np.abs(part) + spread) + 1e-3  # of rounding; scores are whole
        highest.append(at + spread + slack)
        lowest.append(at - spread - slack)
    out, seen = [], 0
    for bound, i, j in walk((highest[0], highest[1])):
        if seen >= seed_rows and (not again or bound < reach):
            break
        rows = int(index.sizes[i, j])
        if not rows or lowest[0][i] + lowest[1][j] > ceiling:
            continue
        if seen < seed_rows:
            seen += rows
            if not again:
                out.append(i * len(index.centres[1]) + j)
        else:
            out.append(i * len(index.centres[1]) + j)
    return out


def _asking(index: Index, seed_rows: int, again: bool):
    """Anchors with their windows -> a row per group and cell that some of the
    group ask for.  ``low, high, reach`` hold one number per window."""
    sizes = index.sizes.ravel()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for whole in batches:
            for at in range(0, whole.num_rows, GROUP):
                b = whole.slice(at, GROUP)
                q = np.frombuffer(b"".join(b.column("m").to_pylist()), dtype=np.int64).reshape(b.num_rows, -1)
                low, high, reach = (np.array(b.column(n).to_pylist(), dtype=np.int64).reshape(b.num_rows, -1) for n in ("low", "high", "reach"))
                asked: dict[int, list[int]] = {}
                for i in range(b.num_rows):
                    open_ = low[i] <= high[i]
                    if open_.any():
                        for c in cells_of(q[i], index, int(np.maximum(low[i], reach[i])[open_].min()), int(high[i][open_].max()), seed_rows, again):
                            asked.setdefault(c, []).append(i)
                for c, own in sorted(asked.items()):
                    rows = pa.array(own)
                    values = {
                        "cell": pa.array([c], type=pa.int64()),
                        "slots": pa.array([-(-int(sizes[c]) // index.block)], type=pa.int64()),
                        **{n: pa.array([b.column(n).take(rows).to_pylist()], type=pa.list_(pa.int64())) for n in ("aid", "vec_id", "label")},
                        "q": pa.array([q[own].tobytes()], type=pa.binary()),
                        "windows": pa.array([np.stack([low[own], high[own], reach[own]]).tobytes()], type=pa.binary()),
                    }
                    yield pa.RecordBatch.from_pydict(values)

    return run


_ASKED = "cell long, slots long, aid array<long>, vec_id array<long>, label array<long>, q binary, windows binary"


def best(found: np.ndarray, ids: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """(row, column) of the k best entries of each row of ``found``, those of
    the least long left out; ties to the smaller of ``ids``, which rise."""
    row, column = np.nonzero(found != _LEAST)
    order = np.lexsort((ids[column], -found[row, column], row))
    row, column = row[order], column[order]
    first = np.searchsorted(row, row, side="left")
    near = np.arange(len(row)) - first < k
    return row[near], column[near]


def _visiting(k: int, same_label: bool):
    """A block, then the groups that ask for it -> the k best rows of the block in
    each window of each anchor."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        no, ids, labels, m = None, None, None, None
        for b in batches:
            for i in range(b.num_rows):
                r = {n: b.column(n)[i].as_py() for n in ("no", "asked", "ids", "labels", "m")}
                if not r["asked"]:
                    no, ids, labels = r["no"], np.array(r["ids"], dtype=np.int64), np.array(r["labels"], dtype=np.int64)
                    m = np.frombuffer(r["m"], dtype=np.int64).reshape(len(ids), -1)
                    continue
                if r["no"] != no:
                    continue
                own, own_labels = np.array(r["ids"], dtype=np.int64), np.array(r["labels"], dtype=np.int64)
                aids = np.array(b.column("aid")[i].as_py(), dtype=np.int64)
                windows = np.frombuffer(b.column("windows")[i].as_py(), dtype=np.int64).reshape(3, len(own), -1)
                scores = _exact(np.frombuffer(r["m"], dtype=np.int64).reshape(len(own), -1), m)
                fits = (own_labels[:, None] == labels[None, :]) == same_label
                fits &= own[:, None] != ids[None, :]
                for w in range(windows.shape[2]):
                    low, high, reach = windows[:, :, w]
                    inside = fits & (scores >= np.maximum(low, reach)[:, None]) & (scores <= high[:, None])
                    row, column = best(np.where(inside, scores, _LEAST), ids, k)
                    if len(row):
                        values = (aids[row], np.full(len(row), w), ids[column], scores[row, column])
                        yield pa.RecordBatch.from_arrays([pa.array(v, type=pa.int64()) for v in values], names=["aid", "w", "id", "score"])

    return run


_FOUND = "aid long, w long, id long, score long"


def _top(found: DataFrame, k: int) -> DataFrame:
    order = Window.partitionBy("aid", "w").orderBy(F.col("score").desc(), F.col("id"))
    return found.withColumn("rank", F.row_number().over(order)).where(F.col("rank") <= k)


def _visit(anchors: DataFrame, index: Index, blocks: DataFrame, k: int, same_label: bool, seed_rows: int, again: bool) -> DataFrame:
    asked = anchors.mapInArrow(_asking(index, seed_rows, again), _ASKED)
    none = F.lit(None)
    slot = F.explode(F.sequence(F.lit(0).cast("long"), F.col("slots") - 1))
    asked = asked.select("*", slot.alias("slot")).select((F.shiftleft("cell", 32) + F.col("slot")).alias("no"), F.lit(True).alias("asked"), F.col("vec_id").alias("ids"), F.col("label").alias("labels"), F.col("q").alias("m"), "aid", "windows")
    own = blocks.select("no", F.lit(False).alias("asked"), "ids", "labels", "m", none.cast("array<long>").alias("aid"), none.cast("binary").alias("windows"))
    return own.unionByName(asked).repartition("no").sortWithinPartitions("no", "asked").mapInArrow(_visiting(k, same_label), _FOUND)


def search(anchors: DataFrame, index: Index, blocks: DataFrame, k: int, same_label: bool, seed_rows: int, name: str) -> DataFrame:
    """``aid, w, id, score, rank``: for each anchor and window (arrays ``low, high``)
    the k best rows inside."""
    nothing = F.transform("low", lambda _: F.lit(_LEAST))
    first = materialize(_top(_visit(anchors.withColumn("reach", nothing), index, blocks, k, same_label, seed_rows, False), k), f"{name}-first")
    # the k-th best so far of each window: nothing below it can be among the best
    reached = first.where(F.col("rank") == k).groupBy("aid").agg(F.map_from_entries(F.collect_list(F.struct("w", "score"))).alias("__reach")).withColumnRenamed("aid", "__aid")
    known = anchors.join(reached, F.col("aid") == F.col("__aid"), "left")
    reach = F.transform("low", lambda _, w: F.coalesce(F.try_element_at("__reach", w.cast("long")), F.lit(_LEAST)))
    rest = _visit(known.withColumn("reach", reach).drop("__reach", "__aid"), index, blocks, k, same_label, seed_rows, True)
    return materialize(_top(first.drop("rank").unionByName(rest), k), f"{name}-best")


def hard_negatives(
    vectors: DataFrame,
    is_anchor: Column,
    *,
    positives: int = POSITIVES,
    negatives: int = NEGATIVES,
    low: int = LOW,
    high: int = HIGH,
    half_cells: int = HALF_CELLS,
    sample_rows: int = SAMPLE_ROWS,
    seed_rows: int = SEED_ROWS,
    block: int = BLOCK,
) -> DataFrame:
    """``anchor_id, positive_id, rank, negative_id, positive_score, negative_score``:
    for each anchor and each of its ``positives`` best rows of its label the
    ``negatives`` best rows of other labels that score from ``low`` to ``high`` per
    cent of the positive."""
    rows = materialize(usable(vectors), "usable")
    index, blocks = build(rows, max(positives, negatives), half_cells, sample_rows, block)
    placed = rows.where(is_anchor).mapInArrow(_placed(index.centres, index.dims), _PLACED)
    # anchors of one cell ask for the same cells
    near = placed.repartitionByRange("cell", "vec_id").sortWithinPartitions("cell", "vec_id").select(F.monotonically_increasing_id().alias("aid"), "vec_id", "label", "m")
    anchors = materialize(near, "anchors")
    all_scores = anchors.select("*", F.array(F.lit(_LEAST + 1)).alias("low"), F.array(F.lit(_MOST)).alias("high"))
    positive = search(all_scores, index, blocks, positives, True, seed_rows, "positives")
    listed = positive.groupBy(F.col("aid").alias("__aid")).agg(F.array_sort(F.collect_list(F.struct("rank", "id", "score"))).alias("p"))
    # whole numbers from low to high per cent of the score, held to the range of a long
    edge = lambda per_cent: lambda p: F.greatest(F.least(per_cent(p["score"].cast("decimal(38,0)")), F.lit(_MOST).cast("decimal(38,0)")), F.lit(_LEAST + 1).cast("decimal(38,0)")).cast("long")
    lows = F.transform("p", edge(lambda s: F.ceil(s * F.lit(low) / F.lit(100))))
    highs = F.transform("p", edge(lambda s: F.floor(s * F.lit(high) / F.lit(100))))
    windowed = anchors.join(listed, F.col("aid") == F.col("__aid")).select("aid", "vec_id", "label", "m", lows.alias("low"), highs.alias("high"))
    negative = search(windowed, index, blocks, negatives, False, seed_rows, "negatives")
    of = positive.select(F.col("aid").alias("__aid"), (F.col("rank") - 1).cast("long").alias("__w"), F.col("id").alias("positive_id"), F.col("score").alias("positive_score"))
    named = anchors.select(F.col("aid").alias("__id"), F.col("vec_id").alias("anchor_id"))
    joined = negative.join(of, (F.col("aid") == F.col("__aid")) & (F.col("w") == F.col("__w"))).join(named, F.col("aid") == F.col("__id"))
    return joined.select("anchor_id", "positive_id", "rank", F.col("id").alias("negative_id"), "positive_score", F.col("score").alias("negative_score"))


ORACLE = f"""
WITH v AS (
  SELECT DISTINCT vec_id, CASE WHEN vec_id % 7 = 0 THEN (label + 1) % 10 ELSE label END AS label,
    [floor({SCALE} * x::DOUBLE)::BIGINT FOR x IN embedding] AS v
  FROM embeddings
  WHERE vec_id IS NOT NULL AND label IS NOT NULL AND embedding IS NOT NULL
    AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
scored AS (
  SELECT a.vec_id AS anchor_id, c.vec_id, a.label = c.label AS same,
    coalesce(list_sum([z[1] * z[2] FOR z IN list_zip(a.v, c.v)]), 0)::BIGINT AS score
  FROM v a JOIN v c ON a.vec_id % 100 = 0 AND a.vec_id <> c.vec_id),
positive AS (
  SELECT anchor_id, vec_id AS positive_id, score AS positive_score FROM scored WHERE same
  QUALIFY row_number() OVER (PARTITION BY anchor_id ORDER BY score DESC, vec_id) <= {POSITIVES}),
negative AS (
  SELECT p.anchor_id, p.positive_id, s.vec_id AS negative_id, p.positive_score, s.score AS negative_score,
    row_number() OVER (PARTITION BY p.anchor_id, p.positive_id ORDER BY s.score DESC, s.vec_id)::INT AS rank
  FROM positive p JOIN scored s ON s.anchor_id = p.anchor_id AND NOT s.same
    AND {LOW} * p.positive_score <= 100 * s.score AND 100 * s.score <= {HIGH} * p.positive_score)
SELECT anchor_id, positive_id, rank, negative_id, positive_score, negative_score FROM negative WHERE rank <= {NEGATIVES}
"""
