"""Conflict-constrained best-fit packing.

Documents are cut into pieces of at most ``capacity`` words and packed into
bins of ``capacity`` words.  A bin holds at most one piece of a source and at
most one of a duplicate cluster (texts that are equal but for case and blanks).
Open bins stand in the order of their free space and carry two bitmaps, of the
sources and of the clusters inside.  A piece, largest first, looks up the
first bin with enough space and goes on to the next larger space until the
bitmaps agree: the tightest compatible bin.  If there is none, a bin is opened.

Pieces are dealt by a hash of their row to groups of about ``group_pieces``,
and each group is packed by one task, so neither a large source nor a large
cluster gathers in a task, and memory is bounded by the group.

Null sources are unknown: they conflict with nothing.  Documents without words
take no space and stand in no bin (``bin_id`` null).  Repeated rows are packed
each; being one cluster they never share a bin.  Very long texts become many
pieces, dealt to many groups.  Null doc_ids come last among pieces of one size, and ids of any
type pass unchanged.  An empty table gives an empty result.
"""

from __future__ import annotations

import re
from bisect import bisect_left, insort
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import WORD, whole_text, word_count

CAPACITY = 2048
GROUP_PIECES = 2048
_WORD = re.compile(WORD)


def best_fit(sizes: list[int], sources: list, clusters: list, capacity: int) -> list[int]:
    """The bin of each item, items in the order given.  Items of one source (not
    None) or of one cluster never share a bin."""
    source_bit = {s: 1 << i for i, s in enumerate(dict.fromkeys(s for s in sources if s is not None))}
    shared = [c for c, n in Counter(clusters).items() if n > 1]  # a cluster met once conflicts with nothing
    cluster_bit = {c: 1 << i for i, c in enumerate(shared)}
    open_bins: list[tuple[int, int]] = []  # (free space, bin), ascending
    in_sources: list[int] = []
    in_clusters: list[int] = []
    placed = []
    for size, source, cluster in zip(sizes, sources, clusters, strict=True):
        s, c = source_bit.get(source, 0), cluster_bit.get(cluster, 0)
        at = bisect_left(open_bins, (size, -1))
        while at < len(open_bins) and (in_sources[open_bins[at][1]] & s or in_clusters[open_bins[at][1]] & c):
            at += 1
        if at < len(open_bins):
            free, where = open_bins.pop(at)
        else:
            free, where = capacity, len(in_sources)
            in_sources.append(0)
            in_clusters.append(0)
        in_sources[where] |= s
        in_clusters[where] |= c
        if free > size:
            insort(open_bins, (free - size, where))
        placed.append(where)
    return placed


def _cutter(capacity: int, with_text: bool):
    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            row, cluster, piece, start, n, part = [], [], [], [], [], []
            for i, text in enumerate(b.column("__text").to_pylist()):
                words = text.encode("utf-8", "replace").lower().split()  # ASCII blanks only, as in WORD
                own = xxhash.xxh3_64_intdigest(b" ".join(words)) - (1 << 63)
                whole = len(words) <= capacity
                spans = [] if whole or not with_text else [m.span() for m in _WORD.finditer(text)]
                for k, at in enumerate(range(0, max(len(words), 1), capacity)):
                    row.append(i)
                    cluster.append(own)
                    piece.append(k)
                    start.append(at)
                    n.append(min(capacity, len(words) - at))
                    if with_text:
                        part.append(text if whole else text[spans[at][0] : spans[min(at + capacity, len(spans)) - 1][1]])
            taken = pa.array(row, type=pa.int64())
            columns = {
                "doc_id": b.column("doc_id").take(taken),
                "source": b.column("source").take(taken),
                "__row": b.column("__row").take(taken),
                "__cluster": pa.array(cluster, type=pa.int64()),
                "piece": pa.array(piece, type=pa.int32()),
                "start_word": pa.array(start, type=pa.int64()),
                "n_words": pa.array(n, type=pa.int32()),
            }
            if with_text:
                columns["text"] = pa.array(part, type=pa.string())
            yield pa.RecordBatch.from_pydict(columns)

    return cut


def pieces(docs: DataFrame, capacity: int, with_text: bool) -> DataFrame:
    rows = docs.select("doc_id", F.col("source").cast("string").alias("source"), F.monotonically_increasing_id().alias("__row"), F.coalesce("text", F.lit("")).alias("__text"))
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, source string, __row long, __cluster long, piece int, start_word long, n_words int"
    return rows.mapInArrow(_cutter(capacity, with_text), schema + ", text string" * with_text)


def _piece_count(capacity: int) -> Column:
    return F.greatest(F.lit(1).cast("long"), F.ceil(word_count(whole_text()) / F.lit(capacity)))


def pack(docs: DataFrame, *, capacity: int = CAPACITY, group_pieces: int = GROUP_PIECES, with_text: bool = False) -> DataFrame:
    """One row per piece: ``doc_id, bin_id, position`` (in the bin, from 0),
    ``bin_offset`` (words before it), ``bin_words``, ``piece, start_word,
    n_words``, and the text of the piece if asked for."""
    count = docs.select(F.sum(_piece_count(capacity))).first()[0] or 0
    groups = max(1, -(-count // group_pieces))
    dealt = pieces(docs, capacity, with_text).withColumn("__group", F.pmod(F.xxhash64("__row", "piece"), F.lit(groups)))

    def pack_group(rows: pa.Table) -> pa.Table:
        rows = rows.sort_by([("n_words", "descending"), ("doc_id", "ascending"), ("piece", "ascending"), ("__cluster", "ascending"), ("__row", "ascending")])
        sizes = rows.column("n_words").to_pylist()
        full = sum(n > 0 for n in sizes)  # the empty ones stand last, in no bin
        bins = best_fit(sizes[:full], rows.column("source").to_pylist()[:full], rows.column("__cluster").to_pylist()[:full], capacity)
        offsets, positions, used = [], [], Counter()
        members: Counter = Counter()
        for size, where in zip(sizes, bins):  # noqa: B905 - bins end with the full pieces
            offsets.append(used[where])
            positions.append(members[where])
            used[where] += size
            members[where] += 1
        first = (rows.column("__group")[0].as_py() if len(sizes) else 0) << 32
        none = [None] * (len(sizes) - full)
        found = {
            "bin_id": pa.array([first + b for b in bins] + none, type=pa.int64()),
            "position": pa.array(positions + none, type=pa.int32()),
            "bin_offset": pa.array(offsets + none, type=pa.int32()),
            "bin_words": pa.array([used[b] for b in bins] + none, type=pa.int32()),
        }
        return pa.table({c: found[c] if c in found else rows.column(c) for c in columns})

    columns = ["doc_id", "bin_id", "position", "bin_offset", "bin_words", "piece", "start_word", "n_words"] + ["text"] * with_text
    schema = f"doc_id {docs.schema['doc_id'].dataType.simpleString()}, bin_id long, position int, bin_offset int, bin_words int, piece int, start_word long, n_words int"
    return dealt.groupBy("__group").applyInArrow(pack_group, schema + ", text string" * with_text)
