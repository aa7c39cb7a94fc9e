"""MinHash near-dedup with HyperMinHash registers.

A document's set is its distinct five-word shingles as 64-bit hashes (A-Z in
lower case; fewer words: the whole sequence is one shingle).  The hashes fall
into 128 buckets by their first bits; a bucket stores of its smallest hash only
the number of leading zeros (6 bits) and the 10 mantissa bits after them.  An
empty bucket borrows from the first filled one in an order of its own.  Four
neighbouring registers are one 64-bit band; the 32 bands of a document are
compared as they stand.

1. Documents with equal sets are collapsed to the smallest id.
2. Documents that share a band meet in a bucket.  Every bucket names one
   centre, the member that meets most others over all bands, and pairs it with
   its other members: a bucket of m documents gives m - 1 pairs, never all of
   them.
3. A pair goes on when the sizes of the sets allow the similarity and the
   Jaccard estimate from the registers, corrected for accidental register
   collisions, reaches ``ESTIMATE_FLOOR`` (six standard deviations below the
   threshold, when all registers are filled); then the full sets decide.  A set
   of fewer than ``BUCKETS`` shingles leaves many buckets empty, so its
   estimates spread wider: such pairs go on without an estimate.
4. Components are formed, and buckets whose members are all in one component
   are done.  In the buckets left over, members that are not connected yet are
   compared in the same way inside tasks, with their registers and full sets at
   hand, in blocks of at most ``BLOCK`` members a side; a bucket emits
   only links that connect two of its components.  So every pair that shares a
   band is tested or connected otherwise.

A pair at the threshold 0.75 shares none of the 32 bands with probability
(1 - 0.75^4)^32, about 5 in a million; above it with less.

Documents without words have the empty set and are linked with nothing, like
documents with a null id.  Rows that repeat a doc_id are one document that has
the links of all its rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import materialize
from blotter.llm.components import components

SHINGLE = 5
PERCENT = 75
BUCKET_BITS = 7
BUCKETS = 1 << BUCKET_BITS
MANTISSA_BITS = 10
ROWS_PER_BAND = 4
BANDS = BUCKETS // ROWS_PER_BAND
ESTIMATE_FLOOR = 0.5
BLOCK = 2048
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F], dtype=np.uint64)
_MIX = np.array([0xFF51AFD7ED558CCD, 0xC4CEB9FE1A85EC53], dtype=np.uint64)
_MOST_WORDS = 1 << 16
#: for each bucket the order in which it looks for a filled one
_LOOK = np.argsort(np.random.default_rng(5).random((BUCKETS, BUCKETS)), axis=1)


class _WordHash(dict):
    """Hash of a word, remembered; emptied when it holds too many words."""

    def __missing__(self, word: bytes) -> int:
        if len(self) >= _MOST_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def _mixed(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(33))) * _MIX[0]
    x = (x ^ (x >> np.uint64(33))) * _MIX[1]
    return x ^ (x >> np.uint64(33))


def shingles(text: str | None, words: _WordHash) -> np.ndarray:
    """Sorted distinct 64-bit hashes of the shingles.  bytes.lower and
    bytes.split know A-Z and the six ASCII blanks only, as asked for."""
    found = (text or "").encode("utf-8", "replace").lower().split()
    h = np.fromiter(map(words.__getitem__, found), dtype=np.uint64, count=len(found))
    n = len(h)
    if n == 0:
        return h
    if n < SHINGLE:
        return _mixed((h * _ODD[:n]).sum(keepdims=True, dtype=np.uint64) + np.uint64(n))
    total = h[: n - SHINGLE + 1] * _ODD[0]
    for j in range(1, SHINGLE):
        total += h[j : n - SHINGLE + 1 + j] * _ODD[j]
    return np.unique(_mixed(total))


def registers(hashes: np.ndarray) -> np.ndarray:
    """The 128 compressed registers (uint16) of a non-empty sorted set."""
    shift = np.uint64(64 - BUCKET_BITS)
    first = np.searchsorted(hashes, np.arange(BUCKETS, dtype=np.uint64) << shift)
    least = hashes[np.minimum(first, len(hashes) - 1)]
    filled = (first < len(hashes)) & ((least >> shift) == np.arange(BUCKETS, dtype=np.uint64))
    rest = ((least << np.uint64(BUCKET_BITS)) >> np.uint64(11)).astype(np.float64)  # 53 bits, exact
    mantissa, exponent = np.frexp(rest)
    zeros = np.clip(53 - exponent, 0, 63).astype(np.uint16)
    digits = np.maximum((mantissa * 2.0 - 1.0) * (1 << MANTISSA_BITS), 0.0).astype(np.uint16)
    out = (zeros << np.uint16(MANTISSA_BITS)) | digits
    if not filled.all():
        empty = np.flatnonzero(~filled)
        order = _LOOK[empty]
        out[empty] = out[order[np.arange(len(empty)), filled[order].argmax(axis=1)]]
    return out


def estimate(a: np.ndarray, b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Jaccard estimates of rows of registers.  Two unrelated minima with rates
    proportional to the set sizes fall into one register cell with probability
    0.18 * 2^-MANTISSA_BITS * 4 n_a n_b / (n_a + n_b)^2 (cells are as wide as
    their value times 2^-MANTISSA_BITS, up to the power of two)."""
    equal = (a == b).mean(axis=1)
    chance = 0.1803 * 2.0**-MANTISSA_BITS * 4.0 * n_a * n_b / np.square(n_a + n_b)
    return (equal - chance) / (1.0 - chance)


def _sketch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = _WordHash()
    for b in batches:
        n, digest, bands = [], [], []
        for t in b.column("text").to_pylist():
            s = shingles(t, words)
            n.append(len(s))
            digest.append(xxhash.xxh3_128_digest(s.tobytes()) if len(s) else None)
            bands.append(registers(s).view(np.int64) if len(s) else None)
        columns = [b.column("__id"), pa.array(n, type=pa.int64()), pa.array(digest, type=pa.binary()), pa.array(bands, type=pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_arrays(columns, names=["__id", "__n", "__digest", "__bands"])


def _sets(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = _WordHash()
    for b in batches:
        sets = [shingles(t, words).tobytes() for t in b.column("text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("__id"), pa.array(sets, type=pa.binary())], names=["__id", "__set"])


def _passes(regs_a: np.ndarray, regs_b: np.ndarray, n_a: np.ndarray, n_b: np.ndarray) -> np.ndarray:
    """Whether the sizes and, unless a set is small, the estimate allow the similarity."""
    least = np.minimum(n_a, n_b)
    allowed = 100.0 * least >= PERCENT * np.maximum(n_a, n_b)
    return allowed & ((least < BUCKETS) | (estimate(regs_a, regs_b, n_a, n_b) >= ESTIMATE_FLOOR))


def _promising(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        if not b.num_rows:
            continue
        regs = [b.column(c).flatten().to_numpy(zero_copy_only=False).view(np.uint16).reshape(b.num_rows, BUCKETS) for c in ("bands_a", "bands_b")]
        sizes = [b.column(c).to_numpy(zero_copy_only=False).astype(np.float64) for c in ("n_a", "n_b")]
        keep = pa.array(_passes(*regs, *sizes))
        yield pa.RecordBatch.from_arrays([b.column("a").filter(keep), b.column("b").filter(keep)], names=["a", "b"])


def _similar(x: np.ndarray, y: np.ndarray) -> bool:
    both = len(np.intersect1d(x, y, assume_unique=True))
    return 100 * both >= PERCENT * (len(x) + len(y) - both)


def _connecting(rows: pa.Table, own: int, other: int) -> list[tuple[int, int]]:
    """Positions of links of one bucket (blocks ``own`` and ``other``) that
    connect its components: enough of them to connect all that are linked."""
    bands = rows.column("__bands").combine_chunks().flatten().to_numpy(zero_copy_only=False).reshape(-1, BANDS)
    regs = np.ascontiguousarray(bands).view(np.uint16)
    sets = [np.frombuffer(x, dtype=np.uint64) for x in rows.column("__set").to_pylist()]
    n = rows.column("__n").to_numpy().astype(np.float64)
    comp = np.array(rows.column("comp").combine_chunks().dictionary_encode().indices.to_numpy())
    block, pos = rows.column("block").to_numpy(), rows.column("pos")[0].as_py()
    left = np.flatnonzero(block == own)
    right = left if own == other else np.flatnonzero(block == other)
    links = []
    for k, i in enumerate(left):
        js = right[k + 1 :] if own == other else right
        js = js[comp[js] != comp[i]]
        if not len(js):
            continue
        js = js[_passes(np.broadcast_to(regs[i], (len(js), BUCKETS)), regs[js], np.full(len(js), n[i]), n[js])]
        js = js[(bands[js, :pos] != bands[i, :pos]).all(axis=1)]  # else an earlier band's bucket tests them
        for j in js:
            if comp[i] != comp[j] and _similar(sets[i], sets[j]):
                links.append((int(i), int(j)))
                comp[comp == comp[j]] = comp[i]
    return links


def _bucket_links(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows of one bucket and pair of blocks follow each other."""
    keys = ("pos", "band", "k1", "k2")

    def links(parts: list[pa.RecordBatch]) -> pa.RecordBatch:
        rows = pa.Table.from_batches(parts)
        found = _connecting(rows, rows.column("k1")[0].as_py(), rows.column("k2")[0].as_py())
        ids = rows.column("__id").combine_chunks()
        return pa.RecordBatch.from_arrays([ids.take(pa.array([f[side] for f in found], type=pa.int64())) for side in (0, 1)], names=["a", "b"])

    current, parts = None, []
    for b in batches:
        if not b.num_rows:
            continue
        values = np.stack([b.column(k).to_numpy(zero_copy_only=False).astype(np.int64) for k in keys], axis=1)
        starts = [0, *(np.flatnonzero((values[1:] != values[:-1]).any(axis=1)) + 1), b.num_rows]
        for s, e in zip(starts[:-1], starts[1:], strict=True):
            key = tuple(values[s])
            if key != current and parts:
                yield links(parts)
                parts = []
            current = key
            parts.append(b.slice(s, e - s))
    if parts:
        yield links(parts)


def _verified(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Pairs whose full sets are similar enough."""
    for b in batches:
        both = zip(b.column("set_a").to_pylist(), b.column("set_b").to_pylist(), strict=True)
        keep = pa.array([_similar(np.frombuffer(x, dtype=np.uint64), np.frombuffer(y, dtype=np.uint64)) for x, y in both], type=pa.bool_())
        yield pa.RecordBatch.from_arrays([b.column("a").filter(keep), b.column("b").filter(keep)], names=["a", "b"])


def _side(table: DataFrame, k: str, *columns: str) -> DataFrame:
    return table.select(F.col("__id").alias(k), *[F.col(f"__{c}").alias(f"{c}_{k}") for c in columns])


def _star_links(members: DataFrame, sketches: DataFrame, sets: DataFrame, kind: str) -> DataFrame:
    """Links between each bucket's centre and its other members."""
    centre = F.max(F.struct("degree", F.xxhash64("__id").alias("h"), F.col("__id").alias("a"))).alias("c")
    # written: a join with the aggregate itself would share its partitions, and Spark could not split a hot bucket
    centres = materialize(members.groupBy("pos", "band").agg(centre).select("pos", "band", "c.a"), "centres")
    pairs = members.join(centres, ["pos", "band"]).where(F.col("__id") != F.col("a")).select("a", F.col("__id").alias("b")).distinct()
    both = pairs.join(_side(sketches, "b", "n", "bands"), "b").join(_side(sketches, "a", "n", "bands"), "a")
    near = both.select("a", "b", "n_a", "n_b", "bands_a", "bands_b").mapInArrow(_promising, f"a {kind}, b {kind}")
    full = near.join(_side(sets, "b", "set"), "b").join(_side(sets, "a", "set"), "a").select("a", "b", "set_a", "set_b")
    return materialize(full.mapInArrow(_verified, f"a {kind}, b {kind}"), "star-links")


def _other_links(members: DataFrame, sketches: DataFrame, sets: DataFrame, kind: str) -> DataFrame:
    """Links that connect different components of one bucket."""
    mixed = members.groupBy("pos", "band").agg(F.min("comp").alias("lo"), F.max("comp").alias("hi"), F.count(F.lit(1)).alias("m"))
    mixed = mixed.where(F.col("lo") != F.col("hi")).select("pos", "band", F.ceil(F.col("m") / F.lit(BLOCK)).cast("int").alias("blocks"))
    mixed = materialize(mixed, "mixed")
    rows = members.join(mixed, ["pos", "band"]).withColumn("block", F.pmod(F.xxhash64("__id"), F.col("blocks")).cast("int"))
    rows = rows.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
    rows = rows.select("pos", "band", F.least("block", "other").alias("k1"), F.greatest("block", "other").alias("k2"), "block", "__id", "comp")
    rows = rows.join(sketches, "__id").join(sets, "__id")
    rows = rows.repartition("pos", "band", "k1", "k2").sortWithinPartitions("pos", "band", "k1", "k2")
    return materialize(rows.mapInArrow(_bucket_links, f"a {kind}, b {kind}"), "other-links")


def _labelled(rows: DataFrame, comps: DataFrame) -> DataFrame:
    """``rows`` with the component of ``__id``: its own id if it has no link."""
    return rows.join(comps, rows["__id"] == comps["node"], "left").withColumn("comp", F.coalesce("comp", "__id")).drop("node")


def near_groups(docs: DataFrame) -> DataFrame:
    """One row per document: ``doc_id, n_shingles, component_id, kept``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.col("doc_id").alias("__id"), "text")
    sketches = materialize(rows.mapInArrow(_sketch, f"__id {kind}, __n long, __digest binary, __bands array<long>"), "sketches")
    usable = sketches.where(F.col("__digest").isNotNull() & F.col("__id").isNotNull())
    first = usable.groupBy("__digest").agg(F.min(F.struct("__id", "__n", "__bands")).alias("__r"), F.count(F.lit(1)).alias("__copies"))
    reps = materialize(first.select("__digest", "__copies", "__r.*"), "representatives")

    banded = reps.select("__id", F.posexplode("__bands").alias("pos", "band"))
    buckets = banded.groupBy("pos", "band").agg(F.min("__id").alias("lo"), F.max("__id").alias("hi"), F.count(F.lit(1)).alias("m"))
    shared = materialize(buckets.where(F.col("lo") != F.col("hi")).select("pos", "band", "m"), "buckets")
    met = materialize(banded.join(shared, ["pos", "band"]), "met")
    some = met.groupBy("__id").agg(F.sum("m").alias("degree"))
    members = materialize(met.select("__id", "pos", "band").join(some, "__id"), "members")
    sets = materialize(rows.join(some, "__id", "left_semi").mapInArrow(_sets, f"__id {kind}, __set binary"), "sets")
    candidates = materialize(reps.join(some, "__id", "left_semi").select("__id", "__n", "__bands"), "candidates")

    links = _star_links(members, candidates, sets, kind)
    links = links.union(_other_links(_labelled(members, components(links)), candidates, sets, kind))
    known = _labelled(reps.select("__digest", "__copies", "__id"), components(links))
    known = known.where((F.col("__copies") > 1) | (F.col("comp") != F.col("__id"))).select("__digest", F.col("comp").alias("__comp"))
    # a null id takes part in nothing, whatever its text
    out = sketches.join(known, (sketches["__digest"] == known["__digest"]) & sketches["__id"].isNotNull(), "left")
    component = F.coalesce("__comp", "__id")
    return out.select(F.col("__id").alias("doc_id"), F.col("__n").alias("n_shingles"), component.alias("component_id"), F.col("__id").eqNullSafe(component).alias("kept"))


def near_dedup(docs: DataFrame) -> DataFrame:
    """The documents that are the smallest of their component, with all their columns."""
    gone = near_groups(docs).where(~F.col("kept")).select(F.col("doc_id").alias("__gone")).distinct()
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")


ORACLE = f"""
WITH RECURSIVE words AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'),
                                    '[^\\x20\\x09-\\x0D]+') AS w FROM documents),
sets AS (
  SELECT doc_id, CASE WHEN len(w) = 0 THEN [] WHEN len(w) < {SHINGLE} THEN [array_to_string(w, ' ')]
                      ELSE list_distinct([array_to_string(w[i : i + {SHINGLE - 1}], ' ') FOR i IN range(1, len(w) - {SHINGLE - 2})]) END AS s
  FROM words),
items AS (SELECT doc_id, unnest(s) AS x FROM sets),
common AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM items a JOIN items b ON a.x = b.x AND a.doc_id < b.doc_id GROUP BY ALL),
links AS (
  SELECT a, b FROM common JOIN sets p ON p.doc_id = a JOIN sets q ON q.doc_id = b
  WHERE 100 * n >= {PERCENT} * (len(p.s) + len(q.s) - n)),
edges AS (SELECT a, b FROM links UNION ALL SELECT b, a FROM links),
reach AS (
  SELECT doc_id AS node, doc_id AS to_node FROM documents
  UNION
  SELECT node, b FROM reach JOIN edges ON to_node = a),
comp AS (SELECT node, min(to_node) AS c FROM reach GROUP BY node)
SELECT doc_id, len(s)::BIGINT AS n_shingles, c AS component_id, doc_id = c AS kept
FROM sets JOIN comp ON node = doc_id
"""
