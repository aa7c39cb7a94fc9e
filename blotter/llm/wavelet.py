"""Token ids in wavelet-matrix files, one per shard.

Documents are laid out in ascending order of doc_id, tokenised, and cut
into shards of about ``shard_ids`` ids.  The ids of a shard become a wavelet
matrix: one plane of bits per bit of the largest id, the first plane with the
highest bits in order of place; each next plane holds the next bits after
the ids with a 0 have moved, in order, before those with a 1.  A plane is cut into
blocks, each compressed by zstd, with the number of ones before it, so that rank
and select read one block per plane.  That supports

* ``access(i)``: the id at a place,
* ``count(id, lo, hi)``: how often an id stands between two places,
* ``find(id, k)``: the place of the k-th occurrence of an id,
* ``ids()``: all of them, plane by plane, without ranks,

from one blob per shard.  The file of a shard is a Parquet file of one row that
Spark's writer puts next to the others, so it can lie in any store that
Spark writes to, and a lost executor only repeats its shards.

Layout of a blob, little-endian: magic ``BWM1``; ids, planes, bits per block (u32
each); documents (u32); then zstd frames, each after its length (u32): the
lengths of the documents (u32 each), and for each plane the zeros (u32),
the ones before each block (u32 each) and the length of each block (u32 each),
followed by the blocks.

Null texts count as empty: such documents hold the end id alone.  Null doc_ids
stand before all others.  Rows that repeat a doc_id are documents of their own, in
the order in which they were read, and a doc_id that many rows share is spread over several tasks.  A
document longer than a shard makes a shard of its own; a task holds one batch of
texts, the words of ``PIECE_BYTES`` of it, and the ids of one shard.  An empty table gives no rows.  Only doc_id and
text are read, whatever other columns are called.
"""

from __future__ import annotations

import json
import os
import re
import struct
from collections.abc import Iterator
from itertools import chain
from uuid import uuid4
from zlib import crc32

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import zstandard
from pyspark import Broadcast
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.operators.ordering import with_running_total
from blotter.session import ensure_checkpoint_dir

END_ID = 1
SHARD_IDS = 1 << 22
BLOCK_BITS = 1 << 16
MAGIC = b"BWM1"
# Words whose ids a worker remembers; it starts anew when they are more.
KNOWN_WORDS = 1 << 20
# Bytes of text that are tokenised at once; a longer text goes alone.
PIECE_BYTES = 1 << 23
_JOINED = 64
_BREAK = "\x00"
# A mark may join a capital letter, but not the small one, or the other way round.
_MARKED = r"[A-Z]\p{M}"
# Words of letters that every Unicode version splits, composes and lowers alike, and marks that may end a word.
_PLAIN = "[a-z\u00c0-\u00d6\u00d8-\u00f6\u00f8-\u00ff]+"
_TAIL = ".,;:!?#$%&*)\""
# The end of a splitting rule under which a plain word and the marks after it are tokenised apart.
_SPLIT = r"|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"


def _gathered(flat: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The stretches of ``flat`` one after the other, and where each starts and, at last, ends there."""
    sizes = ends - starts
    until = np.concatenate([[0], np.cumsum(sizes)])
    return flat[np.repeat(starts - until[:-1], sizes) + np.arange(until[-1])], until


class Encoder:
    """Ids of whole texts under the tokenizer of ``path``, without special tokens.

    The tokenizer sees every distinct word of a batch once: its splitting rule
    never joins what stands on both sides of an ASCII blank, and it lowers ASCII
    letters itself.  Where its rule also splits letters from marks, a word of plain letters
    and the marks that end it are two words.  Words it has not seen are
    given to it joined by a character that is a token of its own, plain ones by blanks, as the last token of each shows where it ends.  Texts with the strings of special
    tokens, with that character, or with a capital letter before a combining mark go to it whole.  A worker keeps one Encoder
    through its tasks (it travels as a broadcast of the path alone)."""

    def __init__(self, path: str):
        self.path = path
        self.tokenizer = None

    def __reduce__(self):
        return Encoder, (self.path,)

    def _load(self) -> None:
        from tokenizers import Tokenizer

        os.environ.setdefault("TOKENIZERS_PARALLELISM", "false")  # Spark's tasks are the parallelism
        self.tokenizer = Tokenizer.from_file(self.path)
        self.whole = [_BREAK, *(t.content.lower() for t in self.tokenizer.get_added_tokens_decoder().values())]
        self.break_ids = self._encode(_BREAK)
        self.closing = self._closing()
        self._forget()

    def _closing(self) -> np.ndarray | None:
        """By id: whether a token ends a word; None if words of letters can't be told so."""
        suffix = getattr(self.tokenizer.model, "end_of_word_suffix", None)
        rule = json.loads(self.tokenizer.pre_tokenizer.__getstate__())
        rule = (rule.get("pretokenizers") or [rule])[0]
        if not suffix or not str((rule.get("pattern") or {}).get("Regex")).endswith(_SPLIT):
            return None
        vocab = self.tokenizer.get_vocab()
        closing = np.zeros(max(vocab.values()) + 1, dtype=bool)
        closing[[i for t, i in vocab.items() if t.endswith(suffix)]] = True
        return closing

    def _forget(self) -> None:
        self.known: dict[str, int] = {"": 0}
        self.flat, self.ends = np.zeros(0, dtype=np.uint32), np.zeros(2, dtype=np.int64)

    def _encode(self, text: str) -> np.ndarray:
        return np.array(self.tokenizer.encode(text, add_special_tokens=False).ids, dtype=np.uint32)

    def _together(self, joined: list[str]) -> np.ndarray:
        found = [np.array(e.ids, dtype=np.uint32) for e in self.tokenizer.encode_batch_fast(joined, add_special_tokens=False)]
        return np.concatenate([self.flat[:0], *found])

    def _learn(self, words: list[str]) -> None:
        plain = list(filter(re.compile(_PLAIN).fullmatch, words)) if self.closing is not None else []
        if plain:
            ids = self._together([" ".join(plain[i : i + _JOINED]) for i in range(0, len(plain), _JOINED)])
            self._keep(plain, ids, np.flatnonzero(self.closing[ids]) + 1)
            words = [w for w in words if w not in self.known]
        ids = self._together([f" {_BREAK} ".join([*words[i : i + _JOINED], ""]) for i in range(0, len(words), _JOINED)])
        (breaks,) = np.nonzero(ids == self.break_ids[0])
        if len(self.break_ids) != 1:
            raise ValueError("the tokenizer does not keep words apart")
        self._keep(words, np.delete(ids, breaks), breaks - np.arange(len(breaks)))

    def _keep(self, words: list[str], ids: np.ndarray, ends: np.ndarray) -> None:
        if len(ends) != len(words):
            raise ValueError("the tokenizer does not keep words apart")
        self.known.update(zip(words, range(len(self.known), len(self.known) + len(words)), strict=True))
        self.ends = np.concatenate([self.ends, len(self.flat) + ends])
        self.flat = np.concatenate([self.flat, ids])

    def _parts(self, words: pa.Array) -> list[pa.DictionaryArray]:
        """Each word without the marks that end it, and these marks; whole, with "", unless it is plain without them."""
        heads, tails = words, pa.repeat("", len(words))
        if self.closing is not None:
            heads = pc.ascii_rtrim(words, characters=_TAIL)
            plain = pc.match_substring_regex(heads, f"^{_PLAIN}$")
            heads = pc.if_else(plain, heads, words)
            tails = pc.if_else(plain, pc.replace_substring_regex(words, f"^{_PLAIN}", ""), tails)
        return [heads.dictionary_encode(), tails.dictionary_encode()]

    def _words(self, words: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of the words one after the other, where the ids of each start and, at last, end)."""
        parts = self._parts(words)
        seen = [part.dictionary.to_numpy(zero_copy_only=False).tolist() for part in parts]
        new = [w for w in dict.fromkeys(chain(*seen)) if w not in self.known]
        if len(self.known) + len(new) > KNOWN_WORDS:
            self._forget()
            new = [w for w in dict.fromkeys(chain(*seen)) if w]
        if new:
            self._learn(new)
        numbers = np.empty((len(words), 2), dtype=np.int64)
        for i, part in enumerate(parts):
            found = np.fromiter(map(self.known.__getitem__, seen[i]), dtype=np.int64, count=len(seen[i]))
            numbers[:, i] = found[part.indices.to_numpy()]
        numbers = numbers.ravel()
        ids, until = _gathered(self.flat, self.ends[numbers], self.ends[numbers + 1])
        return ids, until[::2]

    def batch(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """(ids of all texts one after the other, their numbers of ids)."""
        if self.tokenizer is None:
            self._load()
        lowered = pc.ascii_lower(pc.fill_null(texts, ""))
        apart = pc.match_substring_regex(texts, _MARKED).fill_null(False).to_numpy(zero_copy_only=False)
        for t in self.whole:
            apart = apart | pc.match_substring(lowered, t).to_numpy(zero_copy_only=False)
        if apart.any():
            lowered = pc.if_else(pa.array(apart), "", lowered)
        split = pc.ascii_split_whitespace(lowered)
        words = split.flatten().dictionary_encode()
        known, starts = self._words(words.dictionary)
        at = words.indices.to_numpy()
        ids, until = _gathered(known, starts[at], starts[at + 1])
        places = split.offsets.to_numpy()
        lengths = np.diff(until[places - places[0]])
        if apart.any():
            parts = np.split(ids, np.cumsum(lengths)[:-1])
            for i in np.flatnonzero(apart):
                parts[i] = self._encode(texts[int(i)].as_py())
            ids, lengths = np.concatenate(parts), np.array([len(p) for p in parts], dtype=np.int64)
        return ids, lengths


def build(ids: np.ndarray, lengths: list[int], block_bits: int = BLOCK_BITS) -> bytes:
    """The blob of a shard: its ids and the number of ids of each document."""
    pack = zstandard.ZstdCompressor(level=1).compress
    planes = max(1, int(ids.max(initial=0)).bit_length())
    now = ids.astype(np.uint16 if planes <= 16 else np.uint32)
    out = [MAGIC, struct.pack("<IIII", len(ids), planes, block_bits, len(lengths))]

    def frame(raw: bytes) -> None:
        packed = pack(raw)
        out.extend((struct.pack("<I", len(packed)), packed))

    frame(np.array(lengths, dtype="<u4").tobytes())
    for level in range(planes - 1, -1, -1):
        bits = (now >> level) & 1 == 1
        packed = np.packbits(bits, bitorder="little")
        blocks = [pack(packed[i : i + block_bits // 8].tobytes()) for i in range(0, len(packed), block_bits // 8)]
        starts = range(0, len(bits), block_bits)
        before = np.concatenate([[0], np.cumsum([np.count_nonzero(bits[i : i + block_bits]) for i in starts])])
        zeros = np.compress(~bits, now)
        frame(np.concatenate([[len(zeros)], before[:-1], [len(b) for b in blocks]]).astype("<u4").tobytes())
        out += blocks
        now = np.concatenate([zeros, np.compress(bits, now)])
    return b"".join(out)


class WaveletMatrix:
    """Reads the blob of a shard; blocks are unpacked when they are asked for."""

    def __init__(self, blob: bytes):
        if blob[:4] != MAGIC:
            raise ValueError("not a wavelet-matrix file")
        self._blob, self._unpack = blob, zstandard.ZstdDecompressor().decompress
        self.size, self.planes, self.block_bits, documents = struct.unpack_from("<IIII", blob, 4)
        self._at = 20
        self.lengths = self._frame()
        n = -(-self.size // self.block_bits)
        self._levels = []
        for _ in range(self.planes):
            head = self._frame()
            ends = self._at + np.cumsum(head[n + 1 :], dtype=np.int64)
            self._levels.append((int(head[0]), head[1 : n + 1], [self._at, *ends.tolist()]))
            self._at = self._levels[-1][2][-1]
        self._cache: dict[tuple[int, int], np.ndarray] = {}
        assert len(self.lengths) == documents

    def _frame(self) -> np.ndarray:
        (length,) = struct.unpack_from("<I", self._blob, self._at)
        self._at += 4 + length
        return np.frombuffer(self._unpack(self._blob[self._at - length : self._at]), dtype="<u4")

    def _bits(self, level: int, block: int) -> np.ndarray:
        ends = self._levels[level][2]
        raw = np.frombuffer(self._unpack(self._blob[ends[block] : ends[block + 1]]), dtype=np.uint8)
        return np.unpackbits(raw, bitorder="little", count=min(self.block_bits, self.size - block * self.block_bits))

    def _block(self, level: int, block: int) -> np.ndarray:
        if (level, block) not in self._cache:
            if len(self._cache) >= 256:
                self._cache.clear()
            self._cache[level, block] = self._bits(level, block)
        return self._cache[level, block]

    def _ones(self, level: int, i: int) -> int:
        """Ones among the first i bits of a plane."""
        block, rest = divmod(i, self.block_bits)
        zeros, before, _ = self._levels[level]
        if not rest:
            return int(before[block]) if block < len(before) else self.size - zeros
        return int(before[block]) + int(self._block(level, block)[:rest].sum())

    def _place(self, level: int, bit: int, k: int) -> int:
        """The place of the k-th (from 0) bit of this value in a plane."""
        _, before, _ = self._levels[level]
        starts = np.arange(len(before), dtype=np.int64) * self.block_bits
        counts = before.astype(np.int64) if bit else starts - before
        block = int(np.searchsorted(counts, k, side="right")) - 1
        inside = np.flatnonzero(self._block(level, block) == bit)
        return block * self.block_bits + int(inside[k - int(counts[block])])

    def access(self, i: int) -> int:
        if not 0 <= i < self.size:
            raise IndexError(i)
        found = 0
        for level in range(self.planes):
            bit = int(self._block(level, i // self.block_bits)[i % self.block_bits])
            ones = self._ones(level, i)
            i = self._levels[level][0] + ones if bit else i - ones
            found = found << 1 | bit
        return found

    def _range(self, token: int, lo: int, hi: int) -> tuple[int, int]:
        for level in range(self.planes):
            a, b = self._ones(level, lo), self._ones(level, hi)
            if token >> (self.planes - 1 - level) & 1:
                zeros = self._levels[level][0]
                lo, hi = zeros + a, zeros + b
            else:
                lo, hi = lo - a, hi - b
        return lo, hi

    def count(self, token: int, lo: int = 0, hi: int | None = None) -> int:
        """How often ``token`` stands at the places lo to hi - 1."""
        hi = self.size if hi is None else min(hi, self.size)
        if token < 0 or token >> self.planes or lo >= hi:
            return 0
        lo, hi = self._range(token, max(lo, 0), hi)
        return hi - lo

    def find(self, token: int, k: int) -> int:
        """The place of the k-th (from 0) occurrence of ``token``, -1 if there are fewer."""
        if token < 0 or token >> self.planes or k < 0:
            return -1
        lo, hi = self._range(token, 0, self.size)
        if k >= hi - lo:
            return -1
        at = lo + k
        for level in range(self.planes - 1, -1, -1):
            bit = token >> (self.planes - 1 - level) & 1
            at = self._place(level, bit, at - self._levels[level][0] if bit else at)
        return at

    def ids(self) -> np.ndarray:
        """All ids in order: from the last plane up, each moves its bits back."""
        now = np.zeros(self.size, dtype=np.uint16 if self.planes <= 16 else np.uint32)
        n = -(-self.size // self.block_bits)
        for level in range(self.planes - 1, -1, -1):
            bits = np.concatenate([self._bits(level, b) for b in range(n)]).astype(bool) if n else np.zeros(0, bool)
            zeros = self._levels[level][0]
            back = np.empty_like(now)
            back[np.flatnonzero(~bits)] = now[:zeros]
            back[np.flatnonzero(bits)] = now[zeros:] | (1 << (self.planes - 1 - level))
            now = back
        return now


def _pieces(batch: pa.RecordBatch) -> Iterator[pa.RecordBatch]:
    """The batch in parts of about ``PIECE_BYTES`` of text."""
    sizes = pc.fill_null(pc.binary_length(batch.column("text")), 0).to_numpy(zero_copy_only=False)
    part = np.cumsum(sizes, dtype=np.int64) // PIECE_BYTES
    cuts = [0, *(np.flatnonzero(np.diff(part)) + 1).tolist(), batch.num_rows]
    for a, b in zip(cuts[:-1], cuts[1:], strict=True):
        yield batch.slice(a, b - a)


def _sharded(encoder: Broadcast, end_id: int, shard_ids: int, block_bits: int):
    """Documents in order -> a row per shard."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        docs: list[pa.Array] = []
        parts: list[np.ndarray] = []
        lengths: list[int] = []
        total = 0

        def shard() -> pa.RecordBatch:
            blob = build(np.concatenate(parts), lengths, block_bits)
            names = pa.ListArray.from_arrays([0, len(lengths)], pa.concat_arrays(docs))
            return pa.RecordBatch.from_arrays([pa.array([total], type=pa.int64()), names, pa.array([blob], type=pa.binary())], names=["n", "doc_ids", "blob"])

        for b in (piece for whole in batches for piece in _pieces(whole)):
            if not b.num_rows:
                continue
            ids, sizes = encoder.value.batch(b.column("text"))
            ends = np.cumsum(sizes + 1)
            ids = np.insert(ids, np.cumsum(sizes), end_id)
            first = 0
            while first < len(ends):
                done = int(ends[first - 1]) if first else 0
                # as many documents as fit, and at least one in a shard
                last = int(np.searchsorted(ends, done + shard_ids - total, side="right"))
                if last <= first and not lengths:
                    last = first + 1
                if last > first:
                    docs.append(b.column("doc_id").slice(first, last - first))
                    parts.append(ids[done : int(ends[last - 1])])
                    lengths += (sizes[first:last] + 1).tolist()
                    total += int(ends[last - 1]) - done
                    first = last
                if first < len(ends):
                    yield shard()
                    docs, parts, lengths, total = [], [], [], 0
        if lengths:
            yield shard()

    return run


def write_shards(docs: DataFrame, tokenizer: str, folder: str, *, end_id: int = END_ID, shard_ids: int = SHARD_IDS, block_bits: int = BLOCK_BITS) -> None:
    """Tokenise ``docs(doc_id, text)`` and write their ids below ``folder``: a file
    per shard with ``shard`` (ascending in order of doc_id), ``n`` (its ids),
    ``doc_ids`` and ``blob``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    encoder = docs.sparkSession.sparkContext.broadcast(Encoder(tokenizer))
    rows = docs.select("doc_id", F.col("text").cast("string").alias("text"), F.monotonically_increasing_id().alias("place"))
    order = [F.col("doc_id").asc_nulls_first(), F.col("place")]
    laid = rows.repartitionByRange(*order).sortWithinPartitions(*order).select("doc_id", "text")
    shards = laid.mapInArrow(_sharded(encoder, end_id, shard_ids, block_bits), f"n long, doc_ids array<{kind}>, blob binary")
    numbered = shards.select(F.monotonically_increasing_id().alias("shard"), "n", "doc_ids", "blob")
    # the planes are compressed already
    numbered.write.option("maxRecordsPerFile", 1).option("compression", "uncompressed").parquet(folder)


def read_shards(docs: DataFrame, folder: str) -> DataFrame:
    """The files of ``write_shards`` for documents like ``docs``."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.sparkSession.read.schema(f"shard long, n long, doc_ids array<{kind}>, blob binary").parquet(folder)


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        for i in range(b.num_rows):
            matrix = WaveletMatrix(b.column("blob")[i].as_py())
            ids = matrix.ids().astype("<u4")
            ends = np.cumsum(matrix.lengths, dtype=np.int64)
            starts = ends - matrix.lengths
            yield pa.RecordBatch.from_pydict(
                {
                    "doc_id": b.column("doc_ids")[i].values,
                    "shard": pa.array(np.full(len(ends), b.column("shard")[i].as_py()), type=pa.int64()),
                    "inside": pa.array(starts),
                    "n_tokens": pa.array(ends - starts),
                    "ids_crc32": pa.array([crc32(ids[a:e]) for a, e in zip(starts, ends, strict=True)], type=pa.int64()),
                }
            )


def digests(shards: DataFrame) -> DataFrame:
    """Per document of the read files: ``doc_id, start`` (ids of all documents
    before it), ``n_tokens, ids_crc32``.  The ids before a shard are a running sum
    over the shards' ``n``; the planes are read once."""
    kind = shards.schema["doc_ids"].dataType.elementType.simpleString()
    until = with_running_total(shards.select("shard", "n"), [F.col("shard")], "n", name="until")
    before = until.select(F.col("shard").alias("__shard"), (F.col("until") - F.col("n")).alias("before"))
    rows = shards.select("shard", "doc_ids", "blob").mapInArrow(_digests, f"doc_id {kind}, shard long, inside long, n_tokens long, ids_crc32 long")
    joined = rows.join(before, F.col("shard") == F.col("__shard"))
    return joined.select("doc_id", (F.col("before") + F.col("inside")).alias("start"), "n_tokens", "ids_crc32")


def token_files(docs: DataFrame, tokenizer: str, **options: int) -> DataFrame:
    """Write the files of ``docs`` below the checkpoint folder and read their digests back."""
    folder = f"{ensure_checkpoint_dir(docs.sparkSession)}/wavelet-{uuid4().hex}"
    write_shards(docs, tokenizer, folder, **options)
    return digests(read_shards(docs, folder))
