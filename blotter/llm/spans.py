"""Substring dedup by sliding sentence spans.

A text is cut into sentences at . ! ? ; : and line breaks.  Inside a sentence
a window slides over ``WINDOW`` words (all but the last, after which it ends
anyway), and the sentence is cut after the word of least hash in each window.
So every ``WINDOW`` words hold a cut that depends on these words alone, and two
equal passages are cut alike except within ``WINDOW`` - 1 words of their edges:
of n shared words at least n + 3 - 4 * ``WINDOW`` lie between the first and the
last common cut, so any 51 shared words (49 whole ones, if different marks stand
at the words of the edges) hold the 16 words that a run needs.  In scripts
written without blanks every character counts as a word.  The pieces are called
sentences from here on.
From every sentence a run of consecutive sentences starts that
ends as soon as it has ``MIN_SENTENCES`` sentences and ``MIN_WORDS`` words.  Runs are hashed
(letters in lower case, blanks collapsed, marks kept) and joined globally: of equal runs the first, by
doc_id and place, stays, and every sentence covered by any other one is
removed.

Only the hashes travel: first 64 bits with a count decide which runs are
candidates, then candidates are compared by 92 bits and their number of sentences.  Hot runs cost one row per
task in the counts, and the joins are plain equi-joins that Spark splits.

Null texts count as empty; very long texts are cut and hashed one at a time.  Runs that repeat inside one document are removed
as well.  A document is told from others by doc_id and text: rows that repeat both
are one document and none of them removes the other; rows that share a doc_id
alone, null ones included, are different documents.  They are ordered by doc_id, null ones
last, then by a hash of the text.  Extra columns may have any name.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import materialize
from blotter.session import scratch_tables

MIN_SENTENCES = 2
MIN_WORDS = 16
WINDOW = 9
_SENTENCE = re.compile(r"[^.!?;:\n]*[.!?;:\n]+|[^.!?;:\n]+")
#: Thai to Myanmar, Khmer, kana and Han: written without blanks
_NO_BLANKS = "\u0e00-\u0eff\u1000-\u109f\u1780-\u17ff\u3040-\u30ff\u3400-\u4dbf\u4e00-\u9fff\uf900-\ufaff\U00020000-\U0003ffff"
_UNSPACED = re.compile(f"[{_NO_BLANKS}]")
_WORD = re.compile(rf"[{_NO_BLANKS}]|[^\s{_NO_BLANKS}]+")


def cuts(words: list[str]) -> list[int]:
    """The words after which a sentence is cut: of each window over all words
    but the last the one of least hash (of equal ones the last), and the last."""
    ranks = [xxhash.xxh3_64_intdigest(w) for w in words[:-1]]
    found = []
    at = -1
    for end in range(WINDOW, len(ranks) + 1):
        if at < end - WINDOW:
            at = end - WINDOW
            for i in range(at + 1, end):
                if ranks[i] <= ranks[at]:
                    at = i
        elif ranks[end - 1] <= ranks[at]:
            at = end - 1
        if not found or found[-1] != at:
            found.append(at)
    return [*found, len(words) - 1]


def sentences(text: str) -> list[tuple[int, int, int, str]]:
    """(start, end, words, normal form) of the sentences; together with the
    blanks before them they cover the text."""
    out = []
    unspaced = not text.isascii() and _UNSPACED.search(text) is not None
    for m in _SENTENCE.finditer(text):
        part = m.group()
        words = part.lower().split()
        if not words:
            continue
        if len(words) <= WINDOW and not unspaced:
            out.append((m.start(), m.end(), len(words), " ".join(words)))
            continue
        places = [w.span() for w in _WORD.finditer(part)]
        units = [part[s:e].lower() for s, e in places] if unspaced else words
        first = 0
        for i in cuts(units):
            last = i == len(units) - 1
            start = m.start() + (places[first][0] if first else 0)
            end = m.end() if last else m.start() + places[i][1]
            own = part[places[first][0] : places[i][1]].lower().split() if unspaced else words[first : i + 1]
            out.append((start, end, len(own), " ".join(own)))
            first = i + 1
    return out


def runs(parts: list[tuple[int, int, int, str]]) -> tuple[list[int], list[int]]:
    """(first 64 bits, next 28 bits and 4 bits with the number of sentences less
    one) of the runs that start at the first sentence, the second, and so on.
    A run has at most ``MIN_WORDS`` = 16 sentences, none being empty."""
    keys = [xxhash.xxh3_128_digest(p[3]) for p in parts]
    words = [p[2] for p in parts]
    hi, lo = [], []
    end = total = 0
    for i in range(len(parts)):
        while end < len(parts) and (end - i < MIN_SENTENCES or total < MIN_WORDS):
            total += words[end]
            end += 1
        if end - i < MIN_SENTENCES or total < MIN_WORDS:
            break
        d = xxhash.xxh3_128_digest(b"".join(keys[i:end]))
        hi.append(int.from_bytes(d[:8], "big", signed=True))
        lo.append(int.from_bytes(d[8:12], "big", signed=True) & ~15 | (end - i - 1))
        total -= words[i]
    return hi, lo


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    kinds = (pa.int64(), pa.int32())
    for b in batches:
        columns: list[list] = [[], []]
        for t in b.column("text").to_pylist():
            for c, v in zip(columns, runs(sentences(t or "")), strict=True):
                c.append(v)
        arrays = [pa.array(c, type=pa.list_(k)) for c, k in zip(columns, kinds, strict=True)]
        yield pa.RecordBatch.from_arrays([b.column("__id"), b.column("__text"), *arrays], names=["__id", "__text", "hi", "lo"])


def without(text: str, covered: list[tuple[int, int]]) -> tuple[str, int, int]:
    """The text without the covered sentences (first sentence, number), and how
    many sentences and words went."""
    parts = sentences(text)
    gone: set[int] = set()
    for i, n in covered:
        gone.update(range(i, i + n))
    out: list[str] = []
    after = 0
    ends = [p[1] for p in parts] + [len(text)]
    for i, end in enumerate(ends):
        part = text[after:end] if i not in gone else ""
        after = end
        if part and out and i - 1 in gone and not out[-1][-1].isspace() and not part[0].isspace():
            out.append(" ")
        out += [part] if part else []
    return "".join(out).strip(), len(gone), sum(parts[i][2] for i in gone)


def _cleaner(covered: str, sentences: str, words: str):
    """Cuts the runs in the column ``covered`` out of ``text``; the other two names are of the counts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            texts, sentences_gone, words_gone = [], [], []
            for t, own in zip(b.column("text").to_pylist(), b.column(covered).to_pylist(), strict=True):
                n = w = 0
                if t and own:
                    t, n, w = without(t, [(c["at"], c["size"]) for c in own])
                texts.append(t)
                sentences_gone.append(n)
                words_gone.append(w)
            rest = [c for c in b.schema.names if c not in (covered, "text")]
            columns = {c: b.column(c) for c in rest} | {"text": pa.array(texts, type=pa.string()), sentences: pa.array(sentences_gone, type=pa.int64()), words: pa.array(words_gone, type=pa.int64())}
            yield pa.RecordBatch.from_pydict(columns)

    return run


def _own_text() -> Column:
    return F.xxhash64(F.coalesce("text", F.lit("")))


def repeated_spans(docs: DataFrame) -> DataFrame:
    """``(__id, __text, __covered)``: per document (doc_id and hash of the text) the runs to remove, as an array of
    (at, size) in sentences; documents without any have no row."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select(F.col("doc_id").alias("__id"), _own_text().alias("__text"), "text")
    with scratch_tables(docs.sparkSession):  # the table of all runs goes as soon as the repeated ones are written
        hashed = materialize(rows.mapInArrow(_hashed, f"__id {kind}, __text long, hi array<long>, lo array<int>"), "runs")
        often = hashed.select(F.explode("hi").alias("hi")).groupBy("hi").agg(F.count(F.lit(1)).alias("n")).where("n > 1").select("hi")
        often = materialize(often, "often")  # else the join shares the count's partitions, and Spark cannot split a hot run
        flat = hashed.select("__id", "__text", F.posexplode(F.arrays_zip("hi", "lo")).alias("at", "r"))
        lo_at = F.shiftleft(F.col("r.lo").cast("long"), 32).bitwiseOR(F.col("at").cast("long"))  # one field less to shuffle
        some = flat.select("__id", "__text", "r.hi", lo_at.alias("lo_at")).join(often, "hi")
        some = some.select("__id", "__text", "hi", F.shiftright("lo_at", 32).cast("int").alias("lo"), F.col("lo_at").bitwiseAND(F.lit((1 << 32) - 1)).cast("int").alias("at"))
        some = materialize(some.withColumn("size", F.col("lo").bitwiseAND(F.lit(15)) + 1), "repeated", outlives=True)
    place = F.struct(F.col("__id").isNull().alias("last"), F.col("__id").alias("id"), F.col("__text").alias("text"), F.col("at").alias("at"))
    first = some.groupBy("hi", "lo").agg(F.min(place).alias("first"), F.count(F.lit(1)).alias("n")).where("n > 1").drop("n")
    first = materialize(first, "first")
    others = some.withColumn("place", place).join(first, ["hi", "lo"]).where(~F.col("place").eqNullSafe(F.col("first")))
    # runs of one document: bounded by its length
    return others.select("__id", "__text", "at", "size").distinct().groupBy("__id", "__text").agg(F.collect_list(F.struct("at", "size")).alias("__covered"))


def span_dedup(docs: DataFrame) -> DataFrame:
    """``docs`` with its columns, the text without repeated spans, and
    ``sentences_removed, words_removed`` (replacing columns of that name)."""
    columns = [c for c in docs.columns if c not in ("sentences_removed", "words_removed")]
    taken = {c.lower() for c in columns}

    def free(name: str) -> str:
        while name in taken:
            name = f"_{name}"
        return name

    of, of_text, own, covered, sentences_gone, words_gone = (free(n) for n in ("__of", "__of_text", "__own_text", "__covered", "__sentences", "__words"))
    runs_gone = repeated_spans(docs).toDF(of, of_text, covered)
    rows = docs.select(*[F.col(f"`{c}`") for c in columns], _own_text().alias(own))
    joined = rows.join(runs_gone, rows["doc_id"].eqNullSafe(runs_gone[of]) & (rows[own] == runs_gone[of_text]), "left").drop(of, of_text, own)
    schema = ", ".join(f"`{c}` {docs.schema[c].dataType.simpleString()}" for c in columns if c != "text") + f", text string, {sentences_gone} long, {words_gone} long"
    out = joined.mapInArrow(_cleaner(covered, sentences_gone, words_gone), schema)
    return out.select(*[F.col(f"`{c}`") for c in columns], F.col(sentences_gone).alias("sentences_removed"), F.col(words_gone).alias("words_removed"))
