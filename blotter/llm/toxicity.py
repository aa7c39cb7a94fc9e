"""Toxicity: FTRL-proximal logistic regression over hashed word n-grams.

A text is the set of its hashed words, word pairs and skip pairs (one and two
words left out) in ``2 ** BITS`` coordinates, letters in lower case.
FTRL-proximal learns with a rate per coordinate and an L1 term, so that only a
few thousand weights differ from zero; these travel with the scoring function.

The model is fitted on a sample of labelled documents, at most about
``sample_docs`` of them (chosen by a hash of the id; a documented bound), in
one task and in a fixed order, so reruns give the same weights.  The rows of each epoch stream
through the task in Spark's sorted order; it holds two numbers per coordinate and
one batch, however long the texts are.  Scoring reads whole texts one at a time and needs no shuffle.

Null texts count as empty and get the score of the bias.  Labels that are null
or not 0/1 are not used; a document labelled twice takes the larger label.
Without labelled rows of both classes the score is the share of label 1 (0
without any).  Repeated rows are scored alike; an empty table gives an empty
result.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import held_out, one_label, whole_text

SAMPLE_DOCS = 20_000
BITS = 20
ALPHA, BETA, L1, L2 = 1.0, 1.0, 8.0, 0.01
EPOCHS = 3
THRESHOLD = 0.5
_TOKEN = re.compile(r"[^\W_]+")
_ODD = np.array([0x9E3779B97F4A7C15, 0xC2B2AE3D27D4EB4F, 0x165667B19E3779F9, 0xD6E8FEB86659FD93, 0xA0761D6478BD642F, 0xE7037ED1A0B428DB, 0x8EBC6AF09C88C6E3], dtype=np.uint64)
_MOST_WORDS = 1 << 16


class _WordHash(dict):
    """Hash of a word, remembered; emptied when it holds too many words."""

    def __missing__(self, word: str) -> int:
        if len(self) >= _MOST_WORDS:
            self.clear()
        self[word] = h = xxhash.xxh3_64_intdigest(word)
        return h


def _fold(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(31))) * _ODD[0]
    return (x >> np.uint64(64 - BITS)).astype(np.int32)


def grams(text: str, words: _WordHash) -> np.ndarray:
    """Coordinates of the words, pairs and skip pairs of a text, repeats included."""
    found = _TOKEN.findall(text.lower())
    h = np.fromiter(map(words.__getitem__, found), dtype=np.uint64, count=len(found))
    parts = [_fold(h * _ODD[1])]
    for gap in (1, 2, 3):
        if len(h) > gap:
            parts.append(_fold(h[:-gap] * _ODD[1 + gap] + h[gap:] * _ODD[4 + (gap - 1) % 3]))
    return np.concatenate(parts)


@dataclass(frozen=True)
class Weights:
    """Sparse weights: coordinates, their values, and the bias (a log-odds)."""

    at: np.ndarray
    value: np.ndarray
    bias: float

    def dense(self) -> np.ndarray:
        w = np.zeros(1 << BITS, dtype=np.float64)
        w[self.at] = self.value
        return w


class Ftrl:
    """The learner: sums of gradients ``z`` and of their squares ``n`` per coordinate."""

    def __init__(self):
        self.z, self.n = np.zeros(1 << BITS), np.zeros(1 << BITS)
        self.bias_z = self.bias_n = 0.0

    @staticmethod
    def solve(z, n, l1):
        return np.where(np.abs(z) <= l1, 0.0, -(z - np.sign(z) * l1) / ((BETA + np.sqrt(n)) / ALPHA + L2))

    def learn(self, label: int, at: np.ndarray) -> None:
        """One step on the distinct coordinates of a text."""
        z, n = self.z[at], self.n[at]
        w = self.solve(z, n, L1)
        bias = float(self.solve(np.float64(self.bias_z), np.float64(self.bias_n), 0.0))
        g = 1.0 / (1.0 + np.exp(-min(max(w.sum() + bias, -35.0), 35.0))) - label
        step = (np.sqrt(n + g * g) - np.sqrt(n)) / ALPHA
        self.z[at] = z + g - step * w
        self.n[at] = n + g * g
        self.bias_z += g - (np.sqrt(self.bias_n + g * g) - np.sqrt(self.bias_n)) / ALPHA * bias
        self.bias_n += g * g

    def weights(self) -> Weights:
        w = self.solve(self.z, self.n, L1)
        at = np.flatnonzero(w).astype(np.int32)
        return Weights(at, w[at], float(self.solve(np.float64(self.bias_z), np.float64(self.bias_n), 0.0)))


def _features(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    words = _WordHash()
    for b in batches:
        lists = [np.unique(grams(t, words)) for t in b.column("__text").to_pylist()]
        yield pa.RecordBatch.from_arrays([b.column("__id"), b.column("__y"), pa.array(lists, type=pa.list_(pa.int32()))], names=["__id", "__y", "__at"])


def _fit_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """All epochs, one row after the other: the task holds the learner and one batch."""
    learner = Ftrl()
    rows = ones = 0
    for b in batches:
        at = b.column("__at")
        flat, ends = at.flatten().to_numpy(zero_copy_only=False), at.offsets.to_numpy()
        ends = ends - ends[0]
        for y, i, j in zip(b.column("__y").to_pylist(), ends[:-1], ends[1:], strict=True):
            learner.learn(y, flat[i:j])
            rows, ones = rows + 1, ones + y
    if 0 < ones < rows:
        w = learner.weights()
    else:
        share = min(max(ones / max(rows, 1), 1e-9), 1 - 1e-9)
        w = Weights(np.zeros(0, np.int32), np.zeros(0), float(np.log(share / (1 - share))))
    at = np.append(w.at, -1).astype(np.int32)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(np.append(w.value, w.bias))], names=["at", "value"])


def train(docs: DataFrame, labels: DataFrame, *, label: str = "toxic", sample_docs: int = SAMPLE_DOCS) -> Weights:
    """Fit on labelled documents that are not held out, about ``sample_docs`` at most."""
    known = one_label(labels, label).where(~held_out("__id"))
    # of 2^63 equally likely hashes, the share that sample_docs are of all
    most = (1 << 63) - 1
    known = known.where(F.xxhash64("__id", F.lit(8)).bitwiseAND(F.lit(most)) <= F.lit(min(most, (most * sample_docs) // max(known.count(), 1))))
    # about sample_docs rows of two numbers: small whatever the size of the table
    rows = docs.select(F.col("doc_id").alias("__id"), whole_text().alias("__text")).join(F.broadcast(known), "__id")
    features = rows.select("__id", "__y", "__text").mapInArrow(_features, f"__id {docs.schema['doc_id'].dataType.simpleString()}, __y int, __at array<int>")
    epochs = features.withColumn("__epoch", F.explode(F.sequence(F.lit(1), F.lit(EPOCHS))))
    # Spark's sort spills, so long texts cost the task time, not memory
    ordered = epochs.repartition(1).sortWithinPartitions("__epoch", F.xxhash64("__id", F.lit(9)), "__id", "__y", F.xxhash64("__at")).select("__y", "__at")
    found = ordered.mapInArrow(_fit_task, "at int, value double").collect()  # at most 2 ** BITS + 1 weights
    at = np.array([r[0] for r in found], dtype=np.int32)
    value = np.array([r[1] for r in found], dtype=np.float64)
    if not len(at):  # no task ran
        return Weights(np.zeros(0, np.int32), np.zeros(0), -35.0)
    order = np.argsort(at, kind="stable")
    at, value = at[order], value[order]
    return Weights(at[1:], value[1:], float(value[0]))


def probabilities(texts: list[str | None], dense: np.ndarray, bias: float, words: _WordHash) -> np.ndarray:
    out = np.empty(len(texts))
    for i, t in enumerate(texts):
        at = grams(t or "", words)
        at = at[dense[at] != 0.0]
        out[i] = dense[np.unique(at)].sum() + bias
    return 1.0 / (1.0 + np.exp(-np.clip(out, -35.0, 35.0)))


def toxicity_scores(docs: DataFrame, model: Weights, *, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense, words = model.dense(), _WordHash()
        for b in batches:
            p = probabilities(b.column("text").to_pylist(), dense, model.bias, words)
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(p)], names=["doc_id", "held_out", "score"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    scored = docs.select("doc_id", held_out().alias("held_out"), "text").mapInArrow(score, f"doc_id {kind}, held_out boolean, score double")
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))


def drop_toxic(docs: DataFrame, model: Weights, *, threshold: float = THRESHOLD) -> DataFrame:
    """The documents scored below ``threshold``, with all their columns."""

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dense, words = model.dense(), _WordHash()
        for b in batches:
            p = probabilities(b.column("text").to_pylist(), dense, model.bias, words)
            yield b.filter(pa.array(p < threshold))

    return docs.mapInArrow(keep, docs.schema)
