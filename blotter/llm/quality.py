"""Quality: regularised quadratic discriminant over document statistics.

Every text gives a vector of transformed statistics (lengths, shares of
character classes, repetition).  Each class has a Gaussian whose covariance is
shrunk towards the pooled covariance and towards its own diagonal.  The score
is the posterior of label 1 from the difference of the two log densities,
``-(|L^-1 (x - m)|^2) / 2 - log det L``; the Cholesky factors L are computed
once on the driver and travel, inverted, with the scoring function.

Means and covariances come from all labelled documents that are not held out:
tasks emit partial sums, Spark adds them up, and only the sums of the two
classes (some hundred numbers) reach the driver.

Null texts count as empty; an empty text has the zero statistics.  Labels that
are null or not 0/1 are not used; a document labelled twice takes the larger
label.  When a class has no labelled rows the score is the share of label 1
(0.5 without any).  Repeated rows are scored alike; an empty table gives an
empty result.
"""

from __future__ import annotations

import operator
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from blotter.llm.common import held_out, materialize, one_label

TO_POOLED, TO_DIAGONAL, RIDGE = 0.5, 0.1, 1e-3
THRESHOLD = 0.3
STATISTICS = (
    "words", "word_length", "word_spread", "distinct_words", "distinct_pairs", "repeated_next", "upper", "digits",
    "stops", "commas", "marks", "symbols", "beyond_ascii", "blanks", "lines", "distinct_lines", "entropy", "long_words",
)
_UPPER, _DIGIT, _STOP, _COMMA = range(65, 91), range(48, 58), [46], [44]
_MARK, _BLANK = [33, 34, 39, 40, 41, 45, 47, 58, 59, 63], [9, 10, 11, 12, 13, 32]
_SYMBOL = [35, 36, 37, 38, 42, 43, 60, 61, 62, 64, 91, 92, 93, 94, 95, 96, 123, 124, 125, 126]


def statistics(text: str) -> list[float]:
    """The transformed statistics of one whole text: logarithms of sizes, square
    roots of shares."""
    if not text:
        return [0.0] * len(STATISTICS)
    count = np.bincount(np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8), minlength=256)
    size = float(count.sum())
    share = lambda codes: float(count[codes].sum()) / size
    words = text.split()
    n = max(len(words), 1)
    lengths = np.fromiter(map(len, words), dtype=np.float64, count=len(words)) if words else np.zeros(1)
    following = words[1:]
    lines = text.split("\n")
    p = count[count > 0] / size
    raw = [
        np.log1p(len(words)) / 4.0,
        np.log1p(lengths.mean()),
        np.log1p(lengths.std()),
        len(set(words)) / n,
        len(set(zip(words, following))) / max(n - 1, 1),  # noqa: B905 - pairs of neighbours
        np.sqrt(sum(map(operator.eq, words, following)) / n),
        np.sqrt(share(_UPPER)),
        np.sqrt(share(_DIGIT)),
        np.sqrt(share(_STOP)),
        np.sqrt(share(_COMMA)),
        np.sqrt(share(_MARK)),
        np.sqrt(share(_SYMBOL)),
        np.sqrt(float(count[128:].sum()) / size),
        np.sqrt(share(_BLANK)),
        np.log1p(len(lines)) / 4.0,
        len(set(lines)) / len(lines),
        float(-(p * np.log2(p)).sum()) / 4.0,
        np.sqrt(float((lengths > 15).sum()) / n),
    ]
    return [float(x) for x in raw]


def _statistics(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for b in batches:
        f = pa.array([statistics(t or "") for t in b.column("text").to_pylist()], type=pa.list_(pa.float64()))
        yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), f], names=["doc_id", "held_out", "f"])


def document_statistics(docs: DataFrame) -> DataFrame:
    """``doc_id, held_out, f`` for every row, written once: fitting and scoring read it."""
    kind = docs.schema["doc_id"].dataType.simpleString()
    rows = docs.select("doc_id", held_out().alias("held_out"), "text")
    return materialize(rows.mapInArrow(_statistics, f"doc_id {kind}, held_out boolean, f array<double>"), "statistics")


def _matrix(column: pa.ListArray) -> np.ndarray:
    return column.flatten().to_numpy(zero_copy_only=False).reshape(len(column), len(STATISTICS))


def _sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    d = len(STATISTICS)
    total = np.zeros((2, 1 + d + d * d))
    for b in batches:
        x, y = _matrix(b.column("f")), b.column("__y").to_numpy(zero_copy_only=False)
        for k in (0, 1):
            own = x[y == k]
            total[k] += np.concatenate([[len(own)], own.sum(axis=0), (own.T @ own).ravel()])
    yield pa.RecordBatch.from_arrays([pa.array([0, 1], type=pa.int32()), pa.array(total.tolist(), type=pa.list_(pa.float64()))], names=["__y", "__sums"])


@dataclass(frozen=True)
class Discriminant:
    """Means, inverted Cholesky factors and constants of the two classes."""

    mean: np.ndarray
    white: np.ndarray
    constant: np.ndarray
    fallback: float | None = None

    def score(self, x: np.ndarray) -> np.ndarray:
        if self.fallback is not None:
            return np.full(len(x), self.fallback)
        density = [c - 0.5 * np.square((x - m) @ w.T).sum(axis=1) for m, w, c in zip(self.mean, self.white, self.constant, strict=True)]
        return 1.0 / (1.0 + np.exp(-np.clip(density[1] - density[0], -35.0, 35.0)))


def fit(sums: np.ndarray) -> Discriminant:
    """From the (2, 1 + d + d*d) sums: count, sum and products of each class."""
    d = len(STATISTICS)
    n = sums[:, 0]
    if min(n) == 0:
        share = float(n[1] / n.sum()) if n.sum() else 0.5
        return Discriminant(np.zeros((2, d)), np.zeros((2, d, d)), np.zeros(2), share)
    mean = sums[:, 1 : 1 + d] / n[:, None]
    cov = sums[:, 1 + d :].reshape(2, d, d) / n[:, None, None] - mean[:, :, None] * mean[:, None, :]
    pooled = (cov * n[:, None, None]).sum(axis=0) / n.sum()
    white, constant = [], []
    for k in (0, 1):
        c = (1 - TO_POOLED) * cov[k] + TO_POOLED * pooled
        c = (1 - TO_DIAGONAL) * c + TO_DIAGONAL * np.diag(np.diag(c))
        c += RIDGE * (np.trace(pooled) / d + 1e-9) * np.eye(d)
        factor = np.linalg.cholesky(c)
        white.append(np.linalg.inv(factor))
        constant.append(np.log(n[k] / n.sum()) - np.log(np.diag(factor)).sum())
    return Discriminant(mean, np.array(white), np.array(constant))


def train(stats: DataFrame, labels: DataFrame, *, label: str = "quality") -> Discriminant:
    """Fit on every labelled document that is not held out."""
    d = len(STATISTICS)
    known = stats.where(~F.col("held_out")).join(one_label(labels, label), F.col("doc_id") == F.col("__id")).select("__y", "f")
    parts = known.mapInArrow(_sums, "__y int, __sums array<double>").select("__y", F.posexplode("__sums").alias("__i", "__v"))
    sums = np.zeros((2, 1 + d + d * d))
    for y, i, v in parts.groupBy("__y", "__i").agg(F.sum("__v")).collect():  # 2 * (1 + d + d * d) rows
        sums[y, i] = v
    return fit(sums)


def quality_scores(stats: DataFrame, model: Discriminant, *, threshold: float = THRESHOLD) -> DataFrame:
    """One row per document: ``doc_id, held_out, score, predicted``."""

    def score(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            p = model.score(_matrix(b.column("f")))
            yield pa.RecordBatch.from_arrays([b.column("doc_id"), b.column("held_out"), pa.array(p)], names=["doc_id", "held_out", "score"])

    scored = stats.mapInArrow(score, f"doc_id {stats.schema['doc_id'].dataType.simpleString()}, held_out boolean, score double")
    return scored.withColumn("predicted", F.when(F.col("score") >= threshold, 1).otherwise(0))
