"""Quality classifier: regularised quadratic discriminant analysis.

Every whole text becomes a vector of transformed statistics (logarithms of
lengths, log-odds of shares), counted from its bytes and words in one pass.
Training is a distributed aggregation: each task adds up counts, sums and
outer products of the labelled rows it has, per class, and the partial sums (a
matrix of d x d numbers, whatever the input) are added up. All labelled
training rows are used.

A class covariance is shrunk twice: towards the pooled covariance
(``pool``) and towards its own mean variance times the identity (``ridge``).
Its Cholesky factor is computed once and cached in the model. The score is
the logistic function of the difference of log densities, each from the
Mahalanobis distance by one triangular solve, plus the log prior odds.

Texts are the only input of a score. Null and empty texts have the statistics
of an empty text. A missing class (or no labelled rows at all) leaves no
discriminant: then every score is the share of label 1, or 0.5 without
labels. Repeated rows are scored one by one, null ids are kept, labels that
are null are no labels; of an id labelled more than once each label counts.
An empty input gives an empty result.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import to_arrow_type

from quaybook.llm.common import pick, prepare

THRESHOLD = 0.3
POOL, RIDGE = 0.2, 0.05
FOLDS = 5
BLOCK = 256  # texts whose vectors are held at once

FEATURES = ("log_words", "log_word_length", "distinct_words", "top_word", "repeated_neighbours", "upper", "digit",
            "punctuation", "symbol", "space_words", "short_words", "repeated_lines", "words_a_line", "word_ends")

_KIND = np.zeros(256, dtype=np.uint8)  # 1 lower or other letter, 2 upper, 3 digit, 4 sentence mark, 5 symbol, 6 space
_KIND[0x21:0x7F] = 5
_KIND[0x30:0x3A] = 3
_KIND[0x41:0x5B] = 2
_KIND[0x61:0x7B] = 1
_KIND[0x80:] = 1
_KIND[[0x20, *range(0x09, 0x0E)]] = 6
_KIND[[ord(c) for c in ".,;:'\"-()"]] = 4


def _share(part: float, whole: float) -> float:
    """A share's log-odds, kept finite."""
    p = part / whole if whole else 0.0
    return float(np.log((p + 0.005) / (1.005 - p)))


def statistics(text: str) -> list[float]:
    """The vector of one text, in the order of ``FEATURES``."""
    data = np.frombuffer(text.encode("utf-8", "replace"), dtype=np.uint8)
    kinds = np.bincount(_KIND[data], minlength=7)
    words = text.split()
    n, size = len(words), max(len(data), 1)
    counts: dict[str, int] = {}
    for w in words:
        counts[w] = counts.get(w, 0) + 1
    lines = [x for x in text.split("\n") if x]
    marks = kinds[4] + kinds[5]
    return [
        float(np.log1p(n)), float(np.log1p(len(text) / (n + 1))),
        _share(len(counts), max(n, 1)) if n else 0.0, _share(max(counts.values(), default=0), max(n, 1)),
        _share(sum(a == b for a, b in zip(words, words[1:])), max(n - 1, 1)),
        _share(kinds[2], size), _share(kinds[3], size), _share(kinds[4], size), _share(kinds[5], size),
        _share(kinds[6], size), _share(sum(len(w) <= 2 for w in words), max(n, 1)),
        _share(len(lines) - len(set(lines)), max(len(lines), 1)), float(np.log1p(n / (len(lines) + 1))),
        _share(min(marks, n), max(n, 1)),
    ]


@dataclass(frozen=True)
class Discriminant:
    """Means, cached Cholesky factors and log determinants of both classes;
    without factors, ``prior`` is the score."""

    prior: float
    mean: np.ndarray | None = None  # 2 x d
    factor: np.ndarray | None = None  # 2 x d x d, lower triangular
    centre: np.ndarray | None = None
    scale: np.ndarray | None = None

    def scores(self, vectors: np.ndarray) -> np.ndarray:
        if self.factor is None:
            return np.full(len(vectors), self.prior)
        z = (vectors - self.centre) / self.scale
        logs = []
        for mean, factor in zip(self.mean, self.factor, strict=True):
            away = np.linalg.solve(factor, (z - mean).T)
            logs.append(-0.5 * (away ** 2).sum(axis=0) - np.log(np.diag(factor)).sum())
        margin = logs[1] - logs[0] + np.log(self.prior / (1 - self.prior))
        return 1 / (1 + np.exp(-np.clip(margin, -500, 500)))


def fit_moments(n: np.ndarray, sums: np.ndarray, squares: np.ndarray, pool: float = POOL, ridge: float = RIDGE) -> Discriminant:
    """The discriminant of per-class counts, sums and sums of outer products."""
    if n.sum() == 0 or (n == 0).any():
        return Discriminant(float(n[1] / n.sum()) if n.sum() else 0.5)
    total, d = n.sum(), sums.shape[1]
    centre = sums.sum(axis=0) / total
    scale = np.sqrt(np.maximum(np.diag(squares.sum(axis=0)) / total - centre ** 2, 1e-6))
    mean = (sums / n[:, None] - centre) / scale
    own = np.stack([((squares[c] - np.outer(sums[c], sums[c]) / n[c]) / n[c]) / np.outer(scale, scale) for c in (0, 1)])
    pooled = (own * n[:, None, None]).sum(axis=0) / total
    factors = []
    for c in (0, 1):
        s = (1 - pool) * own[c] + pool * pooled
        s = (1 - ridge) * s + ridge * max(np.trace(s) / d, 1e-3) * np.eye(d)
        factors.append(np.linalg.cholesky((s + s.T) / 2))
    return Discriminant(float(n[1] / total), mean, np.stack(factors), centre, scale)


def _vectors(texts: pa.Array) -> Iterator[np.ndarray]:
    for at in range(0, len(texts), BLOCK):
        yield np.array([statistics(x.as_py() or "") for x in texts[at:at + BLOCK]]).reshape(-1, len(FEATURES))


def vectors(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, vector) of every row: the one pass over the texts."""
    prepare(docs.sparkSession)
    rows = pick(docs, doc_id=id_col, text=text_col)
    id_type = rows.schema["doc_id"].dataType
    arrow_id = to_arrow_type(id_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [v for x in _vectors(batch.column(1)) for v in x.tolist()]
            yield pa.RecordBatch.from_arrays([batch.column(0).cast(arrow_id), pa.array(found, pa.list_(pa.float64()))],
                                             names=["doc_id", "vector"])

    return rows.mapInArrow(run, f"doc_id {id_type.simpleString()}, vector array<double>")


def _matrix(column: pa.Array) -> np.ndarray:
    return np.array(column.to_pylist(), dtype=float).reshape(-1, len(FEATURES))


def fit(rows: DataFrame) -> Discriminant:
    """Fit on all of ``rows`` (vector, label): each task sends its partial
    sums for the classes it has seen, and the driver gets their totals."""
    d = len(FEATURES)

    def add_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, sums, squares = np.zeros(2), np.zeros((2, d)), np.zeros((2, d, d))
        for batch in batches:
            labels, x = batch.column(1).to_numpy(zero_copy_only=False), _matrix(batch.column(0))
            for c in (0, 1):
                own = x[labels == c]
                n[c] += len(own)
                sums[c] += own.sum(axis=0)
                squares[c] += own.T @ own
        parts = np.concatenate([n, sums.ravel(), squares.ravel()])
        yield pa.RecordBatch.from_arrays([pa.array(np.arange(len(parts)), pa.int32()), pa.array(parts)], names=["at", "part"])

    parts = (rows.where(F.col("label").isin(0, 1)).select("vector", "label").mapInArrow(add_up, "at int, part double")
             .groupBy("at").agg(F.sum("part").alias("part")).collect())
    flat = np.zeros(2 + 2 * d + 2 * d * d)
    for r in parts:
        flat[r["at"]] = r["part"]
    return fit_moments(flat[:2], flat[2:2 + 2 * d].reshape(2, d), flat[2 + 2 * d:].reshape(2, d, d))


def held_out(doc_id: Column) -> Column:
    """One fold of ids that is never trained on; null ids are not held out."""
    return F.coalesce(F.crc32(F.encode(doc_id.cast("string"), "UTF-8")) % FOLDS == 0, F.lit(False))


def training_rows(vectors_of: DataFrame, labels: DataFrame, id_col: str = "doc_id", label_col: str = "quality") -> DataFrame:
    """(vector, label) of the labelled rows outside the held-out fold."""
    known = (pick(labels, label_id=id_col, label=label_col)
             .where(F.col("label").isNotNull() & F.col("label_id").isNotNull() & ~held_out(F.col("label_id"))))
    return vectors_of.join(known, vectors_of["doc_id"] == known["label_id"]).select("vector", "label")


def score(vectors_of: DataFrame, model: Discriminant, threshold: float = THRESHOLD) -> DataFrame:
    """(doc_id, score, predicted) of every row of (doc_id, vector)."""
    id_type = vectors_of.schema["doc_id"].dataType
    arrow_id = to_arrow_type(id_type)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = model.scores(_matrix(batch.column(1)))
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).cast(arrow_id), pa.array(found), pa.array((found >= threshold).astype(np.int32))],
                names=["doc_id", "score", "predicted"])

    return vectors_of.select("doc_id", "vector").mapInArrow(
        run, f"doc_id {id_type.simpleString()}, score double, predicted int")


def accepted(docs: DataFrame, model: Discriminant, threshold: float = THRESHOLD, text_col: str = "text") -> DataFrame:
    """The rows of ``docs``, all their columns, that the model accepts."""
    prepare(docs.sparkSession)
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            parts = [model.scores(x) >= threshold for x in _vectors(batch.column(at))]
            if parts:
                yield batch.filter(pa.array(np.concatenate(parts)))

    return docs.mapInArrow(run, docs.schema)
