"""Quality classifier: a generalised additive model with pairwise interactions.

Every text becomes a row of numbers that say how it is written. Numbers are cut into bins at quantiles of the training
rows. Shallow trees, one feature at a time and round after round, are boosted into one lookup table per feature; then
trees over pairs of features into one table per chosen pair. A score is the sum of the table entries of a row's bins,
put through the logistic function: a few vectorised additions a row, whatever the number of trees was.

The model is fitted on the driver from a bounded number of labelled rows (``TRAINING_ROWS``, taken in the order of a hash
of the id, so the same rows at any partitioning); statistics and scores cover every row.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass, field
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm.common import first_by_hash, read, rows_of, stage

TRAINING_ROWS = 20_000
FEATURES = (
    "log_chars", "chars_per_word", "distinct_words", "repeated_word", "short_words", "long_words", "upper", "digits",
    "sentence_marks", "other_marks", "bars", "non_ascii", "spaces", "words_per_line", "repeated_lines", "words_per_stop",
)

_CODES = np.arange(256)
_LETTERS = [c for c in range(256) if chr(c).isalpha()]
_UPPER = [c for c in range(256) if chr(c).isupper()]
_SENTENCE = [ord(c) for c in ".,;:?'\"-"]
_SPACES = [c for c in range(256) if chr(c).isspace()]
_OTHERS = [c for c in range(33, 127) if not chr(c).isalnum() and c not in _SENTENCE and c != ord("|")]


def describe(text: str) -> tuple[float, ...]:
    """The numbers in ``FEATURES`` for a whole text; all zero for an empty one."""
    if not text:
        return (0.0,) * len(FEATURES)
    codes = np.frombuffer(text.encode("utf-32-le", "replace"), np.uint32)
    seen = np.bincount(np.minimum(codes, 255), minlength=256)
    words, lines = text.split(), text.split("\n")
    n, count, rows = len(codes), max(1, len(words)), len(lines)
    lengths = np.fromiter(map(len, words), np.int64, len(words))
    return (
        math.log1p(n),
        n / count,
        len(set(words)) / count**0.8,
        sum(map(str.__eq__, words, words[1:])) / count,
        float((lengths <= 3).sum()) / count,
        float((lengths > 12).sum()) / count,
        float(seen[_UPPER].sum()) / max(1, seen[_LETTERS].sum()),
        float(seen[48:58].sum()) / n,
        float(seen[_SENTENCE].sum()) / count,
        float(seen[_OTHERS].sum()) / count,
        float(seen[ord("|")]) / count,
        float((codes > 127).sum()) / n,
        float(seen[_SPACES].sum()) / n,
        math.log1p(count / rows),
        1 - len(set(lines)) / rows,
        count / (1 + float(seen[ord(".")])),
    )


def described(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the features of every whole text (null: empty)."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            table = np.array([describe(text or "") for (text,) in rows_of(batch, "text")], dtype=np.float64)
            columns = table.reshape(-1, len(FEATURES)).T
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *map(pa.array, columns)], ["doc_id", *FEATURES])

    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return source.mapInArrow(compute, "doc_id long, " + ", ".join(f"{name} double" for name in FEATURES))


def _leaf(gradient: np.ndarray, weight: np.ndarray, ridge: float) -> np.ndarray:
    return gradient / (weight + ridge)


@dataclass
class AdditiveModel:
    """Lookup tables per feature and per pair of features."""

    edges: list[np.ndarray] = field(default_factory=list)
    intercept: float = 0.0
    tables: list[np.ndarray] = field(default_factory=list)
    pairs: list[tuple[int, int]] = field(default_factory=list)
    pair_tables: list[np.ndarray] = field(default_factory=list)

    def bins(self, values: np.ndarray) -> np.ndarray:
        return np.stack([np.searchsorted(e, values[:, k], side="right") for k, e in enumerate(self.edges)], axis=1)

    def score(self, values: np.ndarray) -> np.ndarray:
        if not self.edges:
            return np.full(len(values), 1 / (1 + math.exp(-self.intercept)))
        bins = self.bins(values)
        total = np.full(len(values), self.intercept)
        for k, table in enumerate(self.tables):
            total += table[bins[:, k]]
        for (a, b), table in zip(self.pairs, self.pair_tables, strict=True):
            total += table[bins[:, a], bins[:, b]]
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


def _stump(gradient: np.ndarray, weight: np.ndarray, leaves: int, ridge: float) -> np.ndarray:
    """Value per bin of a tree over one feature, split where it gains most until it has ``leaves`` leaves."""
    g, h = np.concatenate([[0], np.cumsum(gradient)]), np.concatenate([[0], np.cumsum(weight)])
    cuts = [0, len(gradient)]
    for _ in range(leaves - 1):
        best, where = 1e-9, None
        for lo, hi in zip(cuts, cuts[1:]):
            mid = np.arange(lo + 1, hi)
            if not len(mid):
                continue
            left, right, whole = g[mid] - g[lo], g[hi] - g[mid], g[hi] - g[lo]
            hl, hr, hw = h[mid] - h[lo], h[hi] - h[mid], h[hi] - h[lo]
            gain = left**2 / (hl + ridge) + right**2 / (hr + ridge) - whole**2 / (hw + ridge)
            if gain.max() > best:
                best, where = gain.max(), mid[gain.argmax()]
        if where is None:
            break
        cuts = sorted([*cuts, int(where)])
    out = np.empty(len(gradient))
    for lo, hi in zip(cuts, cuts[1:]):
        out[lo:hi] = _leaf(g[hi] - g[lo], h[hi] - h[lo], ridge)
    return out


def _quadrants(gradient: np.ndarray, weight: np.ndarray, ridge: float) -> tuple[float, np.ndarray]:
    """Gain and values per cell of the best tree that cuts each of two features once."""
    pad = lambda x: np.pad(x.cumsum(0).cumsum(1), ((1, 0), (1, 0)))
    g, h = pad(gradient), pad(weight)
    a, b = g[1:-1, 1:-1], h[1:-1, 1:-1]
    if not a.size:
        return 0.0, np.zeros_like(gradient)
    parts = [
        (a, b), (g[1:-1, -1:] - a, h[1:-1, -1:] - b), (g[-1:, 1:-1] - a, h[-1:, 1:-1] - b),
        (g[-1, -1] - g[1:-1, -1:] - g[-1:, 1:-1] + a, h[-1, -1] - h[1:-1, -1:] - h[-1:, 1:-1] + b),
    ]
    gain = sum(x**2 / (y + ridge) for x, y in parts)
    i, j = np.unravel_index(gain.argmax(), gain.shape)
    values = [_leaf(x[i, j], y[i, j], ridge) for x, y in (np.broadcast_arrays(x, y) for x, y in parts)]
    out = np.empty_like(gradient)
    out[: i + 1, : j + 1], out[: i + 1, j + 1 :], out[i + 1 :, : j + 1], out[i + 1 :, j + 1 :] = values
    return float(gain[i, j]), out


def fit(
    values: np.ndarray, labels: np.ndarray, bins: int = 32, rounds: int = 150, pairs: int = 10, pair_rounds: int = 60,
    rate: float = 0.15, leaves: int = 3, ridge: float = 1.0,
) -> AdditiveModel:
    """Boost tables from rows and 0/1 labels. With rows of one label, or none, the score is the (smoothed) prior."""
    model = AdditiveModel(intercept=math.log((labels.sum() + 1) / (len(labels) - labels.sum() + 1)))
    if not 0 < labels.sum() < len(labels):
        return model
    steps = np.linspace(0, 1, bins + 1)[1:-1]
    model.edges = [np.unique(np.quantile(values[:, k], steps)) for k in range(values.shape[1])]
    at, total = model.bins(values), np.full(len(labels), model.intercept)
    sizes = [len(e) + 1 for e in model.edges]
    model.tables = [np.zeros(size) for size in sizes]

    def residuals() -> tuple[np.ndarray, np.ndarray]:
        p = 1 / (1 + np.exp(-total))
        return labels - p, p * (1 - p)

    for _ in range(rounds):
        for k, size in enumerate(sizes):
            gradient, weight = residuals()
            tree = rate * _stump(
                np.bincount(at[:, k], gradient, size), np.bincount(at[:, k], weight, size), leaves, ridge
            )
            model.tables[k] += tree
            total += tree[at[:, k]]

    def cells(a: int, b: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        where, shape = at[:, a] * sizes[b] + at[:, b], (sizes[a], sizes[b])
        gradient, weight = residuals()
        return where, *(np.bincount(where, x, shape[0] * shape[1]).reshape(shape) for x in (gradient, weight))

    gains = {(a, b): _quadrants(*cells(a, b)[1:], ridge)[0] for a, b in combinations(range(len(sizes)), 2)}
    model.pairs = sorted(gains, key=gains.get, reverse=True)[:pairs]
    model.pair_tables = [np.zeros((sizes[a], sizes[b])) for a, b in model.pairs]
    for _ in range(pair_rounds):
        for table, (a, b) in zip(model.pair_tables, model.pairs, strict=True):
            where, gradient, weight = cells(a, b)
            tree = rate * _quadrants(gradient, weight, ridge)[1]
            table += tree
            total += tree.ravel()[where]
    return model


def held_out(doc_id: str = "doc_id") -> Column:
    """Rows that no model may learn from; a null id is not held out and not learned from either."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string").cast("binary")) % 3 == 1, F.lit(False))


def train(features: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> AdditiveModel:
    """Fit on at most ``rows`` labelled rows that are not held out. Labels other than 0 and 1 are left out; of several
    labels of one document the larger counts."""
    known = (
        labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("label"))
    ).where(~held_out())
    labelled = features.join(known, "doc_id")
    sample = first_by_hash(labelled, rows, labelled.count(), "doc_id", *FEATURES)
    got = sample.select("label", *FEATURES).toPandas().to_numpy(dtype=np.float64).reshape(-1, 1 + len(FEATURES))
    return fit(got[:, 1:], got[:, 0])


def score_features(features: DataFrame, model: AdditiveModel) -> DataFrame:
    """``doc_id``, score and predicted for every row of ``features``."""
    shared = features.sparkSession.sparkContext.broadcast(model)

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.stack([batch.column(name).to_numpy() for name in FEATURES], axis=1)
            scores = shared.value.score(values)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), pa.array(scores), pa.array((scores >= 0.5).astype(np.int32))],
                ["doc_id", "score", "predicted"],
            )

    return features.mapInArrow(compute, "doc_id long, score double, predicted int")


def score_quality(docs: DataFrame, labels: DataFrame, training_rows: int = TRAINING_ROWS) -> DataFrame:
    """doc_id, held_out, score (0 to 1, higher: label 1 likelier) and predicted (score >= 0.5) of every whole text.

    A null text is scored as an empty one. Rows repeat as often as in ``docs``. Without labels every score is 0.5.
    """
    features = stage(described(docs), "features")
    scored = score_features(features, train(features, labels, training_rows))
    return scored.select("doc_id", held_out().alias("held_out"), "score", "predicted")


def op10_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", doc_id="long", text="string")
    return score_quality(docs, read(spark, sf_dir, "labels", doc_id="long", quality="int"))
