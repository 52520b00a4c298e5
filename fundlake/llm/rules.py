"""Quality rules: fixed limits on document statistics, then boosted trees over the same statistics.

Statistics are computed for a batch of whole texts at a time, without a loop over texts: words and lines of the batch are
numbered by their content (exactly, not by hashes), and runs of five words get numbers from the numbers of their words.

The trees are grown on the driver from a bounded number of labelled rows (``TRAINING_ROWS``, in the order of a hash of the
id), one histogram of gradients per feature and node. On chosen features (``FALLING``) a score may only fall as the feature
rises: a split against that is refused, and both sides of a split on such a feature keep to their side of its middle in
all later splits. Grown trees are flattened into arrays with one row per tree, children of node ``i`` at ``2i + 1`` and
``2i + 2``; scoring walks all trees of all rows of a batch down one level at a time.

Defined results: a null text has no words and fails the fixed limits; rows repeat as often as in the input; a null id is
never learned from; without labels of both kinds every score is the smoothed share of good labels, 0.5 without any;
columns that are not named are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pandas as pd
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm.common import first_by_hash, prepare, read, stage
from fundlake.llm.quality import held_out

TRAINING_ROWS = 20_000
LEAST_WORDS, MOST_REPEATED = 10, 20  # words, and percent of words in repeated windows
WINDOW = 5
COUNTS = ("n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words")
FEATURES = (
    "log_words", "word_length", "symbols", "dup_lines", "repeats", "echoes", "distinct", "short", "long", "capitals",
    "lettered", "bars", "digits", "stops", "line_words", "ended_lines", "non_ascii", "word_bytes",
)
#: Features of which more is never better.
FALLING = ("symbols", "dup_lines", "repeats", "echoes", "bars")


def _numbers(values: np.ndarray) -> np.ndarray:
    """Values numbered in the order in which they first occur."""
    return pd.factorize(values)[0].astype(np.int64)


def _pieces(lists: pa.Array) -> tuple[pa.Array, np.ndarray]:
    """The strings of all lists, and for each the list it is from."""
    return pc.list_flatten(lists), pc.list_parent_indices(lists).to_numpy().astype(np.int64)


def _repeated_windows(codes: np.ndarray, doc: np.ndarray) -> np.ndarray:
    """For each word whether a window over it occurs twice or more in its document."""
    covered = np.zeros(len(codes) + 1, np.int64)
    start = np.flatnonzero(doc[: 1 - WINDOW] == doc[WINDOW - 1 :]) if len(doc) >= WINDOW else np.empty(0, np.int64)
    if len(start):
        width = int(codes.max()) + 1
        window = codes[start]
        for k in range(1, WINDOW):
            window = _numbers(window * width + codes[start + k])
        window = _numbers(window * (int(doc.max()) + 1) + doc[start])
        twice = start[np.bincount(window)[window] > 1]
        covered += np.bincount(twice, minlength=len(covered)) - np.bincount(twice + WINDOW, minlength=len(covered))
    return covered.cumsum()[:-1] > 0


def statistics(texts: pa.Array) -> dict[str, np.ndarray]:
    """``COUNTS`` (whole numbers) and ``FEATURES`` of each text; null is as empty."""
    texts = pc.fill_null(texts.cast(pa.string()), "")
    n = len(texts)
    total = lambda at, weights=None: np.bincount(at, weights, n)
    number = lambda array: array.to_numpy(zero_copy_only=False).astype(np.int64)
    flag = lambda array: array.to_numpy(zero_copy_only=False).astype(bool)

    words, doc = _pieces(pc.ascii_split_whitespace(texts))
    full = number(pc.binary_length(words)) > 0  # white space at either end leaves an empty piece
    words, doc = words.filter(pa.array(full)), doc[full]
    codes = number(words.dictionary_encode().indices)
    length, size = number(pc.utf8_length(words)), number(pc.binary_length(words))
    n_words, word_chars = total(doc), total(doc, length).astype(np.int64)
    repeated = total(doc[_repeated_windows(codes, doc)])

    lines, of = _pieces(pc.split_pattern(texts, "\n"))
    worded = flag(pc.match_substring_regex(lines, r"[^\x20\x09-\x0D]"))
    key = _numbers(number(lines.dictionary_encode().indices) * max(1, n) + of)
    seen = key <= np.concatenate([[-1], np.maximum.accumulate(key)[:-1]]) if len(key) else np.zeros(0, bool)
    n_dup_lines, worded_lines = total(of[seen & worded]), total(of[worded])
    ended = flag(pc.match_substring_regex(lines, r"[.!?:;][\x20\x09-\x0D\x22'”»)]*$"))

    symbols = number(pc.count_substring_regex(texts, "[#*$%&|<>]"))
    same = np.flatnonzero((codes[1:] == codes[:-1]) & (doc[1:] == doc[:-1]))
    per_word = np.maximum(1, n_words)
    first = np.unique(codes * max(1, n) + doc, return_index=True)[1]
    share = lambda chosen: total(doc[chosen]) / per_word
    found = {
        "n_words": n_words, "word_chars": word_chars, "n_symbols": symbols, "n_dup_lines": n_dup_lines, "n_repeat_words": repeated,
        "log_words": np.log1p(n_words), "word_length": word_chars / per_word, "symbols": symbols / per_word,
        "dup_lines": n_dup_lines / np.maximum(1, worded_lines), "repeats": repeated / per_word, "echoes": total(doc[same]) / per_word,
        "distinct": total(doc[first]) / per_word**0.8, "short": share(length <= 3), "long": share(length > 12),
        "capitals": share(flag(pc.utf8_is_upper(words))), "lettered": share(flag(pc.match_substring_regex(words, r"\pL"))),
        "bars": number(pc.count_substring(texts, "|")) / per_word, "digits": number(pc.count_substring_regex(texts, "[0-9]")) / np.maximum(1, word_chars),
        "stops": number(pc.count_substring_regex(texts, "[.!?]")) / per_word, "line_words": np.log1p(n_words / np.maximum(1, worded_lines)),
        "ended_lines": total(of[ended & worded]) / np.maximum(1, worded_lines),
        "non_ascii": share(size > length), "word_bytes": total(doc, size) / np.maximum(1, word_chars),
    }
    return {name: values.astype(np.int64 if name in COUNTS else np.float64) for name, values in found.items()}


def described(docs: DataFrame) -> DataFrame:
    """doc_id with counts and features of every whole text."""

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = statistics(batch.column("text"))
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *(pa.array(found[x]) for x in names)], ["doc_id", *names])

    names = (*COUNTS, *FEATURES)
    kinds = ", ".join([f"{x} long" for x in COUNTS] + [f"{x} double" for x in FEATURES])
    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return source.mapInArrow(compute, f"doc_id long, {kinds}")


@dataclass
class Trees:
    """Boosted trees as arrays: ``feature``, ``threshold`` and ``value`` per tree and node. A row goes left where its
    feature is at most the threshold; a node that is not split sends every row left to a child of its own value."""

    base: float
    depth: int
    feature: np.ndarray
    threshold: np.ndarray
    value: np.ndarray

    def score(self, rows: np.ndarray) -> np.ndarray:
        node = np.zeros((len(rows), len(self.feature)), np.int64)
        tree, row = np.arange(len(self.feature))[None, :], np.arange(len(rows))[:, None]
        for _ in range(self.depth):
            right = rows[row, self.feature[tree, node]] > self.threshold[tree, node]
            node = 2 * node + 1 + right
        total = self.base + self.value[tree, node].sum(axis=1)
        return 1 / (1 + np.exp(-np.clip(total, -30, 30)))


@dataclass
class _Node:
    at: int
    rows: np.ndarray
    low: float
    high: float


def fit(
    rows: np.ndarray, labels: np.ndarray, direction: np.ndarray | None = None, trees: int = 80, depth: int = 4, bins: int = 48,
    rate: float = 0.2, ridge: float = 2.0, least: float = 3.0,
) -> Trees:
    """Grow trees from rows and 0/1 labels. ``direction`` is -1 (1) for features in which the score may only fall (rise).
    A side of a split has at least ``least`` rows' worth of weight (four times the second derivative)."""
    good, width = labels.sum(), rows.shape[1]
    direction = np.zeros(width, np.int64) if direction is None else direction
    base = math.log((good + 1) / (len(labels) - good + 1))
    shape = (trees if 0 < good < len(labels) else 0, 2 ** (depth + 1) - 1)
    model = Trees(base, depth, np.zeros(shape, np.int64), np.full(shape, np.inf), np.zeros(shape))
    if not shape[0]:
        return model
    edges = [np.unique(np.quantile(rows[:, k], np.linspace(0, 1, bins + 1)[1:-1], method="lower")) for k in range(width)]
    binned = np.stack([np.searchsorted(e, rows[:, k], side="left") for k, e in enumerate(edges)], axis=1)
    flat = binned + np.arange(width) * bins
    inner = np.arange(bins - 1)[None, :] < np.array([len(e) for e in edges])[:, None]
    total = np.full(len(labels), base)
    for t in range(trees):
        p = 1 / (1 + np.exp(-total))
        gradient, weight = labels - p, p * (1 - p)
        open_nodes = [_Node(0, np.arange(len(labels)), -np.inf, np.inf)]
        for level in range(depth + 1):
            following = []
            for node in open_nodes:
                g, h = gradient[node.rows], weight[node.rows]
                own = float(np.clip(g.sum() / (h.sum() + ridge), node.low, node.high))
                model.value[t, node.at] = own
                cut = _best_split(flat[node.rows], g, h, node, direction, bins, inner, ridge, least / 4) if level < depth else None
                if cut is None:
                    # Every row goes left, down to the last level.
                    at = node.at
                    for _ in range(depth - level):
                        at = 2 * at + 1
                        model.value[t, at] = own
                    total[node.rows] += rate * own
                    continue
                k, place, left, right = cut
                model.feature[t, node.at], model.threshold[t, node.at] = k, edges[k][place]
                middle, goes_left = (left + right) / 2, binned[node.rows, k] <= place
                low, high = (node.low, node.high), (node.low, node.high)
                if direction[k]:
                    low, high = ((middle, node.high), (node.low, middle)) if direction[k] < 0 else ((node.low, middle), (middle, node.high))
                following.append(_Node(2 * node.at + 1, node.rows[goes_left], *low))
                following.append(_Node(2 * node.at + 2, node.rows[~goes_left], *high))
            open_nodes = following
    model.value *= rate
    return model


def _best_split(
    flat: np.ndarray, g: np.ndarray, h: np.ndarray, node: _Node, direction: np.ndarray, bins: int, inner: np.ndarray, ridge: float, least: float,
) -> tuple[int, int, float, float] | None:
    """Feature, bin and values of both sides of the split that gains most without breaking a direction."""
    width = flat.shape[1]
    spread = lambda x: np.bincount(flat.ravel(), np.repeat(x, width), width * bins).reshape(width, bins).cumsum(axis=1)
    gl, hl = spread(g)[:, :-1], spread(h)[:, :-1]
    gr, hr = g.sum() - gl, h.sum() - hl
    left, right = (np.clip(a / (b + ridge), node.low, node.high) for a, b in ((gl, hl), (gr, hr)))
    worth = lambda a, b, v: 2 * a * v - (b + ridge) * v**2
    own = np.clip(g.sum() / (h.sum() + ridge), node.low, node.high)
    gain = worth(gl, hl, left) + worth(gr, hr, right) - worth(g.sum(), h.sum(), own)
    gain[~inner | (hl < least) | (hr < least) | ((right - left) * direction[:, None] < 0)] = -np.inf
    k, place = np.unravel_index(gain.argmax(), gain.shape)
    return (int(k), int(place), float(left[k, place]), float(right[k, place])) if gain[k, place] > 1e-6 else None


def train(stats: DataFrame, labels: DataFrame, rows: int = TRAINING_ROWS) -> Trees:
    """Grow trees on at most ``rows`` labelled rows that are not held out (CRC-32 of the id, modulo 3, is not 1). Labels
    other than 0 and 1 are left out; of several labels of one document the larger counts."""
    known = labels.where("quality in (0, 1) and doc_id is not null").groupBy("doc_id").agg(F.max("quality").alias("label"))
    labelled = stats.join(known.where(~held_out()), "doc_id")
    sample = first_by_hash(labelled, rows, labelled.count(), "doc_id", *FEATURES)
    got = sample.select("label", *FEATURES).toPandas().to_numpy(dtype=np.float64).reshape(-1, 1 + len(FEATURES))
    return fit(got[:, 1:], got[:, 0], np.array([-1 if name in FALLING else 0 for name in FEATURES]))


def apply_rules(docs: DataFrame, labels: DataFrame, training_rows: int = TRAINING_ROWS) -> DataFrame:
    """doc_id, the counts, base_failed, kept, held_out, and score (0 to 1, higher: label 1 likelier) of every whole text."""
    prepare(docs.sparkSession)
    stats = stage(described(docs), "statistics")
    shared = stats.sparkSession.sparkContext.broadcast(train(stats, labels, training_rows))

    def compute(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            values = np.stack([batch.column(name).to_numpy() for name in FEATURES], axis=1)
            columns = [batch.column(name) for name in ("doc_id", *COUNTS)]
            yield pa.RecordBatch.from_arrays([*columns, pa.array(shared.value.score(values))], ["doc_id", *COUNTS, "score"])

    scored = stats.mapInArrow(compute, "doc_id long, " + ", ".join(f"{x} long" for x in COUNTS) + ", score double")
    failed = (F.col("n_words") < LEAST_WORDS) | (100 * F.col("n_repeat_words") > MOST_REPEATED * F.col("n_words"))
    return scored.select(
        "doc_id", *COUNTS, failed.alias("base_failed"), (~failed & (F.col("score") >= 0.5)).alias("kept"), held_out().alias("held_out"), "score"
    )


def op12_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", doc_id="long", text="string")
    return apply_rules(docs, read(spark, sf_dir, "labels", doc_id="long", quality="int"))
