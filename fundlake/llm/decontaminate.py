"""Benchmark passages in documents, by the q-gram lemma.

Texts are compared as lower-case words with one space between them. If a document holds a passage of ``n`` characters
with at most ``k`` edits, it keeps at least n + 1 - q - k * q of the passage's runs of ``q`` characters, and all of those
lie within k neighbouring diagonals (place in the document less place in the passage). So shared runs are counted in
overlapping bands of diagonals, and only bands that reach the number are aligned, on the diagonals of the band, to get the
distance. Passages for which that number would be none take shorter runs; those of fewer than ``Q`` characters are looked
for as whole words, without edits.
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm.common import buckets_for, read, rows_of
from fundlake.llm.hashing import PLACES, U64, mix

Q, SHORT_Q = 8, 5
#: Edits allowed for each character of a passage.
EDITS = 0.1
#: Characters of passages that one pass over the documents looks for, and characters of documents looked at together.
PASSAGES_TOGETHER, TEXT_TOGETHER = 20_000_000, 400_000
#: Shared runs that are held at once.
RUNS_TOGETHER = 4_000_000
_FILTER_BITS = 22
_NOTHING = np.uint32(0xFFFFFFFF)
_BETWEEN = re.compile(r"[\W_]+")


def plain(text: str) -> str:
    return _BETWEEN.sub(" ", text.lower()).strip()


def _codes(text: str) -> np.ndarray:
    return np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)


def _grams(codes: np.ndarray, q: int = Q) -> np.ndarray:
    """Hash of the run of ``q`` characters that starts at each place."""
    count = max(0, len(codes) - q + 1)
    wide, out = codes.astype(U64), np.zeros(count, U64)
    for k in range(q):
        out += wide[k : k + count] * PLACES[k]
    return mix(out)


class Passages:
    """Index of the runs of ``q`` characters of a set of plain passages, none shorter than ``q``."""

    def __init__(self, items: list[tuple[int, str]], q: int = Q):
        self.q, self.ids, self.texts = q, [i for i, _ in items], [t for _, t in items]
        self.codes = [_codes(t) for t in self.texts]
        sizes = np.array([len(c) for c in self.codes], dtype=np.int64)
        self.edits = (sizes * EDITS).astype(np.int64)
        self.least = sizes + 1 - q - q * self.edits
        self.longest = int((sizes + 2 * self.edits).max(initial=0))
        grams = [_grams(c, q) for c in self.codes]
        every = np.concatenate([*grams, np.empty(0, U64)])
        item = np.repeat(np.arange(len(grams)), [len(g) for g in grams])
        place = np.concatenate([*(np.arange(len(g)) for g in grams), np.empty(0, np.int64)])
        order = np.argsort(every, kind="stable")
        self.grams, first = np.unique(every[order], return_index=True)
        self.first, self.item, self.place = np.append(first, len(every)), item[order], place[order]
        self.maybe = np.zeros(1 << _FILTER_BITS, bool)
        self.maybe[(self.grams >> U64(64 - _FILTER_BITS)).astype(np.int64)] = True

    def regions(self, codes: np.ndarray) -> Iterator[tuple[int, int, int]]:
        """Passage, first and last diagonal of every band of ``codes`` with enough shared runs. A band may come twice.

        Where a text shares more runs than are held at once it is cut in two that overlap by the longest passage; what
        is too short to cut is counted piece by piece.
        """
        if not len(self.grams):
            return
        hashes = _grams(codes, self.q)
        at = np.flatnonzero(self.maybe[(hashes >> U64(64 - _FILTER_BITS)).astype(np.int64)])
        found = np.searchsorted(self.grams, hashes[at])
        found[found == len(self.grams)] = 0
        known = self.grams[found] == hashes[at]
        at, found = at[known], found[known]
        count = self.first[found + 1] - self.first[found]
        total, overlap = int(count.sum()), self.longest + self.q
        if total > RUNS_TOGETHER and len(codes) > 4 * overlap:
            middle = len(codes) // 2
            yield from self.regions(codes[: middle + overlap])
            for passage, low, high in self.regions(codes[middle:]):
                yield passage, middle + low, middle + high
            return
        span = len(codes) + 2 * self.longest + 2
        keys, hits = np.empty(0, np.int64), np.empty(0, np.int64)
        cuts = np.searchsorted(np.cumsum(count), np.arange(1, -(-total // RUNS_TOGETHER)) * RUNS_TOGETHER)
        for piece in np.split(np.arange(len(at)), cuts):
            more, times = self._bands(at[piece], found[piece], count[piece], span)
            keys, where = np.unique(np.concatenate([keys, more]), return_inverse=True)
            hits = np.bincount(where, np.concatenate([hits, times]), len(keys)).astype(np.int64)
        enough = hits >= self.least[keys // span]
        for key in keys[enough].tolist():
            passage, band = divmod(key, span)
            width = int(self.edits[passage]) + 1
            yield passage, band * width - self.longest, (band + 2) * width - 1 - self.longest

    def _bands(self, at: np.ndarray, found: np.ndarray, count: np.ndarray, span: int) -> tuple[np.ndarray, np.ndarray]:
        """Bands (passage times ``span`` plus number) of the shared runs, and how many runs each has."""
        posting = np.repeat(self.first[found] - np.concatenate([[0], np.cumsum(count)[:-1]]), count) + np.arange(count.sum())
        item, width = self.item[posting], self.edits[self.item[posting]] + 1
        band = (np.repeat(at, count) - self.place[posting] + self.longest) // width
        return np.unique(np.concatenate([item * span + band, item * span + band - 1]), return_counts=True)


def aligned(passage: np.ndarray, text: np.ndarray, low: int, high: int, most: int) -> tuple[int, int] | None:
    """Least edits that turn ``passage`` into a part of ``text`` on the diagonals ``low`` to ``high``, and the part's end; None
    if over ``most``. A row of the table has one number per diagonal, whatever the length of the text."""
    width = high - low + 1
    around = np.full(len(passage) + width, _NOTHING)  # the text from place ``low`` on, and nothing beyond its ends
    begin, end = max(0, low), min(len(text), low + len(around))
    if begin < end:
        around[begin - low : end - low] = text[begin:end]
    row, steps = np.zeros(width, np.int32), np.arange(width, dtype=np.int32)
    for k, code in enumerate(passage.tolist()):
        new = row + (around[k : k + width] != code)
        new[:-1] = np.minimum(new[:-1], row[1:] + 1)
        row = np.minimum.accumulate(new - steps) + steps
        if row.min() > most:
            return None
    best = int(row.argmin())
    return int(row[best]), min(len(text), max(0, len(passage) + low + best))


class Benchmark:
    """Passages to look for: an index for long ones, one for short ones, and the shortest as whole words."""

    def __init__(self, items: list[tuple[int, str]]):
        texts = [(item, words) for item, text in items if (words := plain(text or ""))]
        reach = lambda t, q: len(t) >= q and len(t) + 1 - q - q * int(len(t) * EDITS) > 0
        long = [(i, t) for i, t in texts if reach(t, Q)]
        short = [(i, t) for i, t in texts if len(t) >= Q and not reach(t, Q)]
        self.indexes = [index for index in (Passages(long, Q), Passages(short, SHORT_Q)) if index.ids]
        self.words: dict[tuple[str, ...], list[int]] = {}
        for item, text in texts:
            if len(text) < Q:
                self.words.setdefault(tuple(text.split()), []).append(item)
        self.runs = sorted({len(words) for words in self.words})


def find(passages: Passages, text: str) -> dict[int, tuple[int, int, int]]:
    """Passages that ``text`` (as ``plain`` gives it) holds: edits, and start and end of the nearest place."""
    codes, best = _codes(text), {}
    step = TEXT_TOGETHER
    for begin in range(0, max(1, len(codes)), step):
        part = codes[begin : begin + step + passages.longest + passages.q]
        for item, low, high in passages.regions(part):
            own = passages.codes[item]
            start = max(0, begin + low)
            if (at := text.find(passages.texts[item], start, begin + high + len(own))) >= 0:
                edits, end = 0, at + len(own)
            elif (got := aligned(own, codes, begin + low, begin + high, int(passages.edits[item]))) is not None:
                edits, end = got
            else:
                continue
            hit = (edits, max(0, end - len(own)), end)
            best[item] = min(best.get(item, hit), hit)
    return best


def find_words(benchmark: Benchmark, text: str) -> dict[int, tuple[int, int, int]]:
    """Shortest passages, as ``find`` gives them: number in ``benchmark.words``, and the first place."""
    if not benchmark.runs:
        return {}
    words, hits = text.split(), {}
    starts, at = [], 0
    for word in words:
        starts.append(at)
        at += len(word) + 1
    for length in benchmark.runs:
        for k in range(len(words) - length + 1):
            for item in benchmark.words.get(tuple(words[k : k + length]), ()):
                stop = starts[k + length - 1] + len(words[k + length - 1])
                hits.setdefault(item, (0, starts[k], stop))
    return hits


def contaminations(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """doc_id, item_id, edits, start and stop (in the plain text) of every benchmark passage that a document holds.

    ``docs`` has doc_id and text, ``benchmark`` item_id and text. One edit in ten characters is allowed; passages of fewer
    than Q plain characters have to stand there as whole words. Null texts and those without a plain character take no
    part. Rows that repeat an id are looked at one by one. The benchmark is looked for in slices
    of bounded size, with a pass over the documents for each; there is one slice unless the benchmark is very large.
    """
    spark = docs.sparkSession
    source = docs.where("text is not null").select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    items = benchmark.where("text is not null").select(F.col("item_id").cast("long"), F.col("text").cast("string"))
    slices = buckets_for(items.agg(F.sum(F.length("text"))).first()[0] or 0, PASSAGES_TOGETHER)
    found = None
    for number in range(slices):
        own = items.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(slices)) == number)
        shared = spark.sparkContext.broadcast([tuple(row) for row in own.collect()])

        def search(batches: Iterator[pa.RecordBatch], shared=shared) -> Iterator[pa.RecordBatch]:
            passages = Benchmark(shared.value)
            for batch in batches:
                out, waiting, size = [], [], 0
                for doc_id, text in rows_of(batch, "doc_id", "text"):
                    words = plain(text)
                    waiting.append((doc_id, words))
                    size += len(words)
                    if size > TEXT_TOGETHER:
                        out += _look(passages, waiting)
                        waiting, size = [], 0
                out += _look(passages, waiting)
                columns = zip(*out, strict=True) if out else ((),) * 5
                names = ["doc_id", "item_id", "edits", "start", "stop"]
                yield pa.RecordBatch.from_arrays([pa.array(c, pa.int64()) for c in columns], names)

        part = source.mapInArrow(search, "doc_id long, item_id long, edits long, start long, stop long")
        found = part if found is None else found.union(part)
    return found


def _look(benchmark: Benchmark, texts: list[tuple[int, str]]) -> list[tuple]:
    """Rows of all texts. They are filtered together, a separator between them, and only those with a region looked at."""
    rows = []
    for passages in benchmark.indexes:
        starts, at = [], 0
        for _, words in texts:
            starts.append(at)
            at += len(words) + 1
        if at > 4 * TEXT_TOGETHER:
            likely = range(len(texts))
        else:
            regions = passages.regions(_codes("\0".join(words for _, words in texts)))
            middle = np.array([(low + high + len(passages.codes[item])) / 2 for item, low, high in regions])
            near = np.unique(np.searchsorted(starts, middle, side="right") - 1)
            likely = sorted({k + step for k in near.tolist() for step in (-1, 0, 1) if 0 <= k + step < len(texts)})
        rows += [(texts[k][0], passages.ids[item], *hit) for k in likely for item, hit in sorted(find(passages, texts[k][1]).items())]
    for doc_id, words in texts if benchmark.runs else ():
        rows += [(doc_id, item, *hit) for item, hit in find_words(benchmark, words).items()]
    return rows


def op5_decontaminate(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", doc_id="long", text="string")
    return contaminations(docs, read(spark, sf_dir, "benchmark", item_id="long", text="string"))
