"""Removal of word passages that an earlier document already has, by super-k-mers.

A window is ``window`` consecutive words of one document. Its minimiser is the smallest hash among the shorter runs of
``RUN`` words inside it; equal windows have equal minimisers. Neighbouring windows mostly share their minimiser, so they
travel as one packed string (a super-k-mer) to the minimiser's bucket. A bucket is sorted by minimiser and document, so
that the first document that shows a window is the smallest that has it, and the words themselves are compared.

A run of words that many documents have, such as a short line around which the texts differ, is the minimiser of countless
different windows. Windows are counted per minimiser first, and those of a minimiser that has more than ``CROWD`` travel one
by one, keyed and compared by a 128-bit digest of their words, so that they spread and only equal ones meet.
"""

from __future__ import annotations

from collections.abc import Iterator
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm.common import read, rows_of, stage
from fundlake.llm.hashing import PLACES, U64, mix, word_hashes

WINDOW = 50
#: Words in the runs that minimisers are taken from.
RUN = 8
#: Windows that travel in one string at most.
TOGETHER = 400
#: Windows of one minimiser that are held together at most, and rows of a batch that is sent.
CROWD, ROWS_SENT = 50_000, 50_000


def minimisers(hashes: np.ndarray, window: int, run: int) -> np.ndarray:
    """Smallest hash of ``run`` words in each window of ``window`` words."""
    count = len(hashes) - run + 1
    runs = np.zeros(count, U64)
    for k in range(run):
        runs += hashes[k : k + count] * PLACES[k]
    least, width, span = mix(runs), 1, window - run + 1
    while width < span:
        step = min(width, span - width)
        least = np.minimum(least[:-step], least[step:])
        width += step
    return least


def super_kmers(words: bytes, window: int = WINDOW, run: int = RUN) -> Iterator[tuple[int, int, int, bytes]]:
    """Minimiser, first window, number of windows and packed words of each run of windows with one minimiser."""
    first, end, hashes = word_hashes(words)
    if len(first) < window:
        return
    least = minimisers(hashes, window, run)
    cuts = np.concatenate([[0], np.flatnonzero(least[1:] != least[:-1]) + 1, [len(least)]])
    for a, b in zip(cuts[:-1].tolist(), cuts[1:].tolist(), strict=True):
        for at in range(a, b, TOGETHER):
            stop = min(b, at + TOGETHER)
            yield int(least[at].astype(np.int64)), at, stop - at, words[first[at] : end[stop + window - 2]]


def _ranges(flags: list[bool]) -> Iterator[tuple[int, int]]:
    start = None
    for k, flag in enumerate([*flags, False]):
        if flag and start is None:
            start = k
        elif not flag and start is not None:
            yield start, k
            start = None


def _windows(packed: bytes, count: int, window: int) -> list[bytes]:
    ends = [k for k, c in enumerate(packed) if c == 32] + [len(packed)]
    starts = [0, *(e + 1 for e in ends)]
    return [packed[starts[k] : ends[k + window - 1]] for k in range(count)]


def _unmarked(batch: pa.RecordBatch, window: int) -> Iterator[tuple[int, int, int, int, int, bytes, bool]]:
    """Minimiser, doc_id, key, first window, number, packed words of a batch's super-k-mers, and whether a smaller document
    of the batch has the same one."""
    first: dict[bytes, int] = {}
    for doc, key, text in sorted(rows_of(batch, "doc_id", "key", "text"), key=lambda row: row[:2]):
        for minimiser, at, count, packed in super_kmers(b" ".join(text.encode().split()), window):
            yield minimiser, doc, key, at, count, packed, first.setdefault(packed, doc) < doc


def crowded(source: DataFrame, window: int) -> list[int]:
    """Minimisers that more than ``CROWD`` windows to be sent have; at most one in ``CROWD`` windows' number."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: dict[int, int] = {}
            for minimiser, _, _, _, n, _, known in _unmarked(batch, window):
                if not known:
                    found[minimiser] = found.get(minimiser, 0) + n
            columns = [pa.array(found.keys(), pa.int64()), pa.array(found.values(), pa.int64())]
            yield pa.RecordBatch.from_arrays(columns, ["minimiser", "n"])

    counts = source.mapInArrow(count, "minimiser long, n long").groupBy("minimiser").agg(F.sum("n").alias("n"))
    return [row[0] for row in counts.where(F.col("n") > CROWD).select("minimiser").collect()]


def _marks(batches: Iterator[pa.RecordBatch], window: int) -> Iterator[tuple[int, int, int, int]]:
    """doc_id, text key, first word and end of the passages that a smaller document has.

    Rows come sorted by minimiser and document. The windows of one minimiser are held until the next one begins; rows
    whose minimiser no other row has are passed over.
    """
    current, seen, waiting = None, {}, None

    def judge(row: tuple) -> Iterator[tuple[int, int, int, int]]:
        doc, key, at, count, packed = row
        flags = [seen.setdefault(own, doc) < doc for own in ([packed] if count == 1 else _windows(packed, count, window))]
        for a, b in _ranges(flags):
            yield doc, key, at + a, at + b - 1 + window

    for batch in batches:
        minimiser = batch.column("minimiser").to_numpy()
        if not len(minimiser):
            continue
        same = np.concatenate([[minimiser[0] == current], minimiser[1:] == minimiser[:-1]])
        needed = same | np.append(same[1:], True)
        columns = [batch.column(name) for name in ("doc_id", "key", "at", "n", "packed")]
        for k in np.flatnonzero(needed).tolist():
            row = tuple(column[k].as_py() for column in columns)
            if not same[k]:
                seen, waiting = {}, row
                continue
            if waiting is not None:
                yield from judge(waiting)
                waiting = None
            yield from judge(row)
        current = minimiser[-1]


def sent_windows(source: DataFrame, window: int) -> DataFrame:
    """Super-k-mers of ``source`` (doc_id, key and text, none null) with the key of their bucket; ``packed`` is null where a
    smaller document is already known to have the windows."""
    shared = source.sparkSession.sparkContext.broadcast(frozenset(crowded(source, window)))

    def send(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def table(rows: list[tuple]) -> pa.RecordBatch:
            kinds = (pa.int64(), pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.binary())
            columns = zip(*rows, strict=True) if rows else ((),) * 6
            return pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], ["minimiser", "doc_id", "key", "at", "n", "packed"]
            )

        crowd = shared.value
        for batch in batches:
            found, first = [], {}
            for minimiser, doc, key, at, count, packed, known in _unmarked(batch, window):
                if known or minimiser not in crowd:
                    found.append((minimiser, doc, key, at, count, None if known else packed))
                    continue
                digests = [blake2b(own, digest_size=16).digest() for own in _windows(packed, count, window)]
                flags = [first.setdefault(digest, doc) < doc for digest in digests]
                found += [(minimiser, doc, key, at + a, b - a, None) for a, b in _ranges(flags)]
                # No window begins with a space, so a digest never equals words.
                found += [
                    (int.from_bytes(digest[:8], "little", signed=True), doc, key, at + k, 1, b" " + digest)
                    for k, (digest, flag) in enumerate(zip(digests, flags, strict=True)) if not flag
                ]
                if len(found) >= ROWS_SENT:
                    yield table(found)
                    found = []
            yield table(found)

    return source.mapInArrow(send, "minimiser long, doc_id long, key long, at int, n int, packed binary")


def repeated_passages(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """doc_id, key and ``passages`` (array of first word and end) for documents with words to remove.

    ``docs`` has doc_id, key and text; rows without an id or a text take no part. Within a batch a string that a smaller
    document has is marked at once and not sent, so of a text with countless copies each reading task sends few.
    """

    def compare(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        local: list[tuple[int, int, int, int]] = []

        def unsent(source: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            for batch in source:
                sent = batch.column("packed").is_valid()
                if sent.false_count:
                    for doc, key, at, n, _ in rows_of(batch.filter(pa.compute.invert(sent)), "doc_id", "key", "at", "n", "packed"):
                        local.append((doc, key, at, at + n - 1 + window))
                    batch = batch.filter(sent)
                yield batch

        def table(rows: list[tuple]) -> pa.RecordBatch:
            columns = zip(*rows, strict=True) if rows else ((),) * 4
            kinds = (pa.int64(), pa.int64(), pa.int32(), pa.int32())
            return pa.RecordBatch.from_arrays(
                [pa.array(c, kind) for c, kind in zip(columns, kinds, strict=True)], ["doc_id", "key", "start", "stop"]
            )

        rows: list[tuple] = []
        for row in _marks(unsent(batches), window):
            rows.append(row)
            if len(rows) + len(local) >= 100_000:
                yield table(rows + local)
                rows, local[:] = [], []
        yield table(rows + local)

    source = docs.where("doc_id is not null and text is not null").select("doc_id", "key", "text")
    sent = sent_windows(source, window)
    # What is already decided goes anywhere, not to the bucket that many copies share.
    spread = F.when(F.col("packed").isNull(), F.xxhash64("doc_id", "at")).otherwise(F.col("minimiser"))
    bucketed = sent.withColumn("minimiser", spread).repartition("minimiser").sortWithinPartitions("minimiser", "doc_id")
    marks = bucketed.mapInArrow(compare, "doc_id long, key long, start int, stop int")
    return marks.groupBy("doc_id", "key").agg(F.collect_set(F.struct("start", "stop")).alias("passages"))


def remove_repeated(docs: DataFrame, window: int = WINDOW) -> DataFrame:
    """``docs`` (doc_id, text, ...) with n_words, n_removed and kept_text.

    A word goes if a window that covers it also starts in a document with a smaller doc_id, as the documents were given.
    ``kept_text`` has the kept words joined by one space; it is empty for a null text. A null doc_id is neither smaller
    nor larger than another: its row keeps all words. Rows that repeat an id are not earlier than each other. Other columns
    are passed on, but for those that have the name of a result, which the result replaces.
    """
    docs = docs.drop("n_words", "n_removed", "kept_text")
    own = docs.select("doc_id", F.xxhash64("text").alias("key"), "text")
    passages = stage(repeated_passages(own, window), "passages")
    passages = passages.select(F.col("doc_id").alias("_own_id"), F.col("key").alias("_own_key"), F.col("passages").alias("_passages"))
    same = (F.col("doc_id") == F.col("_own_id")) & (F.xxhash64("text") == F.col("_own_key"))
    joined = docs.join(passages.hint("shuffle_hash"), same, "left")

    def keep(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            totals, removed, kept = [], [], []
            for text, passages in rows_of(batch, "text", "_passages"):
                words = (text or "").encode().split()
                totals.append(len(words))
                if passages:
                    left, at = [], 0
                    for passage in sorted(passages, key=lambda p: p["start"]):
                        left += words[at : max(at, passage["start"])]
                        at = max(at, passage["stop"])
                    words = left + words[at:]
                removed.append(totals[-1] - len(words))
                kept.append(b" ".join(words).decode())
            names = [name for name in batch.schema.names if name != "_passages"]
            new = [pa.array(totals, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())]
            yield pa.RecordBatch.from_arrays([*(batch.column(n) for n in names), *new], [*names, "n_words", "n_removed", "kept_text"])

    schema = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in docs.schema)
    return joined.select(*docs.columns, "_passages").mapInArrow(keep, f"{schema}, n_words long, n_removed long, kept_text string")


def op3_substrings(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read(spark, sf_dir, "documents", doc_id="long", text="string")
    return remove_repeated(docs).select("doc_id", "n_words", "n_removed", F.sha2("kept_text", 256).alias("kept_sha256"))


SQL = rf"""with t as (
  select doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') as words from documents),
w as (select doc_id, unnest(words) as word, generate_subscripts(words, 1) as i, words, len(words) as n from t),
s as (select doc_id, i, word, case when i + {WINDOW - 1} <= n then sha256(array_to_string(words[i : i + {WINDOW - 1}], ' ')) end as passage from w),
f as (select *, passage is not null and min(doc_id) over (partition by passage) < doc_id as seen from s),
c as (
  select doc_id, i, word,
    max(seen::int) over (partition by doc_id order by i rows between {WINDOW - 1} preceding and current row) = 1 as gone from f),
k as (
  select doc_id, count(*) filter (gone) as n_removed, string_agg(word, ' ' order by i) filter (not gone) as kept from c group by doc_id)
select t.doc_id, len(words)::bigint as n_words, coalesce(n_removed, 0)::bigint as n_removed, sha256(coalesce(kept, '')) as kept_sha256
from t left join k using (doc_id)"""
