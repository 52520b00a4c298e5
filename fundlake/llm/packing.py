"""Sequence packing: shortest pack first over the length histogram.

Documents are tokenised where they are read and cut into pieces of at most the sequence length; only numbers leave the
reading tasks. The histogram of piece lengths (one row per length, so at most ``size`` rows) is packed on the driver,
longest lengths first, each into the shortest pack that is open. The driver holds packing patterns with counts, never
pieces: pieces find their place by their rank among the pieces of the same length.
"""

from __future__ import annotations

import zlib
from array import array
from collections import defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import Window as W
from pyspark.sql import functions as F

from fundlake.llm.common import buckets_for, read, rows_of, stage
from fundlake.llm.tokens import tokenizer

#: Pieces of one length are ranked in buckets of about this many.
RANKED_TOGETHER = 200_000


def shortest_pack_first(histogram: dict[int, int], size: int) -> list[tuple[tuple[int, ...], int]]:
    """Packing patterns (lengths in order) with the number of sequences that follow each.

    Lengths are placed from the longest to the shortest. A piece goes to the open pack with the most room. New packs are
    opened only where no pack has room for the length, and then only as many as the tokens that are still to be placed
    need beyond the room left, so that pieces of one length can share a pack.
    """
    open_packs: dict[int, list[list]] = defaultdict(list)  # room -> [pattern, count]
    done: list[tuple[tuple[int, ...], int]] = []
    room, left = 0, sum(length * count for length, count in histogram.items())

    def put(pattern: tuple[int, ...], count: int, space: int) -> None:
        if space:
            open_packs[space].append([pattern, count])
        else:
            done.append((pattern, count))

    for length in sorted(histogram, reverse=True):
        count = histogram[length]
        while count:
            space = max(open_packs, default=0)
            if space >= length:
                pattern, packs = open_packs[space].pop()
                if not open_packs[space]:
                    del open_packs[space]
                used = min(packs, count)
                if packs > used:
                    open_packs[space].append([pattern, packs - used])
                put((*pattern, length), used, space - length)
                room -= used * length
            else:
                used = min(count, max(1, -(-(left - room) // size)))
                put((length,), used, size - length)
                room += used * (size - length)
            count -= used
            left -= used * length
    return done + [(pattern, count) for packs in open_packs.values() for pattern, count in packs]


def slots(patterns: list[tuple[tuple[int, ...], int]]) -> np.ndarray:
    """Per pattern and place in it: length, first rank, first sequence, offset; sorted by length and rank."""
    rank, first, found = defaultdict(int), 0, []
    for pattern, count in patterns:
        offset = 0
        for length in pattern:
            found.append((length, rank[length], first, offset))
            rank[length] += count
            offset += length
        first += count
    return np.array(sorted(found), dtype=np.int64).reshape(-1, 4)


def token_pieces(docs: DataFrame, tokenizer_path: str, size: int, end_id: int) -> DataFrame:
    """Pieces of at most ``size`` ids of every whole text with ``end_id`` behind it: full ones, then the remainder."""

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        words, end = tokenizer(tokenizer_path), array("I", [end_id]).tobytes()
        for batch in batches:
            source, starts, lengths, crcs, totals = [], [], [], [], []
            for row, (text,) in enumerate(rows_of(batch, "text")):
                ids = memoryview(words.encode(text or "") + end)
                total = len(ids) // 4
                for start in range(0, total, size):
                    piece = ids[start * 4 : (start + size) * 4]
                    source.append(row)
                    starts.append(start)
                    lengths.append(len(piece) // 4)
                    crcs.append(zlib.crc32(piece))
                    totals.append(total)
            numbers = [pa.array(x, pa.int64()) for x in (starts, lengths, crcs, totals)]
            names = ["doc_id", "start", "length", "ids_crc32", "doc_tokens"]
            yield pa.RecordBatch.from_arrays([batch.column("doc_id").take(pa.array(source, pa.int64())), *numbers], names)

    return docs.mapInArrow(cut, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long")


def ranked(pieces: DataFrame) -> DataFrame:
    """``pieces`` with their rank from 0 among those of the same length.

    Ranks are counted in buckets and shifted by the number of pieces in earlier buckets, so a length that holds a third
    of all pieces is spread over as many tasks as there are buckets.
    """
    buckets = buckets_for(pieces.count(), RANKED_TOGETHER)
    pieces = pieces.withColumn("bucket", F.pmod(F.xxhash64("doc_id", "start", "ids_crc32"), F.lit(buckets)))
    counts = pieces.groupBy("length", "bucket").agg(F.count("*").alias("n"))
    earlier = W.partitionBy("length").orderBy("bucket").rowsBetween(W.unboundedPreceding, -1)
    shifts = counts.select("length", "bucket", F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("shift"))
    within = W.partitionBy("length", "bucket").orderBy("doc_id", "start", "ids_crc32", "doc_tokens")
    numbered = pieces.withColumn("rank", F.row_number().over(within) - 1)
    return numbered.join(shifts, ["length", "bucket"]).withColumn("rank", F.col("rank") + F.col("shift")).drop("bucket", "shift")


def pack(pieces: DataFrame, size: int = 2048) -> DataFrame:
    """``pieces`` (doc_id, start, length, ...) with sequence_id and offset; every piece is placed once, none is dropped.

    An empty table gives no rows; equal pieces and null ids are placed like any other.
    """
    pieces = stage(pieces, "pieces")
    histogram = {row["length"]: row["n"] for row in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    table = pieces.sparkSession.sparkContext.broadcast(slots(shortest_pack_first(histogram, size)))

    def place(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lengths, ranks, firsts, offsets = table.value.T
        keys = lengths * (1 << 48) + ranks
        for batch in batches:
            rank = batch.column("rank").to_numpy()
            at = np.searchsorted(keys, batch.column("length").to_numpy() * (1 << 48) + rank, side="right") - 1
            places = [firsts[at] + rank - ranks[at], offsets[at]]
            kept = [name for name in batch.schema.names if name != "rank"]
            yield pa.RecordBatch.from_arrays(
                [*(batch.column(name) for name in kept), *map(pa.array, places)], [*kept, "sequence_id", "offset"]
            )

    placed = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in pieces.schema)
    return ranked(pieces).select(*pieces.columns, F.col("rank").cast("long")).mapInArrow(
        place, f"{placed}, sequence_id long, offset long"
    )


def pack_documents(docs: DataFrame, tokenizer_path: str, size: int = 2048, end_id: int = 1) -> DataFrame:
    """Tokenise ``docs`` (doc_id, text; null text is empty, so the end id alone) and pack the pieces."""
    source = docs.select(F.col("doc_id").cast("long"), F.col("text").cast("string"))
    return pack(token_pieces(source, tokenizer_path, size, end_id), size)


def op6_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    import public_tokenizers

    docs = read(spark, sf_dir, "documents", doc_id="long", text="string")
    return pack_documents(docs, public_tokenizers.path("byte_bpe_50k.json"))
