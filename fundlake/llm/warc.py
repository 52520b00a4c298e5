"""WARC archives compressed with a shared dictionary.

Every archive begins with a skippable frame that holds a Zstandard dictionary, trained on a bounded number of the records
to be written; then every record is a frame of its own, compressed with that dictionary, so a reader may start at any.

Files are written by Spark's text sink and read by its binary-file source, so they work on any file system Spark knows
and a repeated task leaves no half-written archive. The sink ends each row with a line feed; here that byte is the content
of a one-byte skippable frame, which every reader passes over.
"""

from __future__ import annotations

import base64
import hashlib
import re
import struct
from collections.abc import Iterable, Iterator
from uuid import uuid4

import pyarrow as pa
import zstandard
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from fundlake.llm.common import buckets_for, first_by_hash, read, rows_of
from fundlake.session import work_dir

# Fixed values of the formats.
DICTIONARY_FRAME, SKIPPED_FRAME = 0x184D2A5D, 0x184D2A50
LINE_END_FRAME = struct.pack("<II", SKIPPED_FRAME, 1)
REVISIT_PROFILE = "http://netpreserve.org/warc/1.1/revisit/identical-payload-digest"

#: The dictionary is trained on at most so many records; of a payload longer than so many characters a piece is taken.
SAMPLE_RECORDS, SAMPLE_CHARS, DICTIONARY_BYTES = 800, 12_000, 112 * 1024
#: Rows of one id and payload that one archive takes; a table of n rows has at most n / SAME_ROWS such keys above it.
SAME_ROWS = 20_000
#: Bytes of payload that one archive holds on average.
ARCHIVE_BYTES = 64 << 20
LEVEL = 6
WHEN = "1970-01-01T00:00:00Z"

_UNSAFE = re.compile(r"[\x00-\x20\x7f]")


def base32_sha1(text: str) -> Column:
    """Upper-case base32 SHA-1 of a UTF-8 text: twenty bits, five hexadecimal digits, become four letters at a time."""
    digest = F.sha1(text)
    groups = [F.lpad(F.conv(F.substring(digest, 1 + 5 * k, 5), 16, 32), 4, "0") for k in range(8)]
    return F.translate(F.concat(*groups), "0123456789ABCDEFGHIJKLMNOPQRSTUV", "ABCDEFGHIJKLMNOPQRSTUVWXYZ234567")


def with_revisits(pages: DataFrame, least: int = 0) -> DataFrame:
    """``pages`` (page_id, url, html) with payload digest and size, and ``refers_to`` where the record is a revisit.

    Of the records with equal payloads of at least ``least`` bytes the one with the largest page_id is the response (all
    of them, if rows of that id repeat); the others refer to it. A null page_id is smaller than any other. The groups are
    counted before rows meet, so a payload that a third of all pages share is one row per task.
    """
    digested = pages.select(
        "page_id", "url", F.coalesce("html", F.lit("")).alias("html"),
    ).select("*", base32_sha1("html").alias("digest"), F.octet_length("html").cast("long").alias("size"))
    total = digested.agg(F.sum("size")).first()[0] or 0
    keys = digested.select("page_id", "digest", "size").where(F.col("size") >= least)
    groups = keys.groupBy("digest", "size").agg(F.max("page_id").alias("refers_to"), F.count("*").alias("n")).where("n > 1")
    # A key without nulls, so that the join alone moves the pages. It deals them to as many archives as the session shuffles
    # to, or more if that would make them too large; fewer are put together by size while it runs.
    key, archives = F.concat_ws(" ", "page_id", "digest"), buckets_for(total, ARCHIVE_BYTES)
    revisits = keys.join(groups, ["digest", "size"]).where("not page_id <=> refers_to").select(key.alias("key"), "refers_to").distinct()
    # Rows that repeat, or that have no id, share a key: those keys are dealt in slices.
    same = digested.groupBy(key.alias("key")).agg(F.count(F.lit(1)).alias("rows")).where(F.col("rows") > SAME_ROWS)
    same = same.select("key", F.ceil(F.col("rows") / SAME_ROWS).cast("int").alias("slices"))
    slices = F.coalesce("slices", F.lit(1))
    revisits = revisits.join(F.broadcast(same), "key", "left").select("key", "refers_to", F.explode(F.sequence(F.lit(0), slices - 1)).alias("slice"))
    dealt = digested.withColumn("key", key).withColumn("at", F.monotonically_increasing_id()).join(F.broadcast(same), "key", "left")
    dealt = dealt.withColumn("slice", F.pmod("at", slices).cast("int")).drop("at", "slices")
    if archives > int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions")):
        dealt, revisits = dealt.repartition(archives, "key", "slice"), revisits.repartition(archives, "key", "slice")
    return dealt.join(revisits.hint("shuffle_hash"), ["key", "slice"], "left").drop("key", "slice")


def _record(page_id: int | None, url: str | None, html: str, digest: str, refers_to: int | None) -> bytes:
    """One WARC record: a response with its payload, or a revisit with the HTTP header alone."""
    payload = html.encode()
    block = f"HTTP/1.1 200 OK\r\nContent-Type: text/html; charset=utf-8\r\nContent-Length: {len(payload)}\r\n\r\n".encode()
    named = {
        "WARC-Type": "response" if refers_to is None else "revisit",
        "WARC-Record-ID": f"<urn:page:{page_id}>",
        "WARC-Date": WHEN,
        "WARC-Target-URI": None if url is None else _UNSAFE.sub(lambda c: f"%{ord(c[0]):02X}", url),
        "WARC-Payload-Digest": f"sha1:{digest}",
        "WARC-Profile": None if refers_to is None else REVISIT_PROFILE,
        "WARC-Refers-To": None if refers_to is None else f"<urn:page:{refers_to}>",
        "Content-Type": "application/http;msgtype=response",
    }
    if refers_to is None:
        block += payload
    head = "".join(f"{name}: {value}\r\n" for name, value in named.items() if value is not None)
    return f"WARC/1.1\r\n{head}Content-Length: {len(block)}\r\n\r\n".encode() + block + b"\r\n\r\n"


def train_dictionary(samples: list[bytes]) -> bytes:
    """A trained dictionary; the samples themselves where they are too few or too small to train on; empty for none."""
    try:
        return zstandard.train_dictionary(DICTIONARY_BYTES, samples).as_bytes()
    except zstandard.ZstdError:
        return b"".join(samples)[:DICTIONARY_BYTES]


def write_archives(pages: DataFrame, folder: str, least: int = 0) -> str:
    """Write a record per row of ``pages`` (page_id, url, html) into ``*.warc.zst`` files of a new ``folder``.

    A null html is an empty payload; a null url leaves the header out. An empty table leaves a folder without records.
    """
    spark = pages.sparkSession
    # Where in a long payload the piece begins is up to a hash, so the dictionary knows more than heads of pages.
    start = F.pmod(F.xxhash64("html", F.lit(1)), F.greatest(F.lit(1), F.length("html") - SAMPLE_CHARS + 1)).cast("int") + 1
    piece = F.when(F.length("html") <= SAMPLE_CHARS, F.col("html")).otherwise(F.substring("html", start, F.lit(SAMPLE_CHARS)))
    filled = pages.where("html is not null")
    drawn = first_by_hash(filled, SAMPLE_RECORDS, filled.count(), "page_id", "url", "html")
    sample = drawn.select("page_id", "url", piece.alias("html")).select("page_id", "url", "html", base32_sha1("html").alias("digest"))
    shared = spark.sparkContext.broadcast(
        train_dictionary([_record(r["page_id"], r["url"], r["html"], r["digest"], None) for r in sample.collect()])
    )

    def compress(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        dictionary = shared.value
        press = zstandard.ZstdCompressor(level=LEVEL, dict_data=zstandard.ZstdCompressionDict(dictionary) if dictionary else None)
        frames = [struct.pack("<II", DICTIONARY_FRAME, len(dictionary)) + dictionary + LINE_END_FRAME] if dictionary else []
        for batch in batches:
            for row in rows_of(batch, "page_id", "url", "html", "digest", "refers_to"):
                frames.append(press.compress(_record(*row)) + LINE_END_FRAME)
            yield pa.RecordBatch.from_arrays([pa.array(frames, pa.binary())], ["frame"])
            frames = []

    records = with_revisits(pages, least).select("page_id", "url", "html", "digest", "refers_to")
    records.mapInArrow(compress, "frame binary").select(F.col("frame").cast("string")).write.option("lineSep", "\n").text(folder)
    path = spark._jvm.org.apache.hadoop.fs.Path(folder)
    files = path.getFileSystem(spark._jsc.hadoopConfiguration())
    for status in files.listStatus(path):
        if (name := status.getPath().getName()).startswith("part-"):
            files.rename(status.getPath(), spark._jvm.org.apache.hadoop.fs.Path(path, f"{name.removesuffix('.txt')}.warc.zst"))
    return folder


def _headers(lines: bytes) -> dict[str, str]:
    return dict(line.split(": ", 1) for line in lines.decode().split("\r\n")[1:] if ": " in line)


def records_of(archive: bytes) -> Iterator[tuple[dict[str, str], bytes]]:
    """Headers and block of each record of an archive, in order; decompressed as they are read."""
    if not archive:
        return
    magic, size = struct.unpack_from("<II", archive)
    data = zstandard.ZstdCompressionDict(archive[8 : 8 + size]) if magic == DICTIONARY_FRAME else None
    reader = zstandard.ZstdDecompressor(dict_data=data).stream_reader(archive, read_across_frames=True)
    held = b""
    while True:
        while (end := held.find(b"\r\n\r\n")) < 0:
            if not (more := reader.read(1 << 20)):
                if held:
                    raise ValueError("archive ends inside a record")
                return
            held += more
        headers = _headers(held[:end])
        whole = end + 4 + int(headers["Content-Length"]) + 4
        parts, size = [held], len(held)
        while size < whole:
            if not (more := reader.read(max(1 << 20, whole - size))):
                raise ValueError("archive ends inside a record")
            parts.append(more)
            size += len(more)
        held = b"".join(parts) if len(parts) > 1 else held
        yield headers, held[end + 4 : whole - 4]
        held = held[whole:]


def _number(urn: str | None) -> int | None:
    found = re.fullmatch(r"<urn:page:(-?\d+)>", urn or "")
    return int(found[1]) if found else None


def _read_rows(contents: Iterable[bytes]) -> Iterator[tuple]:
    for content in contents:
        for headers, block in records_of(content):
            head, payload = block.split(b"\r\n\r\n", 1)
            kind, digest = headers["WARC-Type"], headers["WARC-Payload-Digest"].removeprefix("sha1:")
            if kind == "response" and base64.b32encode(hashlib.sha1(payload).digest()).decode() != digest:
                raise ValueError(f"payload of {headers['WARC-Record-ID']} does not match its digest")
            yield (
                _number(headers["WARC-Record-ID"]), headers.get("WARC-Target-URI"), int(_headers(head)["Content-Length"]), digest,
                kind, _number(headers.get("WARC-Refers-To")), payload if kind == "response" else None,
            )


READ_SCHEMA = (
    "page_id long, url string, payload_bytes long, payload_digest string, record_type string, refers_to long, payload binary"
)


def read_archives(spark: SparkSession, folder: str, payloads: bool = True) -> DataFrame:
    """A row per record of all archives in ``folder``; every response is checked against its digest. A revisit has no
    payload of its own; size and digest are those of the payload it refers to."""
    fields = [part.split() for part in READ_SCHEMA.split(", ")][: 7 if payloads else 6]
    kinds = {"long": pa.int64(), "string": pa.string(), "binary": pa.binary()}

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, size = [], 0
            for row in _read_rows(x.as_py() for x in batch.column("content")):
                rows.append(row)
                size += len(row[6] or b"") if payloads else 64
                if size > 8 << 20:
                    yield table(rows)
                    rows, size = [], 0
            yield table(rows)

    def table(rows: list[tuple]) -> pa.RecordBatch:
        columns = [pa.array([row[k] for row in rows], kinds[kind]) for k, (_, kind) in enumerate(fields)]
        return pa.RecordBatch.from_arrays(columns, [name for name, _ in fields])

    files = spark.read.format("binaryFile").option("pathGlobFilter", "*.warc.zst").load(folder).select("content")
    return files.mapInArrow(parse, ", ".join(map(" ".join, fields)))


def op2_warc(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = read(spark, sf_dir, "pages", page_id="long", url="string", html="string")
    folder = write_archives(pages, f"{work_dir(spark)}/fundlake/archives-{uuid4().hex}")
    return read_archives(spark, folder, payloads=False).drop("url")


SQL = """
WITH p AS (
    SELECT page_id, sha1(coalesce(html, '')) AS h, strlen(coalesce(html, '')) AS payload_bytes FROM pages
), d AS (
    SELECT page_id, payload_bytes,
           translate(array_to_string([to_base(('0x' || h[1 + 5 * k : 5 + 5 * k])::BIGINT, 32, 4) FOR k IN range(0, 8)], ''), '0123456789ABCDEFGHIJKLMNOPQRSTUV', 'ABCDEFGHIJKLMNOPQRSTUVWXYZ234567') AS payload_digest
    FROM p
), g AS (SELECT *, max(page_id) OVER (PARTITION BY payload_digest, payload_bytes) AS last FROM d)
SELECT page_id, payload_bytes::BIGINT AS payload_bytes, payload_digest,
       CASE WHEN page_id IS NOT DISTINCT FROM last THEN 'response' ELSE 'revisit' END AS record_type,
       CASE WHEN page_id IS NOT DISTINCT FROM last THEN NULL ELSE last END AS refers_to
FROM g
"""
