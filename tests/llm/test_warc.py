"""Archives: exact round trip, frames, revisits and odd rows."""

import base64
import hashlib
import struct
from uuid import uuid4

import pytest
import zstandard

from fundlake.llm import warc
from fundlake.llm.warc import DICTIONARY_FRAME, read_archives, records_of, write_archives

PAGES = [
    (1, "http://a.example/x y\r\nX: 1", "<p>één\r\n\r\nWARC/1.1\r\n</p>"), (2, "http://a.example/", "same"), (3, None, "same"),
    (9, "http://b.example/", "same"), (4, "u", None), (5, "u", ""), (6, "u", "x" * 3_000_000), (None, "u", "same"), (None, "v", "lone"),
    (7, "u", "twice"), (7, "u", "twice"), (8, "w", "\x00\x7f\n\n\U0001f600"),
]


def sha(text):
    return base64.b32encode(hashlib.sha1((text or "").encode()).digest()).decode()


@pytest.fixture(scope="module")
def folder(spark, tmp_path_factory):
    pages = spark.createDataFrame([(*p, "x") for p in PAGES + [(100 + n, "u", f"<html><p>page {n} of many</p></html>") for n in range(300)]], "page_id long, url string, html string, digest string")
    return write_archives(pages, f"{tmp_path_factory.mktemp('warc')}/out")


def test_round_trip(spark, folder):
    rows = [r for r in read_archives(spark, folder).collect() if r.page_id is None or r.page_id < 100]
    want = {"same": 9, "": 5}
    got = sorted(((r.page_id, r.payload_bytes, r.payload_digest, r.record_type, r.refers_to) for r in rows), key=str)
    expected = []
    for page, _, html in PAGES:
        last = want.get(html or "")
        revisit = last is not None and last != page
        expected.append((page, len((html or "").encode()), sha(html), "revisit" if revisit else "response", last if revisit else None))
    assert got == sorted(expected, key=str)
    assert {r.payload.decode() for r in rows if r.record_type == "response"} == {h or "" for _, _, h in PAGES}
    assert {r.url for r in rows if r.page_id == 1} == {"http://a.example/x%20y%0D%0AX:%201"}
    assert {r.url for r in rows if r.page_id == 3} == {None}


def test_archives_open_with_the_dictionary_and_frames_stand_alone(folder, tmp_path):
    import glob

    for path in glob.glob(f"{folder}/*.warc.zst"):
        data = open(path, "rb").read()
        magic, size = struct.unpack_from("<II", data)
        assert magic == DICTIONARY_FRAME and 0 < size < len(data)
        press = zstandard.ZstdDecompressor(dict_data=zstandard.ZstdCompressionDict(data[8 : 8 + size]))
        at, frames = 8 + size, 0
        while at < len(data):
            magic, length = struct.unpack_from("<II", data, at)
            if magic & 0xFFFFFFF0 == 0x184D2A50:
                at += 8 + length
                continue
            one = press.decompressobj()
            assert one.decompress(data[at:]).startswith(b"WARC/1.1\r\n")
            at, frames = len(data) - len(one.unused_data), frames + 1
        assert frames == sum(1 for _ in records_of(data))
    assert glob.glob(f"{folder}/*.warc.zst")


def test_small_payloads_can_stay_responses(spark, tmp_path):
    pages = spark.createDataFrame(PAGES, "page_id long, url string, html string")
    rows = read_archives(spark, write_archives(pages, f"{tmp_path}/{uuid4().hex}", least=5)).collect()
    assert {r.page_id for r in rows if r.record_type == "revisit"} == set()


def test_no_pages_and_damage(spark, tmp_path):
    empty = spark.createDataFrame([], "page_id long, url string, html string")
    assert read_archives(spark, write_archives(empty, f"{tmp_path}/none")).collect() == []
    with pytest.raises(ValueError):
        list(records_of(zstandard.compress(b"WARC/1.1\r\nContent-Length: 50\r\n\r\nshort")))


def test_long_pages_make_a_dictionary_too(spark, tmp_path):
    pages = [(k, "u", "".join(f"<div class='item{k}'>entry {k * j} of the catalogue</div>" for j in range(400))) for k in range(40)]
    folder = write_archives(spark.createDataFrame(pages, "page_id long, url string, html string"), f"{tmp_path}/long")
    rows = read_archives(spark, folder).collect()
    assert sorted((r.page_id, r.payload.decode()) for r in rows) == [(k, html) for k, _, html in pages]
    for path in tmp_path.glob("long/*.warc.zst"):
        assert struct.unpack_from("<I", path.read_bytes()) == (DICTIONARY_FRAME,)


def test_rows_without_an_id_are_dealt_to_many_archives(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(warc, "SAME_ROWS", 50)
    pages = [(None, f"u{k}", "equal") for k in range(900)] + [(7, "v", "twice")] * 300 + [(k, "w", "equal") for k in range(1000, 1100)]
    df = spark.createDataFrame(pages, "page_id long, url string, html string").repartition(6)
    dealt = warc.with_revisits(df).selectExpr("*", "spark_partition_id() part")
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    try:
        parts = [r.n for r in dealt.where("page_id is null").groupBy("part").agg({"*": "count"}).withColumnRenamed("count(1)", "n").collect()]
    finally:
        spark.conf.set("spark.sql.adaptive.enabled", "true")
    assert sum(parts) == 900 and max(parts) < 600
    rows = read_archives(spark, write_archives(df, f"{tmp_path}/many")).collect()
    assert len(rows) == len(pages)
    assert all((r.record_type, r.refers_to) == ("revisit", 1099) for r in rows if r.page_id is None)
    assert sum(r.page_id == 7 and r.record_type == "response" for r in rows) == 300
    assert [r.page_id for r in rows if r.record_type == "response" and r.page_id != 7] == [1099]
