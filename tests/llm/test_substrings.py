"""Removal of repeated passages against a brute-force version."""

import random

import numpy as np
import pytest

from fundlake.llm import substrings
from fundlake.llm.hashing import word_hashes
from fundlake.llm.substrings import minimisers, remove_repeated, super_kmers


def brute_force(docs, window):
    first, out = {}, []
    rows = [(doc, (text or "").encode().split()) for doc, text in docs]
    windows = [[tuple(w[k : k + window]) for k in range(len(w) - window + 1)] for _, w in rows]
    for (doc, _), own in zip(rows, windows, strict=True):
        for x in own:
            if doc is not None:
                first[x] = min(first.get(x, doc), doc)
    for (doc, words), own in zip(rows, windows, strict=True):
        gone = {k + j for k, x in enumerate(own) if doc is not None and first[x] < doc for j in range(window)}
        out.append((doc, len(words), len(gone), b" ".join(w for k, w in enumerate(words) if k not in gone).decode()))
    return sorted(out, key=str)


def compare(spark, docs, window=50):
    df = spark.createDataFrame([(d, t, "x") for d, t in docs], "doc_id long, text string, minimiser string")
    got = remove_repeated(df, window).select("doc_id", "n_words", "n_removed", "kept_text").collect()
    assert sorted(map(tuple, got), key=str) == brute_force(docs, window)


def prose(pick, n, vocabulary=500):
    return " ".join(f"w{pick.randrange(vocabulary)}" for _ in range(n))


def test_random_documents_with_shared_passages(spark):
    pick = random.Random(3)
    passages = [prose(pick, n) for n in (50, 51, 60, 49, 200)]
    docs = []
    for doc in range(120):
        parts = [prose(pick, pick.randrange(80)) for _ in range(3)]
        docs.append((doc * 7 % 120, f"{parts[0]} {pick.choice(passages)}\n{parts[1]}\t{pick.choice(passages)}  {parts[2]}"))
    docs += [(500 + n, docs[0][1]) for n in range(40)] + [(300, docs[5][1]), (300, docs[6][1]), (300, docs[6][1])]
    compare(spark, docs)


def test_odd_rows(spark):
    pick = random.Random(4)
    long = prose(pick, 9000)
    docs = [
        (1, None), (2, ""), (3, " \n"), (4, "one two"), (5, "the " * 300), (6, "the " * 60), (7, "a b " * 200), (8, "b a " * 40),
        (None, "the " * 60), (None, "the " * 60), (9, "the " * 49), (10, "the " * 50), (11, long), (12, long[200:]), (13, "x " + long + " y"),
        (-1, "a b " * 30), (14, " ".join(["é"] * 120)), (15, "é  " * 120), (16, "é \x0b" * 130),
    ]
    compare(spark, docs)
    assert remove_repeated(spark.createDataFrame([], "doc_id long, text string")).collect() == []


@pytest.mark.parametrize("window", [8, 9, 13])
def test_few_words_and_other_windows(spark, window):
    pick = random.Random(window)
    compare(spark, [(n, prose(pick, pick.randrange(60), 2)) for n in range(150)], window)


def test_sorted_buckets_over_many_batches(spark):
    pick = random.Random(8)
    docs = [(n, prose(pick, 70, 3)) for n in range(400)]
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "7")
    try:
        compare(spark, docs, 12)
    finally:
        spark.conf.unset("spark.sql.execution.arrow.maxRecordsPerBatch")


def test_windows_around_a_common_line_spread(spark, monkeypatch):
    pick = random.Random(9)
    line = prose(pick, 30)
    docs = [(n, f"{prose(pick, 60)} {line} {prose(pick, 60)}") for n in range(60)]
    docs += [(100 + n, docs[n][1] if n % 2 else "x " + docs[n][1]) for n in range(40)] + [(101, docs[0][1]), (None, line * 3)]
    monkeypatch.setattr(substrings, "CROWD", 100)
    compare(spark, docs)
    source = spark.createDataFrame(docs[:60], "doc_id long, text string").selectExpr("doc_id", "0L key", "text")
    groups = substrings.sent_windows(source, 50).where("packed is not null").groupBy("minimiser").agg({"n": "sum"}).collect()
    assert sum(n for _, n in groups) == 60 * 101 and max(n for _, n in groups) <= 100
    monkeypatch.setattr(substrings, "CROWD", 10**9)
    assert max(n for _, n in substrings.sent_windows(source, 50).groupBy("minimiser").agg({"n": "sum"}).collect()) > 1000


def test_minimisers_and_packed_strings(monkeypatch):
    pick = random.Random(5)
    words = prose(pick, 500).encode()
    first, end, hashes = word_hashes(words)
    assert [words[a:b] for a, b in zip(first, end, strict=True)] == words.split(b" ")
    assert len({int(h) for h in hashes}) == len(set(words.split()))
    runs = minimisers(hashes, 8, 8)
    assert (minimisers(hashes, 50, 8) == np.array([runs[k : k + 43].min() for k in range(451)])).all()
    monkeypatch.setattr(substrings, "TOGETHER", 5)
    at = 0
    for minimiser, start, count, packed in super_kmers(words):
        assert start == at and 0 < count <= 5 and packed.split() == words.split()[start : start + count + 49]
        at += count
    assert at == 451


def test_columns_with_the_names_of_results_and_helpers(spark):
    pick = random.Random(9)
    passage = prose(pick, 60)
    docs = [(1, passage), (2, passage + " more"), (3, None)]
    names = ("n_words", "n_removed", "kept_text", "passages", "key", "start", "stop", "own_id", "odd name")
    schema = "doc_id long, text string, " + ", ".join(f"`{n}` string" for n in names)
    df = spark.createDataFrame([(*d, *(f"{n}!" for n in names)) for d in docs], schema)
    found = remove_repeated(df)
    assert found.columns == ["doc_id", "text", *names[3:], "n_words", "n_removed", "kept_text"]
    assert sorted(map(tuple, found.select("doc_id", "n_words", "n_removed", "kept_text").collect())) == brute_force(docs, 50)
    assert {tuple(r) for r in found.select(*(f"`{n}`" for n in names[3:])).collect()} == {tuple(f"{n}!" for n in names[3:])}
