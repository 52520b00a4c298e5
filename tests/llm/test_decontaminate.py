"""Benchmark passages against plain dynamic programming over whole texts."""

import random

import pytest

from fundlake.llm import decontaminate
from fundlake.llm.decontaminate import EDITS, Benchmark, Passages, Q, aligned, contaminations, find, plain


def distance(passage, text):
    """Least edits between a passage and any part of a text."""
    row = [0] * (len(text) + 1)
    for k, c in enumerate(passage, 1):
        new = [k]
        for j, d in enumerate(text, 1):
            new.append(min(row[j - 1] + (c != d), row[j] + 1, new[-1] + 1))
        row = new
    return min(row)


def edit(pick, text, edits):
    for _ in range(edits):
        at = pick.randrange(len(text))
        text = text[:at] + pick.choice(["", "q", "zz"[: pick.randrange(1, 2)]]) + text[at + pick.randrange(2) :]
    return text


def prose(pick, words):
    return " ".join("".join(pick.choices(["ti", "on", "er", "ha", "st", "en"], k=pick.randrange(1, 5))) for _ in range(words))


def found(items, text):
    """Edits of each item that the benchmark finds in a plain text."""
    benchmark = Benchmark(items)
    rows = decontaminate._look(benchmark, [(1, text)])
    assert all(0 <= start <= stop <= len(text) for _, _, _, start, stop in rows)
    return {item: edits for _, item, edits, _, _ in rows}


def expected(items, text):
    out = {}
    for item, own in ((i, plain(t)) for i, t in items):
        if 0 < len(own) < Q and f" {own} " in f" {text} ":
            out[item] = 0
        elif len(own) >= Q and (d := distance(own, text)) <= int(len(own) * EDITS):
            out[item] = d
    return out


@pytest.mark.parametrize("seed", range(4))
def test_every_passage_within_the_budget_is_found(seed):
    pick = random.Random(seed)
    items = [(n, prose(pick, pick.randrange(3, 40))) for n in range(12)]
    for _ in range(12):
        item, text = pick.choice(items)
        own = plain(prose(pick, 30) + " " + edit(pick, text, pick.randrange(0, int(len(text) * EDITS) + 3)) + " " + prose(pick, 30))
        assert found(items, own) == expected(items, own)


@pytest.mark.parametrize("length", [*range(1, 13), 15, 19, 20, 21, 29, 30, 31, 39, 40, 79, 80, 81, 120, 200])
def test_passages_of_every_length(length):
    """With no edit, as many as are allowed, and one more, in the middle and at the ends of a text."""
    pick = random.Random(length)
    text = plain(prose(pick, 80))[:length].strip().ljust(length, "z")
    allowed = int(length * EDITS)
    for edits in sorted({0, allowed, allowed + 1}):
        for before, after in ((prose(pick, 20) + " ", " " + prose(pick, 20)), ("", " " + prose(pick, 5)), (prose(pick, 5) + " ", "")):
            own = plain(before + (edit(pick, text, edits) if edits else text) + after)
            assert found([(1, text)], own) == expected([(1, text)], own)


def test_short_items_are_whole_words():
    items = [(1, "E = mc2"), (2, "人工智能大学"), (3, "mc")]
    assert found(items, plain("so e=MC2, he wrote: 人工智能大学。")) == {2: 0} | ({1: 0} if plain("e=MC2") == plain("E = mc2") else {})
    assert found(items, plain("xe mc2 mcx")) == {} and found(items, plain("mc e mc2")) == {1: 0, 3: 0}


def test_the_band_alone_is_aligned():
    pick = random.Random(3)
    for _ in range(200):
        own, text = plain(prose(pick, 8)), plain(prose(pick, 20))
        codes = [decontaminate._codes(x) for x in (own, text)]
        got = aligned(*codes, -len(own), len(text), 10**6)  # all diagonals
        assert got[0] == distance(own, text)
    own = decontaminate._codes("abcdefghij")
    assert aligned(own, decontaminate._codes("xxxabcdefghijxxx"), 3, 3, 1) == (0, 13)
    assert aligned(own, decontaminate._codes("xxxabcdefghijxxx"), 9, 9, 1) is None


def test_runs_that_thousands_of_passages_share_are_counted_in_pieces(monkeypatch):
    pick = random.Random(5)
    items = [(n, "which of the following is true about " + prose(pick, 6)) for n in range(60)]
    text = plain(" ".join("which of the following is true about " + prose(pick, 3) for _ in range(20)) + " " + items[7][1])
    whole = found(items, text)
    monkeypatch.setattr(decontaminate, "RUNS_TOGETHER", 500)
    sizes = []
    original = Passages._bands
    monkeypatch.setattr(Passages, "_bands", lambda self, at, found, count, span: sizes.append(int(count.sum())) or original(self, at, found, count, span))
    assert found(items, text) == whole == expected(items, text) and whole[7] == 0
    assert max(sizes) <= 500 + 60


def test_places_point_at_the_passage():
    text = plain("x " * 40 + "Éin Satz, der GEPRÜFT wird; nichts sonst." + " y" * 40)
    (hit,) = find(Passages([(5, "ein satz der geprüft wird nichts sonst")]), text).values()
    assert hit[0] == 1 and text[hit[1] : hit[2]].endswith("nichts sonst")


def test_documents_alone_and_together(spark, monkeypatch):
    pick = random.Random(11)
    items = [(n, prose(pick, 30)) for n in range(8)] + [(50, None), (51, ""), (52, "tiny"), (53, "!?"), (7, prose(pick, 30)), (None, prose(pick, 20))]
    docs = [(n, prose(pick, pick.randrange(0, 50)) + ("\n" + items[n % 8][1].upper().replace(" ", " - ") if n % 3 == 0 else "")) for n in range(60)]
    docs += [(100, None), (101, ""), (102, " "), (None, items[0][1]), (103, prose(pick, 3000) + items[1][1] + prose(pick, 3000)), (0, docs[0][1])]
    df = spark.createDataFrame([(d, t, 0) for d, t in docs], "doc_id long, text string, item_id int")
    bench = spark.createDataFrame([(i, t, 0) for i, t in items], "item_id long, text string, edits int")
    want = sorted(
        ((d, i) for d, t in docs if t for i, b in items if b and plain(b) and (f" {plain(b)} " in f" {plain(t)} " if len(plain(b)) < Q else plain(b) in plain(t))), key=str
    )

    def got():
        return sorted(((r.doc_id, r.item_id) for r in contaminations(df, bench).collect()), key=str)

    assert got() == want and len(want) > 20
    monkeypatch.setattr(decontaminate, "PASSAGES_TOGETHER", 300)
    monkeypatch.setattr(decontaminate, "TEXT_TOGETHER", 500)
    assert got() == want
    assert contaminations(df, bench.limit(0)).collect() == []
    assert contaminations(df.limit(0), bench).collect() == []
