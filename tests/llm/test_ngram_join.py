"""The shingle join against all pairs, and the pigeonhole it rests on."""

import random

import numpy as np
import pytest

from fundlake.llm import ngram_join
from fundlake.llm.components import components
from fundlake.llm.ngram_join import SINGLES, budget, channels, near_duplicates, shingles, signatures, similar


def shingle_set(text):
    lower = (text or "").translate(str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"))
    words = lower.encode().split()
    return frozenset(tuple(words[k : k + 5]) for k in range(max(1, len(words) - 4))) if words else frozenset()


def brute_force(docs):
    sets = [(doc, shingle_set(text)) for doc, text in docs]
    leader = {doc: doc for doc, _ in docs if doc is not None}

    def top(k):
        while leader[k] != k:
            k = leader[k]
        return k

    for i, (a, x) in enumerate(sets):
        for b, y in sets[:i]:
            if a is not None and b is not None and x and y and 100 * len(x & y) >= 75 * len(x | y):
                low, high = sorted((top(a), top(b)))
                leader[high] = low
    return sorted(((doc, len(s), None if doc is None else top(doc)) for doc, s in sets), key=str)


def compare(spark, docs):
    df = spark.createDataFrame([(d, t, "x", 1) for d, t in docs], "doc_id long, text string, key string, n int")
    assert sorted(map(tuple, near_duplicates(df).collect()), key=str) == brute_force(docs)


def edited(pick, words, share):
    words = list(words)
    for _ in range(max(1, int(len(words) * share))):
        at = pick.randrange(len(words))
        words[at : at + pick.randrange(2)] = [f"n{pick.randrange(10**6)}"] * pick.randrange(2)
    return words


def family_docs(seed, families, copies, longest=160):
    pick, docs = random.Random(seed), []
    for _ in range(families):
        own = [f"w{pick.randrange(40 if pick.random() < 0.2 else 5000)}" for _ in range(pick.randrange(1, longest))]
        docs.append(own)
        docs += [edited(pick, own, pick.choice((0.01, 0.03, 0.06))) for _ in range(pick.randrange(copies))]
    pick.shuffle(docs)
    return [(n * 3 + 1, " ".join(d)) for n, d in enumerate(docs)]


@pytest.mark.parametrize("seed", [1, 2])
def test_families_of_edited_texts(spark, seed):
    compare(spark, family_docs(seed, 70, 6))


def test_short_texts(spark):
    pick = random.Random(3)
    compare(spark, [(n, " ".join(pick.choices("abc", k=pick.randrange(14)))) for n in range(250)])


def test_odd_rows(spark):
    passage = " ".join(f"p{n}" for n in range(60))
    long = " ".join(f"l{n % 4000}" for n in range(12_000))
    docs = [
        (1, None), (2, ""), (3, " \t\n"), (4, "One two"), (5, "one TWO"), (6, "two one"), (None, "one two"), (7, "ÉA b c d e f"), (8, "éA b c d e f"),
        (9, "a b c d e"), (10, "A b\vc d e"), (11, "a " * 900), (12, "a " * 7), (13, long), (14, long + " tail of it"), (15, long[:9000]),
        (-5, "one two"), (16, "same text here that repeats"), (16, "same text here that repeats"), (17, "x " + passage), (18, passage + " y z"),
        (None, None),
    ]
    docs += [(100 + n, f"{passage} {' '.join(f'u{n}x{k}' for k in range(n))}") for n in range(60)]
    compare(spark, docs)
    assert near_duplicates(spark.createDataFrame([], "doc_id long, text string")).collect() == []


def test_large_families_split_over_blocks_and_buckets(spark, monkeypatch):
    monkeypatch.setattr(ngram_join, "BLOCK", 5)
    monkeypatch.setattr(ngram_join, "TOGETHER", 300)
    compare(spark, family_docs(5, 6, 40, 60) + [(5000 + n, "one text that many documents have word for word") for n in range(150)])


def test_similar_sets_agree_in_as_many_segments_as_needed():
    pick = np.random.default_rng(7)
    for size in [*range(3, 40), 63, 64, 95, 96, 97, 127, 128, 200, 400, 1000]:
        for _ in range(6):
            x = np.unique(pick.integers(0, 2**63, size).astype(np.uint64))
            most = budget(len(x), channels(len(x))[-1])
            gone = pick.integers(0, min(most, len(x) // 4) + 1)
            y = np.unique(np.concatenate([x[gone:], pick.integers(0, 2**63, max(0, (most - gone) // 2)).astype(np.uint64)]))
            common = len(np.intersect1d(x, y))
            if 100 * common < 75 * (len(x) + len(y) - common) or common == max(len(x), len(y)):
                continue
            sides = [{c: (need, dict(zip(s.tolist(), t.tolist(), strict=True))) for c, need, s, t in signatures(z)} for z in (x, y)]
            met = [c for c in sides[0] if c in sides[1] and all(weight(*side[c], sides[1 - k][c][1]) for k, side in enumerate(sides))]
            assert met, (size, len(y), common)


def weight(need, own, other):
    shared = [own[s] for s in own if s in other]
    deleted = {t for t in shared if t & 255}
    return shared and sum(t & 255 == 0 for t in shared) + sum(1 + (t & 1) for t in deleted) >= need


def test_weak_sets_send_single_shingles(monkeypatch):
    monkeypatch.setattr(ngram_join, "plan", lambda channel: (2, 0))
    assert SINGLES in [c for c, *_ in signatures(shingles(" ".join(map(str, range(100)))))]


def test_links_span_the_groups():
    sets = [np.arange(a, a + 100, dtype=np.uint64) for a in (0, 5, 10, 500, 503, 1000)]
    assert sorted(similar(list(range(6)), sets, 0)) == [(0, 1), (0, 2), (3, 4)]
    assert similar(list(range(6)), sets, 3) == []


def test_components(spark):
    pick = random.Random(9)
    edges = [(n, n + 1) for n in range(60)] + [(200, 100 + n) for n in range(50)] + [(pick.randrange(300, 400), pick.randrange(300, 400)) for _ in range(60)] + [(7, 7), (1, 0)]
    leader = {n: n for e in edges for n in e}
    for _ in range(100):
        for a, b in edges:
            leader[a] = leader[b] = min(leader[a], leader[b])
    got = {r.id: r.component_id for r in components(spark.createDataFrame(edges, "a long, b long")).collect()}
    assert all(got.get(n, n) == low for n, low in leader.items())
    assert components(spark.createDataFrame([], "a long, b long")).collect() == []


def test_words_longer_than_a_group_of_multipliers(spark):
    """Bytes that stand 64, 128 or 64,000 apart change places, and texts without spaces."""
    docs = [(1, "a" + "m" * 63 + "b"), (2, "b" + "m" * 63 + "a"), (3, "a" + "m" * 127 + "b"), (4, "b" + "m" * 127 + "a")]
    docs += [(5, "x" + "日本語" * 21_333 + "y"), (6, "y" + "日本語" * 21_333 + "x"), (7, "http://e.example/" + "q/" * 90 + "a"), (8, "http://e.example/" + "q/" * 90 + "a")]
    compare(spark, docs)
    assert len({shingles(text).tobytes() for _, text in docs}) == 7


def test_blocks_are_compared_in_pieces(monkeypatch):
    pick = np.random.default_rng(4)
    base = np.sort(pick.choice(10**6, 200, replace=False)).astype(np.uint64)
    sets = [np.unique(np.concatenate([base[pick.random(200) > 0.08], pick.choice(10**6, 6).astype(np.uint64)])) for _ in range(40)]
    sets += [np.sort(pick.choice(10**6, 150, replace=False)).astype(np.uint64) for _ in range(10)]
    ids = list(range(50))

    def groups(links):
        own = dict(zip(ids, ids, strict=True))
        for a, b in links:
            low, high = sorted((own[a], own[b]))
            own = {k: low if v == high else v for k, v in own.items()}
        return own

    for split in (0, 20):
        monkeypatch.setattr(ngram_join, "SHINGLES_TOGETHER", 10**6)
        whole = ngram_join.similar_pieces(ids, sets, split)
        assert whole == similar(ids, sets, split)
        for together in (1, 500, 2000):
            monkeypatch.setattr(ngram_join, "SHINGLES_TOGETHER", together)
            assert groups(ngram_join.similar_pieces(ids, sets, split)) == groups(whole)


def test_sketches_keep_similar_sets_and_tell_others_apart():
    pick = np.random.default_rng(8)
    for size in (3, 20, 63, 64, 65, 90, 128, 129, 500, 1030, 5000):
        own = np.unique(pick.integers(0, 2**63, size).astype(np.uint64))
        most = 2 * len(own) // 7
        sets, similar_to_own = [own], [True]
        for gone in range(0, most + 1, max(1, most // 9)):
            for new in {0, max(0, (most - gone) // 2), most - gone}:
                other = np.concatenate([pick.permutation(own)[gone:], pick.integers(0, 2**63, new).astype(np.uint64)])
                common = len(own) - gone
                sets.append(np.unique(other))
                similar_to_own.append(100 * common >= 75 * (len(own) + len(sets[-1]) - common))
        sizes, sketches = np.array([len(s) for s in sets]), [ngram_join.sketch(s) for s in sets]
        assert max(map(len, sketches)) <= max(8, 5 * size // 16)
        stay = ngram_join.possible(sizes, sketches, 1)
        assert stay[0] and stay[similar_to_own].all(), size
        assert ngram_join.possible(sizes, sketches, 0)[similar_to_own].all()
    lone = [np.unique(np.concatenate([own[:40], pick.integers(0, 2**63, 300 + n).astype(np.uint64)])) for n in range(200)]
    assert not ngram_join.possible(np.array([len(s) for s in lone]), [ngram_join.sketch(s) for s in lone], 100).any()


def test_sets_without_a_possible_partner_are_not_brought_together(spark, monkeypatch):
    """Short texts that share one passage meet in signatures; their sets stay where they are. In rounds the links are the same."""
    pick = random.Random(6)
    docs = family_docs(11, 25, 5, 90)
    docs += [(9000 + n, " ".join(["a passage that stands in all of these"] * 2 + [f"w{pick.randrange(10**6)}" for _ in range(pick.randrange(9, 30))])) for n in range(120)]
    docs += [(1, docs[0][1])] * 3 + [(9500, "one row of this id")] * 40 + [(9500, f"other {n} rows of this id have other texts") for n in range(5)]
    rounds, brought = ngram_join._in_rounds, {}

    def small(rows, size, most, name, meet):
        brought.setdefault(name, []).append(rows.count())
        return rounds(rows, size, 6_000, name, meet)

    monkeypatch.setattr(ngram_join, "BLOCK", 8)
    monkeypatch.setattr(ngram_join, "_in_rounds", small)
    compare(spark, docs)
    assert 0 < brought["links"][0] < len(docs)
