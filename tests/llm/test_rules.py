"""Statistics against plain Python, trees against a walk node by node, their directions, and held-out accuracy."""

import random
import re
import zlib
from collections import Counter

import numpy as np
import pyarrow as pa
import pytest

from fundlake.llm import rules
from fundlake.llm.rules import COUNTS, FALLING, FEATURES, apply_rules, fit, op12_rules, statistics
from tests_support import write_tables

ODD = [
    None, "", " ", "\n\n\t", "a", "a b c d e", "a " * 40, "a b c d e a b c d e", "x\ny\nx\n \nx", "\r\na\r\na\na", "#*$%&|<> | |", "日本 語　é\x1cb\x85c d",
    "one two three four five. " * 3 + "\n" + "six\n" * 4, "A b C d E f G h I j " * 2, "😀 " * 12, "\x0b\x0cq\x0b",
]


def brute(text):
    text = text or ""
    words = re.findall(r"[^\x20\x09-\x0D]+", text)
    windows = [tuple(words[i : i + 5]) for i in range(len(words) - 4)]
    times = Counter(windows)
    covered = {i + k for i, w in enumerate(windows) if times[w] > 1 for k in range(5)}
    seen, dup = set(), 0
    for line in text.split("\n"):
        dup += bool(re.search(r"[^\x20\x09-\x0D]", line)) and line in seen
        seen.add(line)
    return len(words), sum(map(len, words)), len(re.findall(r"[#*$%&|<>]", text)), dup, len(covered)


def made_up(seed, rows):
    pick = random.Random(seed)
    word = lambda: pick.choice(["a", "b", "lo", "rem", "é", "|", "x#", "Stop.", "die"])
    return ["".join(word() + pick.choice(["  ", " ", " ", "\n", "\t"]) for _ in range(pick.choice([0, 3, 8, 30, 300]))) for _ in range(rows)]


def test_counts_against_plain_python():
    for texts in ([], ODD, [ODD[7]], made_up(1, 200), made_up(2, 1), [*made_up(3, 3), "word " * 200_000, "é" * 500_000]):
        found = statistics(pa.array(texts, pa.string()))
        assert [tuple(map(int, row)) for row in zip(*(found[c] for c in COUNTS), strict=True)] == [brute(t) for t in texts]
        assert all(np.isfinite(found[f]).all() and len(found[f]) == len(texts) for f in FEATURES)


def test_statistics_do_not_depend_on_the_batch():
    texts = ODD + made_up(4, 60)
    together = statistics(pa.array(texts, pa.string()))
    for k, text in enumerate(texts):
        alone = statistics(pa.array([text], pa.string()))
        assert all(np.isclose(alone[name][0], together[name][k]) for name in together)


def walk(model, row):
    total = model.base
    for t in range(len(model.feature)):
        at = 0
        for _ in range(model.depth):
            at = 2 * at + (1 if row[model.feature[t, at]] <= model.threshold[t, at] else 2)
        total += model.value[t, at]
    return 1 / (1 + np.exp(-total))


def noisy(seed, rows):
    pick = np.random.default_rng(seed)
    x = pick.normal(size=(rows, 4)).round(1)
    y = (np.sin(2 * x[:, 0]) - x[:, 1] + (x[:, 2] > 0) * x[:, 3] + pick.normal(size=rows) * 0.4 > 0).astype(float)
    return x, y


def test_flat_trees_walk_like_trees():
    x, y = noisy(1, 3000)
    model = fit(x, y, np.array([0, -1, 0, 0]))
    assert np.allclose(model.score(x[:200]), [walk(model, row) for row in x[:200]])
    test_x, test_y = noisy(2, 1000)
    assert ((model.score(test_x) >= 0.5) == test_y).mean() > 0.85


@pytest.mark.parametrize("sign", [-1, 1])
def test_directions_hold_everywhere(sign):
    x, y = noisy(3, 2000)
    model = fit(x, y, np.array([sign, sign, 0, sign]))
    free = fit(x, y)
    grid = np.linspace(-4, 4, 161)
    broken = 0
    for row in np.random.default_rng(4).normal(size=(60, 4)):
        for k in (0, 1, 3):
            many = np.repeat(row[None, :], len(grid), axis=0)
            many[:, k] = grid
            assert (np.diff(model.score(many)) * sign >= -1e-12).all()
            broken += (np.diff(free.score(many)) * sign < -1e-12).any()
    assert broken  # it is the direction that does this, not the data


def test_one_label_or_none_gives_the_prior():
    assert fit(np.zeros((0, 2)), np.zeros(0)).score(np.zeros((2, 2))).tolist() == [0.5, 0.5]
    assert np.isclose(fit(np.zeros((3, 2)), np.ones(3)).score(np.zeros((1, 2)))[0], 0.8)
    assert FALLING and set(FALLING) < set(FEATURES)


def text_of(good, seed):
    pick = random.Random(seed)
    words = ["".join(pick.choices(["ka", "lo", "mi", "ta", "re"], k=pick.randint(1, 4))) for _ in range(60)]
    return " ".join(words[i] + (". " if i % 9 == 8 else "") for i in range(60)) if good else " | ".join(words)


def test_rows_limits_and_held_out_accuracy(spark):
    docs = [(i, text_of(i % 2, i), "kept") for i in range(400)]
    odd = [(1000, None), (1001, ""), (1002, "few words here."), (1003, "one two three four five six. " * 9), (None, text_of(1, 7)), (7, docs[7][1]), (1004, "z" * 400_000)]
    df = spark.createDataFrame(docs + [(*d, "x") for d in odd], "doc_id long, text string, kept string")
    labels = spark.createDataFrame([(i, i % 2) for i in range(400)] + [(3, 0), (5, None), (None, 1), (9999, 1)], "doc_id long, quality int")
    rows = apply_rules(df, labels).collect()
    assert len(rows) == len(docs) + len(odd)
    texts = dict([d[:2] for d in docs] + odd)
    for r in rows:
        assert tuple(r[c] for c in COUNTS) == brute(texts[r.doc_id])
        assert r.base_failed == (r.n_words < 10 or 100 * r.n_repeat_words > 20 * r.n_words)
        assert r.kept == (not r.base_failed and r.score >= 0.5) and 0 <= r.score <= 1
    held = [r for r in rows if r.held_out]
    assert all(zlib.crc32(str(r.doc_id).encode()) % 3 == 1 for r in held)
    assert sum(r.kept == r.doc_id % 2 for r in held if r.doc_id < 400) >= 0.98 * len(held) - 2
    assert {r.score for r in apply_rules(df, labels.limit(0)).collect()} == {0.5}
    assert apply_rules(df.limit(0), labels).collect() == []


def test_training_rows_are_bounded(spark, monkeypatch):
    seen = []
    monkeypatch.setattr(rules, "fit", lambda x, y, d: seen.append(len(y)) or fit(x, y, d))
    docs = spark.createDataFrame([(i, "a b") for i in range(60)], "doc_id long, text string")
    apply_rules(docs, docs.selectExpr("doc_id", "cast(doc_id % 2 as int) quality"), training_rows=10)
    assert seen == [10]


def test_query_over_tables(spark, tmp_path):
    docs = [(i, text) for i, text in enumerate(ODD)]
    folder = write_tables(spark, tmp_path, documents=(docs, "doc_id long, text string"), labels=([(1, 0)], "doc_id long, quality int"))
    assert {r.doc_id: tuple(r[c] for c in COUNTS) for r in op12_rules(spark, folder).collect()} == {i: brute(t) for i, t in docs}
