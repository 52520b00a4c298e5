"""Neighbour search against all pairs."""

import math

import numpy as np
import pytest

from fundlake.llm import neighbours
from fundlake.llm.neighbours import balanced_cut, nearest, search


def frame(spark, rows):
    return spark.createDataFrame([(i, None if v is None else [x if x is None else float(x) for x in v], "x") for i, v in rows], "vec_id long, embedding array<float>, score string")


def exact(rows, queries, k):
    ids = np.array([i for i, _ in rows])
    base = np.array([v for _, v in rows], dtype=np.float32).astype(np.float64)
    out = {}
    for q in queries:
        own = base[ids == q][0]
        scores = (base * own).sum(1)
        order = [n for n in np.lexsort((ids, -scores)) if ids[n] != q][:k]
        out[q] = [(int(ids[n]), float(scores[n])) for n in order]
    return out


def found(df):
    out = {}
    for r in sorted(df.collect(), key=lambda r: (r.query_id, r["rank"])):
        out.setdefault(r.query_id, []).append((r.vec_id, r.score))
        assert r["rank"] == len(out[r.query_id])
    return out


def test_small_tables_are_searched_whole_with_ties(spark):
    pick = np.random.default_rng(1)
    rows = [(n, pick.normal(size=6)) for n in range(150)] + [(200 + n, np.ones(6) * 3) for n in range(60)]
    df = frame(spark, rows)
    assert found(search(df, df.where("vec_id % 20 = 0"))) == exact(rows, [q for q, _ in rows if q % 20 == 0], 20)


def test_odd_vectors_take_no_part(spark):
    odd = [(1, None), (2, []), (3, [0, 0]), (4, [1, None]), (5, [math.nan, 1]), (6, [math.inf, 1]), (7, [1, 2, 3]), (None, [1, 1])]
    rows = [(20, [1, 0]), (40, [0, 1]), (8, [1, 1]), (9, [-1, 0])]
    df = frame(spark, odd + rows + [rows[2]])
    assert found(search(df, df, k=5)) == exact(rows, [20, 40, 8, 9], 5)
    lone = df.where("vec_id in (3, 20)")
    assert search(lone, lone).collect() == [] and search(df.limit(0), df).collect() == []


@pytest.fixture
def small_parts(monkeypatch):
    for name, value in {"SAMPLE": 900, "PART": 100, "BLOCK": 60, "LEAST": 40}.items():
        monkeypatch.setattr(neighbours, name, value)


def test_recall_over_learned_parts(spark, small_parts):
    pick = np.random.default_rng(3)
    centres = pick.normal(size=(25, 16))
    rows = [(n, centres[n % 25] + 0.35 * pick.normal(size=16)) for n in range(2400)]
    df, queries = frame(spark, rows), [q for q, _ in rows if q % 20 == 0]
    want, got = exact(rows, queries, 10), found(search(df, df.where("vec_id % 20 = 0"), k=10))
    hits = sum(len({i for i, _ in want[q]} & {i for i, _ in got[q]}) for q in queries)
    assert hits >= 0.9 * 10 * len(queries)
    assert all(math.isclose(s, dict(want[q])[i], rel_tol=1e-12) for q in queries for i, s in got[q] if i in dict(want[q]))
    assert [r for r in got] == queries and all(len(x) == 10 for x in got.values())


def test_a_vector_that_many_rows_share(spark, small_parts):
    pick = np.random.default_rng(4)
    rows = [(n, np.full(8, 2.0) if n % 3 == 0 else pick.normal(size=8)) for n in range(1200)]
    df = frame(spark, rows)
    got = found(search(df, df.where("vec_id in (0, 20, 60)"), k=10))
    want = exact(rows, [0, 60], 10)
    assert got[0] == want[0] and got[60] == want[60]


def test_parts_are_balanced_and_cut_few_edges():
    pick = np.random.default_rng(5)
    vectors = np.concatenate([pick.normal(c, 0.1, size=(100, 4)) for c in pick.normal(size=(4, 4)) * 5])
    graph = nearest(vectors, vectors, 8, np.arange(400))
    part = balanced_cut(vectors, graph, 4)
    assert np.bincount(part).max() <= 106 and (part[graph] == part[:, None]).mean() > 0.9
