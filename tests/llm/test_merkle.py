"""The manifest against trees built level by level in plain Python."""

import random
import zlib
from collections import defaultdict
from hashlib import sha256

import pytest

from fundlake.llm.merkle import Frontier, document_manifest, op11_merkle, proof_digest, verified, witnesses
from tests_support import write_tables

SCHEMA = "doc_id long, source string, lang string, n_chars long, text string, tree string, place string, node string, witness string"


def h(*parts):
    return sha256("".join(parts).encode()).hexdigest()


def leaf(doc_id, source, lang, n_chars, text):
    return h(*("-" if v is None else f"{len(str(v).encode())}:{v}" for v in (doc_id, source, lang, n_chars, text)))


def tree(nodes):
    """Root, and for each node its steps (left siblings, right siblings)."""
    steps, members = [[] for _ in nodes], [[k] for k in range(len(nodes))]
    while len(nodes) > 1:
        pairs = [(nodes[i : i + 2], members[i : i + 2]) for i in range(0, len(nodes), 2)]
        for pair, owners in pairs:
            for side, owned in enumerate(owners):
                for k in owned:
                    steps[k].append(("".join(pair[:side]), "".join(pair[side + 1 :])))
        nodes, members = [h(*pair) for pair, _ in pairs], [sum(owners, []) for _, owners in pairs]
    return nodes[0], steps


def brute(docs):
    groups = defaultdict(list)
    for d in docs:
        claim = leaf(*d)
        if d[0] is not None and d[3] is not None and zlib.crc32(str(d[0]).encode()) % 7 == 0:
            claim = leaf(*d[:3], d[3] + 1, d[4])
        groups[d[2]].append((d[0] is not None, d[0] or 0, leaf(*d), claim, d[0]))
    order = sorted(groups, key=lambda g: (g is not None, (g or "").encode()))
    trees = {g: tree([x[2] for x in sorted(groups[g])]) for g in order}
    root, above = tree([trees[g][0] for g in order]) if order else ("", [])
    out = []
    for k, g in enumerate(order):
        for (_, _, own, claim, doc_id), below in zip(sorted(groups[g]), trees[g][1], strict=True):
            steps, node = below + above[k], claim
            for left, right in steps:
                node = h(left, node, right)
            out.append((doc_id, own, trees[g][0], root, h(*(a + b for a, b in steps)), node, node == root))
    return sorted(out, key=str)


def found(docs_df, block):
    listed = verified(document_manifest(docs_df, block).selectExpr("*", "coalesce(tampered, leaf) claimed"))
    rows = listed.select("doc_id", "leaf", "subroot", "root", proof_digest(listed.witness), "folded_root", "verified").collect()
    return sorted((tuple(r) for r in rows), key=str)


def sample(seed, rows):
    pick = random.Random(seed)
    langs = [None, "", "a", "é", "z", "日本", "big", "big", "big", "big"]
    return [
        (pick.choice([None, i, i, i, -i, 3]), pick.choice([None, "", "web"]), pick.choice(langs), pick.choice([None, i, 2**63 - 1]), pick.choice([None, "", "text", "ü" * i]))
        for i in range(rows)
    ]


@pytest.mark.parametrize("rows, block", [(1, 2), (2, 2), (3, 4), (57, 2), (90, 4), (200, 16), (200, 1024)])
def test_against_level_by_level(spark, rows, block):
    docs = sample(rows, rows)
    docs += docs[: rows // 3]  # equal rows
    df = spark.createDataFrame([(*d, "t", "p", "n", "w") for d in docs], SCHEMA)
    assert found(df, block) == brute(docs)


@pytest.mark.parametrize("rows", [5, 8, 64, 65])
def test_one_group_of_equal_rows(spark, rows):
    docs = [(7, "s", "en", 1, "same")] * rows
    assert found(spark.createDataFrame([(*d, "t", "p", "n", "w") for d in docs], SCHEMA), 4) == brute(docs)


def test_long_texts_and_no_rows(spark):
    docs = [(1, "s", "en", 3_000_000, "é" * 3_000_000), (2, None, None, None, None)]
    assert found(spark.createDataFrame([(*d, "t", "p", "n", "w") for d in docs], SCHEMA), 2) == brute(docs)
    assert found(spark.createDataFrame([], SCHEMA), 2) == []


def test_open_subtrees_follow_the_bits_of_their_number():
    frontier = Frontier()
    for k in range(1, 100):
        frontier.append(str(k))
        assert [tree.height for tree in frontier.open] == [b for b in range(7, -1, -1) if k >> b & 1]
    assert sum(len(t.witnesses) for t in frontier.open) == 99


def test_block_sizes_are_checked(spark):
    with pytest.raises(ValueError, match="power of two"):
        witnesses(spark.createDataFrame([], "tree string, place long, size long, node string"), 3)


def test_query_over_a_table(spark, tmp_path):
    docs = sample(5, 70)
    folder = write_tables(spark, tmp_path, documents=([(*d, "t", "p", "n", "w") for d in docs], SCHEMA))
    assert sorted((tuple(r) for r in op11_merkle(spark, folder).collect()), key=str) == brute(docs)
