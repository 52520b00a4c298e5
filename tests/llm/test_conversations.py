"""Repair against a plain search over all edits, in chunks small enough that every scan has several levels."""

import random
import re
import zlib
from functools import lru_cache
from hashlib import sha256

import pytest

from fundlake.llm.conversations import END, before, damaged, matrix_of, op13_conversations, power, repair, then, unroll
from tests_support import write_tables

SCHEMA = "conv_id long, turn long, role string, text string, conv string, place long, symbols string"
TARGET = re.compile(r"(s?(ua)+)?")
NEXT = {"": "u", "s": "u", "u": "a", "a": "u"}


def search(rows):
    """Cheapest (cost, audit, lines) of rows (role, text, fault); states are the last initial."""

    @lru_cache(maxsize=None)
    def best(k, last, inserted=0):
        found = []
        if inserted < 2:
            cost, audit, lines = best(k, NEXT[last], inserted + 1)
            role = {"u": "user", "a": "assistant"}[NEXT[last]]
            found.append((5 + cost, "I" + audit, ((role + ":"),) + lines))
        if k == len(rows):
            return min(found + ([(0, "", ())] if last in ("", "a") else []), default=(10**9, "", ()))
        role, text, fault = rows[k]
        cost, audit, lines = best(k + 1, last)
        found.append((2 + cost, "D" + audit, lines))
        if fault not in ("blank", "duplicate"):
            extra = 5 if fault == "truncated" else 0
            if role[:1] == NEXT[last] or (role[:1], last) == ("s", ""):
                cost, audit, lines = best(k + 1, role[:1])
                found.append((extra + cost, "K" + audit, (f"{role}:{text}",) + lines))
            cost, audit, lines = best(k + 1, NEXT[last])
            found.append((1 + extra + cost, "R" + audit, ({"u": "user", "a": "assistant"}[NEXT[last]] + f":{text}",) + lines))
        return min(found)

    # One row of the recursion per row of the conversation: fill the cache from the end.
    for k in range(len(rows), -1, -1):
        for last in NEXT:
            best(k, last)
    return best(0, "")


def said(role, text):
    return sha256(f"{len(role.encode())}:{role}{text}".encode()).hexdigest()


def brute(rows):
    """Expected result of rows (turn, role, text) of one conversation after damage."""
    rows = [(t, " " if r is None else r, " " if x is None else x) for t, r, x in rows]
    rows.sort(key=lambda r: (r[0] is not None, r[0] or 0, said(r[1], r[2])))
    seen, marked = set(), []
    for _, role, text in rows:
        solid = re.sub(r"[\x20\x09-\x0D]", "", text)
        fault = "blank" if not solid else "duplicate" if (role, text) in seen else "truncated" if solid[-1] not in ".!?" else ""
        seen.add((role, text))
        marked.append((role, text, fault))
    faults = [f for *_, f in marked]
    pairs = [a[0][:1] + b[0][:1] for a, b in zip(marked, marked[1:])]
    turns = {t for t, *_ in rows if t is not None}
    cost, audit, lines = search(tuple(marked))
    assert TARGET.fullmatch("".join(line[:1] for line in lines))
    return (
        max(turns) - min(turns) + 1 - len(turns) if turns else 0, faults.count("blank"), faults.count("duplicate"), faults.count("truncated"),
        sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, sha256("\n".join(lines).encode()).hexdigest(),
    )


def made_up(seed, conversations, most=12):
    pick = random.Random(seed)
    roles = ["system", "user", "user", "assistant", "assistant", "tool", "", None, "s", "Üser"]
    texts = ["Yes.", "No!", "why", "half a", "", " \t", None, "x.", "y?", "z. \n", "é", "ok.\x85"]
    rows = []
    for conv in range(conversations):
        for turn in range(pick.randint(1, most)):
            same = pick.random() < 0.4
            text = pick.choice(texts) if same else f"text {conv} {turn}" + pick.choice([".", "", "?"])
            rows.append((pick.choice([conv, conv, conv, None]) if conv % 9 == 0 else conv, pick.choice([turn, turn, turn, 0, None, -turn]), pick.choice(roles), text))
    return rows


def groups(rows):
    out = {}
    for conv, *row in rows:
        out.setdefault(conv, []).append(tuple(row))
    return out


def frame(spark, rows):
    return spark.createDataFrame([(*r, "c", 1, "s") for r in rows], SCHEMA)


def found(df):
    return {(None if r.conv == "" else int(r.conv[1:])): tuple(r)[1:] for r in df.collect()}


@pytest.mark.parametrize("chunk, fan", [(1, 2), (2, 2), (3, 4), (4096, 1024)])
def test_against_a_search_over_all_edits(spark, chunk, fan):
    rows = made_up(chunk, 120)
    assert found(repair(frame(spark, rows), chunk, fan)) == {conv: brute(g) for conv, g in groups(rows).items()}


def test_a_long_conversation_in_many_chunks(spark):
    pick = random.Random(5)
    rows = [(1, turn, pick.choice(["user"] * 30 + ["assistant"] * 5 + ["system"]), f"t{turn}" + pick.choice(["."] * 6 + [""])) for turn in range(600)]
    rows += [(2, 0, "user", "same.")] * 300 + [(3, k, "user", "") for k in range(300)] + [(4, 2**63 - 1, "user", "a."), (4, -(2**63), "assistant", "b.")]
    got = found(repair(frame(spark, rows), 16, 3))
    expected = {conv: brute(g) for conv, g in groups(rows).items()}
    expected[4] = (2**63 - 1, *expected[4][1:])
    assert got == expected


def test_runs_are_powers():
    for symbol in "suaxSUAXd":
        slow = power(symbol, 0)
        for length in range(2, 40):
            slow = then(slow, power(symbol, 0))
            assert matrix_of(symbol * length) == slow
    pick = random.Random(1)
    for _ in range(200):
        symbols = "".join(pick.choice("suaxSUAXd") * pick.randint(1, 9) for _ in range(pick.randint(1, 6)))
        edits, state = unroll(symbols, END, 0, True)
        assert state in (0, 3) and len(edits) == len(symbols)
        cost = sum({"D": 2, "I": 5, "K": 0, "R": 1}[x] + 5 * (x in "KR" and s.isupper()) for s, e in zip(symbols, edits, strict=True) for x in e[::2])
        assert cost == before(matrix_of(symbols), END)[0]


def damage(rows):
    out = []
    for conv, turn, role, text in rows:
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        role, text = " " if role is None else role, " " if text is None else text
        text = {1: "", 2: re.sub("[.!?]", "", text)}.get(code, text)
        out += [(conv, turn, "user" if code == 4 else role, text)] * {0: 0, 3: 2}.get(code, 1)
    return out


def test_damage(spark):
    rows = made_up(7, 200)
    got = sorted((tuple(r) for r in damaged(frame(spark, rows)).collect()), key=str)
    assert got == sorted(damage(rows), key=str)


def test_query_over_a_table(spark, tmp_path):
    rows = made_up(8, 150) + [(7000 + k, k, "user", "gone.") for k in range(40)]
    folder = write_tables(spark, tmp_path, conversations=([(*r, "c", 1, "s") for r in rows], SCHEMA))
    expected = {conv: (0, 0, 0, 0, 0, 0, "", sha256().hexdigest()) for conv in groups(rows)}
    assert len(expected) > len(groups(damage(rows)))  # some conversations lose all rows
    expected |= {conv: brute(g) for conv, g in groups(damage(rows)).items()}
    got = op13_conversations(spark, folder).collect()
    assert {r.conv_id: tuple(r)[1:] for r in got} == expected and len(got) == len(expected)


def test_no_rows_and_very_long_texts(spark):
    assert repair(frame(spark, [])).collect() == []
    rows = [(1, 0, "user", "q " * 1_500_000 + "?"), (1, 1, "assistant", "é" * 2_000_000)]
    assert found(repair(frame(spark, rows))) == {1: brute([r[1:] for r in rows])}
