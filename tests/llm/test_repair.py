"""Audits against an exhaustive search, whole conversations against a plain repair."""

import hashlib
import random
import re
from functools import cache

import pytest

from granero.llm import repair


@cache
def search(signs, state=0, inserted=0):
    """(cost, audit) of the cheapest edits by trying all of them; up to three insertions in a row."""
    needs = {0: "u", 1: "u", 2: "a", 3: "u"}[state]
    to = {"s": 1, "u": 2, "a": 3}
    found = [(0, "")] if not signs and state in (0, 3) else []
    if inserted < 3:
        found.append(plus(2, "I", search(signs, to[needs], inserted + 1)))
    if signs:
        sign, rest = signs[0], signs[1:]
        found.append(plus(3, "D", search(rest, state)))
        if sign != "x":
            short = int(sign.isupper())
            found.append(plus(2 + short, "R", search(rest, to[needs])))
            if sign.lower() == needs or (sign.lower() == "s" and state == 0):
                found.append(plus(short, "K", search(rest, to[sign.lower()])))
    return min(found, default=(10**9, ""))


def plus(cost, edit, rest):
    return cost + rest[0], edit + rest[1]


def test_audits_equal_an_exhaustive_search():
    random.seed(5)
    signatures = {"".join(random.choices("suaoxSUAO", k=random.randrange(9))) for _ in range(400)} | {"", "x", "ua" * 20, "usa" * 5}
    walk, turned = repair.Walk(), sorted(s[::-1] for s in signatures)
    assert [walk(t) for t in turned] == [search(t[::-1]) for t in turned]
    suffixes = {t[:n] for t in turned for n in range(1, len(t) + 1)}
    assert walk.made == len(suffixes)  # every suffix once, however many conversations share it
    assert len(walk.automaton.costs) < 60


def test_a_very_long_conversation():
    walk = repair.Walk()
    cost, audit = walk("auau" * 100_000)
    assert (cost, audit) == (0, "K" * 400_000)


def plain(rows):
    """conv_id -> (gaps, blank, duplicate, truncated, illegal, cost, audit, sha256) of (conv_id, turn, role, text)."""
    out = {}
    for conv in {r[0] for r in rows}:
        own = [(t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows if c == conv]
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), hashlib.sha256(r[2].encode()).digest()))
        seen, signs, faults = set(), "", [0, 0, 0]
        for _, role, text in own:
            solid = re.sub(r"[\x20\x09-\x0D]", "", text)
            initial = role[:1] if role[:1] in tuple("sua") else "o"
            fault = 0 if not solid else 1 if (role, text) in seen else 2 if solid[-1] not in ".!?" else 3
            seen.add((role, text))
            signs += "x" if fault < 2 else initial.upper() if fault == 2 else initial
            if fault < 3:
                faults[fault] += 1
        steps = [a[1][:1] + b[1][:1] for a, b in zip(own, own[1:])]  # noqa: B905
        turns = [t for t, *_ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        cost, audit = search(signs)
        lines, state, left = [], 0, list(own)
        for edit in audit:
            row = left.pop(0) if edit != "I" else ("", "", "")
            needs = "assistant" if state == 2 else "user"
            if edit == "D":
                continue
            role = row[1] if edit == "K" else needs
            state = 1 if role[0] == "s" else 2 if role[0] == "u" else 3
            lines.append(f"{role}:{row[2]}")
        told = hashlib.sha256("\n".join(lines).encode()).hexdigest()
        out[conv] = (gaps, *faults, sum(s not in ("su", "ua", "au") for s in steps), cost, audit, told)
    return out


@pytest.fixture(scope="module")
def rows():
    random.seed(7)
    data = [
        (c, t, random.choice(["user", "user", "assistant", "assistant", "system", "tool", "", None]), random.choice(["a.", "b", "", "\t \n", "ok! ", "é?", None, f"{c} {t}."]))
        for c in range(60)
        for t in range(random.randrange(1, 8))
    ]
    data += [(None, None, "user", "hi."), (None, 3, "assistant", "yo."), (70, None, "user", "same."), (70, None, "user", "same."), (70, 5, "user", "same.")]
    data += [(71, 2, "user", "b."), (71, 2, "assistant", "a."), (72, -(2**63), "user", "x" * 200_000 + "."), (72, 2**63 - 1, "assistant", "y.")]
    data += [(73, 1, "user", "Only this \x0b"), (74, 1, "system", "s."), (75, 9, "User", "u."), (70, 5, "user", "same.")]
    return data


@pytest.fixture(scope="module")
def frame(spark, rows):
    schema = "conv_id long, turn long, role string, text string, key int, sign int, audit int, first int"
    return spark.createDataFrame([(*r, 1, 2, 3, 4) for r in rows], schema)


def test_repair_equals_a_plain_one(frame, rows):
    got = {
        r["conv_id"]: (*[r[c] for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256")],)
        for r in repair.repair(frame).collect()
    }
    expected = plain(rows)
    expected[72] = (None, *expected[72][1:])  # a gap beyond 64 bits
    assert got == expected


def test_repaired_rows_are_well_formed_and_give_the_digest(frame):
    found = repair.repair(frame)
    told = {r["conv_id"]: r for r in found.collect()}
    texts = {}
    for r in sorted(repair.repaired(frame, found).collect(), key=lambda r: (str(r["conv_id"]), r["place"])):
        texts.setdefault(r["conv_id"], []).append((r["role"], r["text"]))
    for conv, row in told.items():
        lines = texts.get(conv, [])
        assert re.fullmatch("(s?(ua)+)?", "".join(role[:1] for role, _ in lines))
        assert hashlib.sha256("\n".join(f"{a}:{b}" for a, b in lines).encode()).hexdigest() == row["repaired_sha256"]


def test_empty_table(frame):
    assert repair.repair(repair.damaged(frame.limit(0))).collect() == []


def test_damage_follows_the_hash(spark):
    rows = spark.createDataFrame([(c, t, "assistant", "A. b! c?") for c in range(40) for t in (None, 1)], "conv_id long, turn long, role string, text string")
    import zlib

    expected = []
    for c in range(40):
        for t in (None, 1):
            kind = zlib.crc32(f"{c}:{' ' if t is None else t}".encode()) % 20
            row = (c, t, "user" if kind == 4 else "assistant", {1: "", 2: "A b c"}.get(kind, "A. b! c?"))
            expected += [row] * {0: 0, 3: 2}.get(kind, 1)
    assert sorted(map(str, map(tuple, repair.damaged(rows).collect()))) == sorted(map(str, expected))
