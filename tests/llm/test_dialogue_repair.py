"""Conversation repair against a memoised search over whole edit strings."""

from __future__ import annotations

import hashlib
import random
import zlib
from functools import lru_cache

import pytest

from millrace.llm import dialogue_repair
from millrace.llm.dialogue_repair import damaged, repair, repaired_turns, report

SCHEMA = "conv_id long, turn long, role string, text string"


def brute(rows: list[tuple]) -> dict:
    """The report of one conversation's rows (turn, role, text)."""
    rows = sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
    faults, seen = [], set()
    for _, role, text in rows:
        bare = text.strip(" \t\n\v\f\r")
        faults.append("blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    after = {("", "s"): "s", ("", "u"): "u", ("s", "u"): "u", ("u", "a"): "a", ("a", "u"): "u"}
    other = {"": "u", "s": "u", "u": "a", "a": "u"}

    @lru_cache(None)
    def best(i: int, state: str, inserts: int) -> tuple[int, str]:
        found = []
        if inserts < 3:
            cost, edits = best(i, other[state], inserts + 1)
            found.append((cost + 3, "I" + edits))
        if i == len(rows):
            if state in ("", "a"):
                found.append((0, ""))
        else:
            cost, edits = best(i + 1, state, 0)
            found.append((cost + 4, "D" + edits))
            if faults[i] in ("", "truncated"):
                cut = 3 if faults[i] else 0
                cost, edits = best(i + 1, other[state], 0)
                found.append((cost + 3 + cut, "R" + edits))
                to = after.get((state, rows[i][1][:1]))
                if to:
                    cost, edits = best(i + 1, to, 0)
                    found.append((cost + cut, "K" + edits))
        return min(found) if found else (1 << 40, "")

    for i in range(len(rows), -1, -1):  # no deep recursion
        for state in other:
            best(i, state, 0)
    cost, edits = best(0, "", 0)
    state, i, lines = "", 0, []
    for e in edits:
        if e == "I":
            state = other[state]
            lines.append({"u": "user", "a": "assistant"}[state] + ":")
            continue
        _, role, text = rows[i]
        i += 1
        if e != "D":
            state = role[0] if e == "K" else other[state]
            lines.append((role if e == "K" else {"u": "user", "a": "assistant"}[state]) + ":" + text)
    turns = [t for t, _, _ in rows if t is not None]
    pairs = [a[1][:1] + b[1][:1] for a, b in zip(rows, rows[1:])]
    return {
        "gaps": max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0,
        "illegal": sum(p not in ("su", "ua", "au") for p in pairs),
        "cost": cost, "audit": edits, "repaired_sha256": hashlib.sha256("\n".join(lines).encode()).hexdigest(),
        **{f: faults.count(f) for f in ("blank", "duplicate", "truncated")},
    }


def hit(rows: list[tuple]) -> list[tuple]:
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        fate = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if fate == 0:
            continue
        text = "" if fate == 1 else "".join(c for c in text if c not in ".!?") if fate == 2 else text
        out += [(conv, turn, "user" if fate == 4 else role, text)] * (2 if fate == 3 else 1)
    return out


def random_rows(seed: int, convs: int, longest: int) -> list[tuple]:
    rng = random.Random(seed)
    rows = []
    for conv in [*range(convs), None]:
        for turn in range(rng.randrange(longest)):
            role = rng.choice(["user", "assistant", "user", "assistant", "system", "tool", "", "User", None])
            text = rng.choice(["Yes.", "No!", "why?", "cut off", " \t\n", "", None, f"own {turn}.", f"own {turn}", "é…?\x0b "])
            rows.append((conv, rng.choice([turn, turn, turn, turn // 2, None, turn + 5]), role, text))
    return rows + rows[:20]


@pytest.mark.parametrize("short", [1, 3, 64])
def test_every_column_equals_brute_force(spark, monkeypatch, short):
    monkeypatch.setattr(dialogue_repair, "SHORT", short)
    rows = random_rows(short, 60, 14)
    table = spark.createDataFrame([(*r, "own") for r in rows], SCHEMA + ", piece string")
    got = {r.conv_id: r.asDict() for r in report(repair(damaged(table)), table).collect()}
    assert got.keys() == {r[0] for r in rows}
    after = hit(rows)
    for conv, found in got.items():
        assert found == {"conv_id": conv, **brute([r[1:] for r in after if r[0] == conv])}, conv


def test_one_long_conversation_in_many_pieces(spark, monkeypatch):
    monkeypatch.setattr(dialogue_repair, "SHORT", 8)
    rng = random.Random(5)
    rows = [(7, t, rng.choice(["user", "assistant"]), rng.choice(["fine.", f"own {t}.", "", f"cut {t}"])) for t in range(1_500)]
    rows.append((8, 0, "user", "word " * 100_000 + "end."))
    table = spark.createDataFrame(rows, SCHEMA)
    pieces = repair(table)
    assert pieces.filter("conv_id = 7").count() >= 1_500 // 39
    got = {r.conv_id: r.asDict() for r in report(pieces, table).collect()}
    assert got[7] == {"conv_id": 7, **brute([r[1:] for r in rows if r[0] == 7])}
    assert (got[8]["audit"], got[8]["cost"]) == ("KI", 3)
    told = repaired_turns(pieces).filter("conv_id = 7").orderBy("piece", "at").collect()
    assert hashlib.sha256("\n".join(f"{r.role}:{r.text}" for r in told).encode()).hexdigest() == got[7]["repaired_sha256"]


def test_empty_tables_and_conversations_without_rows(spark):
    empty = spark.createDataFrame([], SCHEMA)
    assert report(repair(damaged(empty)), empty).count() == 0
    gone = next(i for i in range(1000) if zlib.crc32(f"{i}:0".encode()) % 20 == 0)
    table = spark.createDataFrame([(gone, 0, "user", "Hello.")], SCHEMA)
    row = report(repair(damaged(table)), table).first()
    assert row.asDict() == {
        "conv_id": gone, "gaps": 0, "blank": 0, "duplicate": 0, "truncated": 0, "illegal": 0, "cost": 0, "audit": "",
        "repaired_sha256": hashlib.sha256(b"").hexdigest(),
    }
    named = spark.createDataFrame([("a", 1, "assistant", "x.")], "conv_id string, turn int, role string, text string")
    assert report(repair(named), named).first().audit == "IK"
