"""Operator 11: the search against a plain sweep over the lattice, repairs of long conversations in segments, odd tables."""

import hashlib
import random
import re
import zlib

import pytest

from sparksift.llm import conversations as conv

SCHEMA = "conv_id bigint, turn bigint, role string, text string, conv string, pos string, size string, n string, letter string"


def plain(letters):
    """Cost and least audit by a sweep that carries the best of each state over the rows."""
    best = {0: (0, "")}

    def put(to, state, cost, audit):
        if state not in to or (cost, audit) < to[state]:
            to[state] = (cost, audit)

    def inserted(at):
        for _ in range(3):
            for a, (c, x) in list(at.items()):
                put(at, 3 if a == 2 else 2, c + 3, x + "I")
        return at

    best = inserted(best)
    for x in letters:
        new = {}
        for a, (c, audit) in best.items():
            put(new, a, c + 4, audit + "D")
            if x in "suaxSUAX":
                t = 3 if x.isupper() else 0
                put(new, 3 if a == 2 else 2, c + 3 + t, audit + "R")
                to = {"s": 1 if a == 0 else None, "u": 2 if a != 2 else None, "a": 3 if a == 2 else None}.get(x.lower())
                if to:
                    put(new, to, c + t, audit + "K")
        best = inserted(new)
    return min(best[a] for a in (0, 3) if a in best)


def split_search(letters, size, fan):
    tables = [[conv.step(x) for x in letters[k : k + size]] for k in range(0, len(letters), size)]
    found = [conv.spanned(t, True, len(tables) == 1) for t in tables]
    while len(found) > 1:
        groups = [found[k : k + fan] for k in range(0, len(found), fan)]
        found = [conv.spanned([conv._steps(*conv._flat(f)) for f in g], False, len(groups) == 1) for g in groups]
    (out,) = found[0].values()
    return out


@pytest.mark.parametrize("seed", range(300))
def test_search_equals_a_plain_sweep(seed):
    r = random.Random(seed)
    letters = "".join(r.choice(r.choice(("suaxSUAX0123", "uaua1", "xX3", "ua", "s0S"))) for _ in range(r.randrange(1, 26)))
    want = plain(letters)
    assert conv.cheapest([conv.step(x) for x in letters], True, conv.EMPTY, conv.ENDS) == want
    for size, fan in ((1, 2), (3, 2), (4, 3), (7, 32)):
        assert split_search(letters, size, fan) == want


def brute(rows):
    """The result of every conversation by sorting, sets and the plain sweep."""
    space = lambda v: " " if v is None else str(v)
    convs = {r[0]: [] for r in rows}
    for c, t, role, text in rows:
        kind = zlib.crc32(f"{space(c)}:{space(t)}".encode()) % 20
        role, text = space(role), space(text)
        if kind:
            text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
            convs[c] += [(t, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    out = []
    for c, held in convs.items():
        held.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, letters, faults = set(), "", []
        for t, role, text in held:
            bare = text.strip(" \t\n\v\f\r")
            fault = "blank" if not bare else "duplicate" if (role, text) in seen else "truncated" if bare[-1] not in ".!?" else None
            seen.add((role, text))
            i = "suax".find(role[:1]) if role[:1] in ("s", "u", "a") else 3
            letters += ("0123" if fault in ("blank", "duplicate") else "SUAX" if fault else "suax")[i]
            faults.append(fault)
        cost, audit = plain(letters) if letters else (0, "")
        turns = [t for t, _, _ in held if t is not None]
        lines, state, k = [], 0, 0
        for x in audit:
            given = "assistant" if state == 2 else "user"
            if x in "RI":
                lines.append(f"{given}:" + (held[k][2] if x == "R" else ""))
            elif x == "K":
                lines.append(f"{held[k][1]}:{held[k][2]}")
            if x != "D":
                state = {"s": 1, "u": 2, "a": 3}[lines[-1][0]]
            k += x != "I"
        pairs = [a[1][:1] + b[1][:1] for a, b in zip(held, held[1:])]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        out.append((c, gaps, *[faults.count(f) for f in ("blank", "duplicate", "truncated")], sum(p not in ("su", "ua", "au") for p in pairs), cost, audit, hashlib.sha256("\n".join(lines).encode()).hexdigest()))
    return sorted(map(repr, out))


def got(spark, path, rows, parts=3):
    spark.createDataFrame([(*r, *["x"] * 5) for r in rows], SCHEMA).repartition(parts).write.parquet(f"{path}/conversations.parquet")
    df = conv.op11_conversation_repair(spark, str(path))
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    return sorted(repr(tuple(r)) for r in df.collect())


def made(seed, n, convs):
    r = random.Random(seed)
    texts = ["Fine.", "Cut off", "", "  \n", "Why?\n ", "É à!", None, "again.", "x" * 5000 + "."]
    return [(r.choice(convs), r.choice((None, *range(40))), r.choice(("user", "assistant", "system", "tool", "", None, "User")), r.choice(texts) if r.random() < 0.7 else f"Text {k}.") for k in range(n)]


def test_odd_rows(spark, tmp_path):
    rows = made(1, 300, (1, 2, 3, None, 5, 6, 7, 8, 9, 10)) + [(50 + k, 0, "user", "Hi.") for k in range(40)] + [(1, 1, "user", "Same."), (1, 1, "user", "Same.")]
    assert got(spark, tmp_path, rows) == brute(rows)


def test_one_long_conversation_in_segments(spark, tmp_path, monkeypatch):
    monkeypatch.setattr(conv, "SEGMENT", 16)
    monkeypatch.setattr(conv, "FAN", 3)
    r = random.Random(3)
    rows = [(7, k, r.choice(("user", "assistant", "assistant", "user", "system")), f"Turn {k if r.random() < 0.9 else 0}" + r.choice((".", "", "!"))) for k in range(500)] + made(2, 60, (1, 2, 3))
    assert got(spark, tmp_path, rows, 7) == brute(rows)


def test_empty(spark, tmp_path):
    assert got(spark, tmp_path, []) == []


def test_repaired_rows_are_kept_as_rows(spark):
    rows = [(1, 1, "system", "Be kind."), (1, 2, "assistant", "Hello there."), (1, 3, "assistant", "Hello there.")]
    done = conv.repair(spark.createDataFrame(rows, "c int, t int, r string, x string"), "c", "t", "r", "x")
    assert [tuple(r) for r in done.rows.orderBy("n").collect()] == [(1, 0, "system", "Be kind."), (1, 1, "user", ""), (1, 2, "assistant", "Hello there.")]
    assert done.facts.first()["audit"] == "KIKD"
