"""Conversation repair against a plain version that edits whole conversations row by row."""

import hashlib
import random
import re
import zlib
from collections import defaultdict

import pytest
from pyspark.sql import functions as F

from tidemark.llm import queries, turn_repair

TURNS = "conv_id long, turn long, role string, text string"


def damaged(rows):
    out = []
    for conv, turn, role, text in rows:
        role, text = " " if role is None else role, " " if text is None else text
        kind = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        if kind == 0:
            continue
        text = "" if kind == 1 else re.sub("[.!?]", "", text) if kind == 2 else text
        out += [(conv, turn, "user" if kind == 4 else role, text)] * (2 if kind == 3 else 1)
    return out


def cheapest(marks):
    """Forward over all rows: state -> (cost, audit). marks: (initial, must go, truncated)."""

    def insert(states):
        out = dict(states)
        for _ in range(2):
            for s, (cost, audit) in list(out.items()):
                t, way = ("a" if s == "u" else "u"), (cost + 5, audit + "I")
                out[t] = min(out.get(t, way), way)
        return out

    states = {"": (0, "")}
    for initial, must_go, cut in marks:
        new = {}
        for s, (cost, audit) in insert(states).items():
            due = "a" if s == "u" else "u"
            ways = [(s, cost + 2, "D")]
            if not must_go:
                ways.append((due, cost + 1 + 5 * cut, "R"))
                if initial == due or (initial == "s" and s == ""):
                    ways.append((initial, cost + 5 * cut, "K"))
            for t, c, e in ways:
                new[t] = min(new.get(t, (c, audit + e)), (c, audit + e))
        states = new
    ends = insert(states)
    return min(ends[s] for s in ("", "a") if s in ends)


def plain(rows):
    """{conv_id: (gaps, blank, duplicate, truncated, illegal, cost, audit, hash)} of rows already damaged."""
    convs = defaultdict(list)
    for r in rows:
        convs[r[0]].append(r[1:])
    out = {}
    for conv, own in convs.items():
        own.sort(key=lambda r: (r[0] is not None, r[0] or 0, r[1].encode(), r[2].encode()))
        seen, marks, count = set(), [], [0, 0, 0]
        for _, role, text in own:
            solid = re.sub(r"[\x20\x09-\x0D]+", "", text)
            fault = 0 if not solid else 1 if (role, text) in seen else 2 if solid[-1] not in ".!?" else 3
            if fault < 3:
                count[fault] += 1
            seen.add((role, text))
            marks.append((role[:1], fault < 2, fault == 2))
        turns = [t for t, _, _ in own if t is not None]
        gaps = max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0
        illegal = sum(a[0] + b[0] not in ("su", "ua", "au") for a, b in zip(marks, marks[1:]))
        cost, audit = cheapest(marks)
        kept, at, last = [], 0, ""
        for e in audit:
            due = "assistant" if last[:1] == "u" else "user"
            if e == "I":
                kept.append((due, ""))
            elif e != "D":
                kept.append((own[at][1] if e == "K" else due, own[at][2]))
            at += e != "I"
            last = kept[-1][0] if kept else ""
        body = "\n".join(f"{r}:{t}" for r, t in kept)
        assert re.fullmatch("(s?(ua)+)?", "".join(r[0] for r, _ in kept))
        out[conv] = (gaps, *count, illegal, cost, audit, hashlib.sha256(body.encode()).hexdigest())
    return out


def made(seed, convs, most):
    r = random.Random(seed)
    rows = []
    for c in range(convs):
        for t in range(r.randint(1, most)):
            turn = None if r.random() < 0.03 else r.choice([t, t, t, t + 3, t // 2])
            role = r.choice(["user", "assistant", "user", "assistant", "system", "tool", "", None, "unknown"])
            text = r.choice(["Yes.", "Yes.", "why?", "No", "", " \n\x0b", None, f"Text {r.random()}!", "é… end. \n", "x" * 50])
            rows.append((c if c else None, turn, role, text))
    return rows + rows[:40]


def answers(df):
    return {r.conv_id: tuple(r)[1:] for r in df.collect()}


def test_query_over_the_whole_table(spark, small):
    turns = spark.read.parquet(f"{small}/conversations.parquet")
    rows = [tuple(r) for r in turns.select("conv_id", "turn", "role", "text").collect()]
    df = queries.op11_turn_repair(spark, small)
    assert df.columns == ["conv_id", "gaps", "blank", "duplicate", "truncated", "illegal", "cost", "audit", "repaired_sha256"]
    none = (0,) * 6 + ("", hashlib.sha256(b"").hexdigest())
    want = plain(damaged(rows))
    assert answers(df) == {c: want.get(c, none) for c in {r[0] for r in rows}}


@pytest.mark.parametrize("part", [64, 3])
def test_edges_and_conversations_of_many_parts(spark, part, monkeypatch):
    """Nulls in every column, other roles, ties, repeated rows, and conversations cut into parts that lie in several tasks."""
    rows = made(1, 60, 12) + [(900, t, ("user", "assistant")[t % 2], f"row {t}" + ".?"[t % 7 == 0]) for t in range(0, 700, 2)]
    rows += [(901, 1, "user", "again.")] * 150 + [(901, 2, "assistant", "cut off")]
    turns = spark.createDataFrame(rows, TURNS).withColumn("copies", F.lit("mine")).withColumn("part", F.lit("mine")).repartition(5)
    if part < 64:
        real = turn_repair._encode

        def short(batches):
            turn_repair.PART = part
            try:
                yield from real(batches)
            finally:
                turn_repair.PART = 64

        monkeypatch.setattr(turn_repair, "_encode", short)
    want, none = plain(damaged(rows)), (0,) * 6 + ("", hashlib.sha256(b"").hexdigest())
    given = turn_repair.damage(turns)
    got = answers(turn_repair.all_conversations(turn_repair.repair_report(given, copies="copies"), turns))
    assert got == {c: want.get(c, none) for c in {r[0] for r in rows}}
    left = defaultdict(list)
    for r in sorted(turn_repair.repaired_turns(given, copies="copies").collect(), key=lambda r: (r.part, r.nth)):
        left[r.conv_id].append(f"{r.role}:{r.text}")
    assert {c: hashlib.sha256("\n".join(left[c]).encode()).hexdigest() for c in want} == {c: w[-1] for c, w in want.items()}


def test_rows_without_damage_keep_their_copies(spark):
    rows = made(2, 20, 9)
    own = [(c, t, " " if r is None else r, " " if x is None else x) for c, t, r, x in rows]
    assert answers(turn_repair.repair_report(spark.createDataFrame(rows, TURNS).withColumn("copies", F.lit("mine")))) == plain(own)


def test_empty_table(spark):
    turns = spark.createDataFrame([], TURNS)
    assert turn_repair.all_conversations(turn_repair.repair_report(turn_repair.damage(turns), copies="copies"), turns).count() == 0
    assert turn_repair.repaired_turns(turns).count() == 0


def test_stretches_combine_like_the_whole():
    r = random.Random(5)
    for _ in range(300):
        whole = "".join(r.choice("suaoSUAOxx") for _ in range(r.randint(1, 14)))
        cut = r.randint(0, len(whole))
        pieces = [p for p in (whole[:cut], whole[cut:]) if p]
        steps = [turn_repair.solve(p) for p in pieces]
        folded = steps[0][:2]
        for s in steps[1:]:
            folded = turn_repair.joined(folded, s[:2])
        end = turn_repair.best_end(*folded)
        at = turn_repair.stations([s[:2] for s in steps], 0, end)
        audit = "".join(s[2][a * 4 + b] for s, a, b in zip(steps, at, at[1:])) + turn_repair.CLOSING[end]
        cost, want = cheapest([(c.lower(), c == "x", c.isupper()) for c in whole])
        assert (folded[0][end] + 5 * len(turn_repair.CLOSING[end]), audit) == (cost, want)
