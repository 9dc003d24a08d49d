"""Repaired conversations against enumeration of all edits."""

import hashlib
import itertools
import random
import re
import zlib

import pytest
from pyspark.sql import functions as F

from tessella.llm import repair

SCHEMA = "conv_id long, turn long, role string, text string, audit string"
WHITE = " \t\n\x0b\f\r"


def damaged_by_hand(rows):
    out = []
    for conv, turn, role, text, *_ in rows:
        role, text = (" " if x is None else x for x in (role, text))
        code = zlib.crc32(f"{' ' if conv is None else conv}:{' ' if turn is None else turn}".encode()) % 20
        text = "" if code == 1 else re.sub("[.!?]", "", text) if code == 2 else text
        out += [(conv, turn, "user" if code == 4 else role, text)] * {0: 0, 3: 2}.get(code, 1)
    return out


def repaired_by_hand(rows):
    """All edits are tried, with at most two inserted rows in each gap."""
    rows = sorted(rows, key=lambda r: (r[1] is not None, r[1] or 0, r[2], r[3]))
    faults, seen = [], set()
    for _, _, role, text in rows:
        bare = text.rstrip(WHITE)
        faults.append("b" if not bare else "d" if (role, text) in seen else "t" if bare[-1] not in ".!?" else "")
        seen.add((role, text))
    best = None
    for edits in itertools.product(*[("D",) if f in ("b", "d") else ("K", "R", "D") for f in faults]):
        for gaps in itertools.product(("", "I", "II"), repeat=len(rows) + 1):
            audit = gaps[0] + "".join(e + g for e, g in zip(edits, gaps[1:], strict=True))
            cost = sum({"K": 0, "R": 3, "D": 4, "I": 3}[e] for e in audit) + 3 * sum(e != "D" and f == "t" for e, f in zip(edits, faults, strict=True))
            if best is not None and (cost, audit) >= best[:2]:
                continue
            kept, left = [], iter(rows)
            for e in audit:
                r = next(left) if e != "I" else None
                if e == "K":
                    kept.append((r[2], r[3]))
                elif e != "D":
                    kept.append((None, r[3] if r else ""))
            for start in ("s", "") if kept else ("",):
                want = (start + "ua" * len(kept))[: len(kept)]
                if want[-1:] in ("u", "s") or any(role is not None and role[:1] != w or role is None and w == "s" for (role, _), w in zip(kept, want, strict=True)):
                    continue
                full = {"u": "user", "a": "assistant"}
                best = (cost, audit, "\n".join(f"{full[w] if role is None else role}:{text}" for (role, text), w in zip(kept, want, strict=True)))
    turns = [r[1] for r in rows if r[1] is not None]
    pairs = [a[2][:1] + b[2][:1] for a, b in zip(rows, rows[1:], strict=False)]
    counts = tuple(faults.count(f) for f in "bdt")
    return (max(turns) - min(turns) + 1 - len(set(turns)) if turns else 0, *counts, sum(p not in ("su", "ua", "au") for p in pairs), best[0], best[1], hashlib.sha256(best[2].encode()).hexdigest())


def conversations(seed, n):
    r = random.Random(seed)
    rows = []
    for c in range(n):
        for t in range(r.randint(1, 4)):
            turn = None if r.random() < 0.05 else t - 1 + (r.random() < 0.2)
            role = r.choice(["user", "user", "assistant", "assistant", "system", "tool", "", None])
            rows.append((c if c else None, turn, role, r.choice(["Yes.", "No", "", " \t", None, "What? é", "Yes.", "end!\n"]), "x"))
    return rows


def found(df):
    return {r.conv_id: (r.gaps, r.blank, r.duplicate, r.truncated, r.illegal, r.cost, r.audit, r.repaired_sha256) for r in df.collect()}


@pytest.mark.parametrize("rows_a_block", [256, 1, 2])
def test_cheapest_edits_equal_enumeration(spark, rows_a_block):
    rows = conversations(rows_a_block, 60)
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    given = damaged_by_hand(rows)
    assert found(repair.repair_conversations(repair.damaged(df), block_rows=rows_a_block)) == {c: repaired_by_hand([r for r in given if r[0] == c]) for c in {r[0] for r in rows}}


def test_long_conversations_are_split_and_repeats_are_counted(spark):
    r = random.Random(8)
    rows = [(5, t, r.choice(["user", "assistant"]), f"line {r.randrange(400)}" + r.choice(".x"), None) for t in range(900)] + [(5, 7, "user", "same.", None)] * 700
    got = found(repair.repair_conversations(spark.createDataFrame(rows, SCHEMA)))[5]
    ordered = sorted(rows, key=lambda x: (x[1], x[2], x[3]))
    seen, spans = set(), []
    for x in ordered:
        spans.append((x[2][:1], "d" if x[2:4] in seen else "t" if x[3][-1] == "x" else ""))
        seen.add(x[2:4])
    ways = {0: (0, "")}
    for s in spans:
        cell = repair.edited(*s)
        ways = {q: min((w[0] + cell[p][q][0], w[1] + cell[p][q][1]) for p, w in ways.items() if cell[p][q]) for q in range(4) if any(cell[p][q] for p in ways)}
    cost, audit = min(w for q, w in ways.items() if q in (0, 3))
    text = "\n".join(f"{a}:{b}" for a, b in repair.apply_edits(audit, 0, [x[2:4] for x in ordered]))
    assert got[5:] == (cost, audit, hashlib.sha256(text.encode()).hexdigest())
    assert got[0] == 0 and got[2] == sum(f == "d" for _, f in spans)


def test_one_split_of_a_span_is_enough():
    r = random.Random(2)
    for _ in range(60):
        rows = [(r.choice("suax"), r.choice(["", "", "t", "b"])) for _ in range(r.randint(1, 7))]
        chart = {(i, i + 1): repair.edited(a if a in "sua" else "", f) for i, (a, f) in enumerate(rows)}
        for n in range(2, len(rows) + 1):
            for i in range(len(rows) - n + 1):
                every = [repair.combine(chart[i, k], chart[k, i + n]) for k in range(i + 1, i + n)]
                assert all(c == every[0] for c in every)
                chart[i, i + n] = every[0]
        assert repair.parse(rows) == chart[0, len(rows)]


def test_dropped_rows_other_types_and_no_rows(spark):
    names = spark.createDataFrame([("a", 1, "user", "Hi.", 0), (None, 1, None, None, 2), ("b", None, "system", "x.", 1), ("b", None, "system", "x.", 1)], "conv_id string, turn int, role string, text string, copies int")
    got = found(repair.repair_conversations(names))
    none = hashlib.sha256(b"").hexdigest()
    assert got == {"a": (0, 0, 0, 0, 0, 0, "", none), None: (0, 2, 0, 0, 1, 8, "DD", none), "b": (0, 0, 1, 0, 1, 8, "DD", none)}
    assert repair.repair_conversations(names.limit(0)).count() == 0
    assert repair.damaged(spark.createDataFrame([(1, 2, "a", "b", "c")], SCHEMA)).columns == ["conv_id", "turn", "role", "text", "copies"]
    assert repair.repair_conversations(spark.createDataFrame([(1, 2, "user", "b.", "c")], SCHEMA).withColumn("fault", F.lit(1))).first().audit == "KI"
