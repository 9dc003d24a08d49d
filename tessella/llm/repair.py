"""Repair of conversations by weighted CYK parsing over spans of turns."""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from functools import cache

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# --- grammar -----------------------------------------------------------------
#
# A repaired conversation's role initials are (s?(ua)+)?. What may follow depends on one of four
# facts: nothing yet (0), s (1), u (2) or a (3) was last. The nonterminal N[p, q] stands for a span
# whose edits lead from p to q; the rules are N[p, q] -> N[p, r] N[r, q], N[p, q] -> one edited row,
# and N[p, q] -> inserted rows. Conversations are N[0, 0] (empty) and N[0, 3].

STATES = range(4)
ENDS = (0, 3)
AFTER_USER = {0: 2, 1: 2, 3: 2}  # where a user's row may stand
AFTER_ASSISTANT = {2: 3}
AFTER = AFTER_USER | AFTER_ASSISTANT
KEEPS = {"s": {0: 1}, "u": AFTER_USER, "a": AFTER_ASSISTANT}
REROLE, DELETE, INSERT, TRUNCATED = 3, 4, 3, 3

#: The cheapest (cost, audit) of each N[p, q], or None.
Cell = tuple[tuple[tuple[int, str] | None, ...], ...]

BLOCK_ROWS = 256  # of turns that make a block, and of rows at which a block ends
_BYTES = 1 << 22  # of text at which a block ends


def _cell(found: dict[tuple[int, int], list[tuple[int, str]]]) -> Cell:
    return tuple(tuple(min(found[p, q]) if found.get((p, q)) else None for q in STATES) for p in STATES)


def combine(x: Cell, y: Cell) -> Cell:
    """The cell of two adjacent spans.

    For one N[p, q] and cost no audit of a span is a prefix of another, since what would follow are
    inserted rows at a cost; so the least audit of the whole has the least audits of its parts.
    """
    out = []
    for p in STATES:
        row = []
        for q in STATES:
            best = None
            for r in STATES:
                a, b = x[p][r], y[r][q]
                if a is not None and b is not None and (best is None or a[0] + b[0] <= best[0]):
                    new = (a[0] + b[0], a[1] + b[1])
                    best = new if best is None else min(best, new)
            row.append(best)
        out.append(tuple(row))
    return tuple(out)


@cache
def inserted() -> Cell:
    """The insertion closure: the fewest inserted rows between two states, none between equal ones."""
    found: dict = {}
    for p in STATES:
        q, audit = p, ""
        while (p, q) not in found:
            found[p, q] = [(INSERT * len(audit), audit)]
            q, audit = AFTER[q], audit + "I"
    return _cell(found)


@cache
def edited(initial: str, fault: str) -> Cell:
    """The cell of one row, closed under insertions on both sides. ``fault`` is b, d, t or empty."""
    found: dict = {(p, p): [(DELETE, "D")] for p in STATES}
    if fault not in ("b", "d"):
        more = TRUNCATED * (fault == "t")
        for p, q in KEEPS.get(initial, {}).items():
            found.setdefault((p, q), []).append((more, "K"))
        for p, q in AFTER.items():
            found.setdefault((p, q), []).append((more + REROLE, "R"))
    return combine(combine(inserted(), _cell(found)), inserted())


def parse(rows: list[tuple[str, str]]) -> Cell:
    """The cell of a span of rows ``initial, fault``, combined bottom-up by span length.

    Every split of a span derives the same edits, as nonterminals are pairs of states and rules join
    any two that meet; so of all spans only those of a balanced binary tree are needed, n - 1
    combinations for n rows instead of a number that grows with n ** 3.
    """
    spans = [edited(i if i in KEEPS else "", f) for i, f in rows]
    while len(spans) > 1:
        spans = [combine(*spans[k : k + 2]) if k + 1 < len(spans) else spans[k] for k in range(0, len(spans), 2)]
    return spans[0] if spans else inserted()


def apply_edits(audit: str, state: int, rows: list[tuple[str, str]]) -> Iterator[tuple[str, str]]:
    """The ``role, text`` that the edits leave of some rows, from a state on."""
    left = iter(rows)
    for edit in audit:
        role, text = ("", "") if edit == "I" else next(left)
        if edit == "D":
            continue
        if edit != "K":
            role = "assistant" if state == 2 else "user"
        state = KEEPS[role[0]][state]
        yield role, text


# --- in tasks ------------------------------------------------------------------

_BLOCK = pa.schema(
    [("conv", pa.string()), ("has", pa.bool_()), ("turn", pa.int64()), ("part", pa.int32()), ("last_turn", pa.int64()), ("turns", pa.int64()), ("rows", pa.int64())]
    + [(c, pa.int64()) for c in ("blank", "duplicate", "truncated", "illegal")]
    + [("initials", pa.list_(pa.string())), ("cell", pa.string()), ("raw", pa.binary()), ("size", pa.int64())]
)
_BLOCK_DDL = "conv string, has boolean, turn long, part int, last_turn long, turns long, rows long, blank long, duplicate long, truncated long, illegal long, initials array<string>, cell string, raw binary, size long"


def illegal(pair: str) -> bool:
    return pair not in ("su", "ua", "au")


def _block(conv: str, part: int, rows: list[tuple]) -> dict:
    """One row for some adjacent rows ``turn, role, text, fault`` of a conversation."""
    turns = [r[0] for r in rows if r[0] is not None]
    initials = [r[1][:1] for r in rows]
    raw = json.dumps([[r[1], r[2]] for r in rows]).encode()
    count = {f: sum(r[3] == f for r in rows) for f in "bdt"}
    return {
        "conv": conv, "has": rows[0][0] is not None, "turn": rows[0][0], "part": part, "last_turn": rows[-1][0], "turns": len(set(turns)), "rows": len(rows),
        "blank": count["b"], "duplicate": count["d"], "truncated": count["t"], "illegal": sum(illegal(a + b) for a, b in zip(initials, initials[1:], strict=False)),
        "initials": [initials[0], initials[-1]], "cell": json.dumps(parse([(r[1][:1], r[3]) for r in rows])), "raw": pa.compress(raw, "zstd", asbytes=True), "size": len(raw),
    }


def _blocks(most: int):
    """Of rows ``conv, turn, role, text, fault, first, copies`` in order the blocks; a block ends with
    its range of turns, or after so many rows or bytes. Copies beyond a first row are duplicates."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple] = []
        key, part, size = None, 0, 0

        def one() -> pa.RecordBatch:
            return pa.RecordBatch.from_pylist([_block(key[0], part, held)], schema=_BLOCK)

        for batch in batches:
            for r in batch.to_pylist():
                now = (r["conv"], None if r["turn"] is None else r["turn"] // most)
                for copy in range(max(1, r["copies"])):
                    if held and (now != key or len(held) >= most or size >= _BYTES):
                        yield one()
                        part, held, size = part + 1 if now == key else 0, [], 0
                    elif now != key:
                        part = 0
                    key = now
                    if not r["copies"]:  # a dropped row: its conversation is known by an empty block
                        yield pa.RecordBatch.from_pylist([{"conv": r["conv"], "has": False, "part": -1, "rows": 0}], schema=_BLOCK)
                        continue
                    fault = r["fault"] if r["fault"] == "b" or (r["first"] and not copy) else "d"
                    held.append((r["turn"], r["role"], r["text"], fault))
                    size += len(r["text"]) + len(r["role"])
        if held:
            yield one()

    return run


_OUT = pa.schema([("conv", pa.string())] + [(c, pa.int64()) for c in ("gaps", "blank", "duplicate", "truncated", "illegal", "cost")] + [("audit", pa.string()), ("repaired_sha256", pa.string())])
_OUT_DDL = "conv string, gaps long, blank long, duplicate long, truncated long, illegal long, cost long, audit string, repaired_sha256 string"


class _Conversation:
    """Blocks of one conversation, taken in turn. For each state that the edits so far may lead to: the
    cheapest way there, and the digest of what it leaves. The last block waits for the next, since at
    the end only one way is left to be written out."""

    def __init__(self, conv: str):
        self.conv, self.ways, self.waits = conv, {0: (0, "", hashlib.sha256(), True)}, None
        self.least, self.last, self.turns, self.count, self.initial = None, None, 0, dict.fromkeys(("blank", "duplicate", "truncated", "illegal"), 0), None

    def add(self, b: dict) -> None:
        if not b["rows"]:
            return
        for c in self.count:
            self.count[c] += b[c]
        if self.initial is not None:
            self.count["illegal"] += illegal(self.initial + b["initials"][0])
        self.initial = b["initials"][1]
        if b["turns"]:
            first = b["turn"] if b["has"] else None
            self.turns += b["turns"] - (first == self.last and first is not None)
            self.least = first if self.least is None else self.least
            self.last = b["last_turn"]
        if self.waits:
            self.ways = {q: self._written(w) for q, w in self._reached().items()}
        self.waits = b

    def _reached(self) -> dict[int, tuple]:
        """For each state the cheapest ``cost, audit, state before, audit of this block``."""
        cell, out = json.loads(self.waits["cell"]), {}
        for p, (cost, audit, *_) in self.ways.items():
            for q in STATES:
                if cell[p][q] is not None:
                    new = (cost + cell[p][q][0], audit + cell[p][q][1], p, cell[p][q][1])
                    out[q] = min(out.get(q, new), new)
        return out

    def _written(self, way: tuple) -> tuple:
        cost, audit, p, own = way
        digest, none = self.ways[p][2].copy(), self.ways[p][3]
        rows = json.loads(pa.decompress(self.waits["raw"], self.waits["size"], "zstd", asbytes=True))
        for role, text in apply_edits(own, p, rows):
            digest.update((("" if none else "\n") + f"{role}:{text}").encode())
            none = False
        return cost, audit, digest, none

    def row(self) -> dict:
        if self.waits:
            best = min(w for q, w in self._reached().items() if q in ENDS)
        cost, audit, digest, _ = self._written(best) if self.waits else self.ways[0]
        gaps = self.last - self.least + 1 - self.turns if self.turns else 0
        return {"conv": self.conv, "gaps": gaps, **self.count, "cost": cost, "audit": audit, "repaired_sha256": digest.hexdigest()}


def _conversations(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    now = None
    for batch in batches:
        done = []
        for b in batch.to_pylist():
            if now is None or now.conv != b["conv"]:
                if now is not None:
                    done.append(now.row())
                now = _Conversation(b["conv"])
            now.add(b)
        if done:
            yield pa.RecordBatch.from_pylist(done, schema=_OUT)
    if now is not None:
        yield pa.RecordBatch.from_pylist([now.row()], schema=_OUT)


# --- on Spark --------------------------------------------------------------------


def fault_of(text: Column) -> Column:
    """b: no character but white space; t: the last such character ends no sentence; else empty."""
    bare = F.rtrim(text, F.lit(" \t\n\x0b\f\r"))
    return F.when(bare == "", "b").when(F.right(bare, F.lit(1)).isin(".", "!", "?"), "").otherwise("t")


def damaged(rows: DataFrame) -> DataFrame:
    """``rows`` with ``copies``, 0 where a row is dropped and 2 where it is repeated, and other texts
    and roles, by the checksum of ``conv_id:turn`` modulo 20; null texts and roles are one space."""
    space = F.lit(" ")
    name = F.concat(F.coalesce(F.col("conv_id").cast("string"), space), F.lit(":"), F.coalesce(F.col("turn").cast("string"), space))
    code = F.crc32(name.cast("binary")) % 20
    text, role = F.coalesce("text", space), F.coalesce("role", space)
    return rows.select(
        "conv_id",
        F.col("turn").cast("long").alias("turn"),
        F.when(code == 4, "user").otherwise(role).alias("role"),
        F.when(code == 1, "").when(code == 2, F.regexp_replace(text, "[.!?]", "")).otherwise(text).alias("text"),
        F.when(code == 0, 0).when(code == 3, 2).otherwise(1).cast("long").alias("copies"),
    )


def repair_conversations(rows: DataFrame, *, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``conv_id, gaps, blank, duplicate, truncated, illegal, cost, audit, repaired_sha256``: one row
    for each conversation of ``conv_id, turn, role, text`` and optional ``copies`` (how often a row
    occurs, 0 for not at all).

    Rows stand by turn (nulls first), those of one turn by role and text. Null roles and texts count
    as one space; an empty role has no initial and can't be kept. A null ``conv_id`` is a conversation
    too. Equal rows are one row with a count from the first shuffle on. A conversation without rows
    has zeros, an empty audit and the digest of the empty string. Other columns are not read; no rows
    give no rows.

    Rows of one conversation are parsed in blocks of ``block_rows`` turns by different tasks, so a long one is split;
    its blocks then meet in order, one at a time in memory, as a digest of the whole takes them. What
    grows with a conversation is its audit alone, of which four are kept, as one is in the result.
    """
    spark = rows.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    given = rows.select("conv_id", F.col("turn").cast("long").alias("turn"), F.coalesce("role", F.lit(" ")).alias("role"), F.coalesce("text", F.lit(" ")).alias("text"), (F.col("copies") if "copies" in rows.columns else F.lit(1)).cast("long").alias("copies"))
    named = given.withColumn("conv", F.to_json(F.struct("conv_id"))).drop("conv_id")
    single = named.groupBy("conv", "turn", "role", "text").agg(F.sum("copies").alias("copies")).withColumn("key", F.md5(F.col("text").cast("binary")))
    order = F.struct(F.col("turn").isNotNull().alias("has"), "turn")
    firsts = single.where("copies > 0").groupBy("conv", "role", "key").agg(F.min(order).alias("at"))
    placed = single.join(firsts, ["conv", "role", "key"], "left").withColumn("first", order.eqNullSafe(F.col("at")))
    faulty = placed.select("conv", "turn", "role", "text", fault_of(F.col("text")).alias("fault"), "first", "copies")
    block = F.floor(F.col("turn") / F.lit(block_rows))
    sorted_rows = faulty.repartition(parts, "conv", block).sortWithinPartitions("conv", F.asc_nulls_first("turn"), "role", "text")
    blocks = sorted_rows.mapInArrow(_blocks(block_rows), _BLOCK_DDL)
    in_order = blocks.repartition(parts, "conv").sortWithinPartitions("conv", "has", F.asc_nulls_first("turn"), "part")
    found = in_order.mapInArrow(_conversations, _OUT_DDL)
    kind = T.StructType([T.StructField("conv_id", rows.schema["conv_id"].dataType)])
    return found.select(F.from_json("conv", kind)["conv_id"].alias("conv_id"), *[f.name for f in _OUT if f.name != "conv"])


def op11_repair(spark, sf_dir: str) -> DataFrame:
    return repair_conversations(damaged(spark.read.parquet(f"{sf_dir}/conversations.parquet")))


OP11_SQL = r"""
WITH RECURSIVE b AS (SELECT conv_id, turn, coalesce(role, ' ') AS role, coalesce(text, ' ') AS text, coalesce(conv_id::VARCHAR, ' ') || ':' || coalesce(turn::VARCHAR, ' ') AS name FROM conversations),
k AS (SELECT *, xor(list_reduce(list_concat([4294967295::BIGINT], flatten(list_transform(range(1, length(name) + 1), lambda i: [ascii(name[i])::BIGINT, 0, 0, 0, 0, 0, 0, 0]))),
  lambda c, x: xor(xor(c, x) >> 1, 3988292384::BIGINT * (xor(c, x) & 1))), 4294967295::BIGINT) % 20 AS code FROM b),
d AS (SELECT conv_id, turn, CASE WHEN code = 4 THEN 'user' ELSE role END AS role, CASE WHEN code = 1 THEN '' WHEN code = 2 THEN regexp_replace(text, '[.!?]', '', 'g') ELSE text END AS text,
  unnest(range(CASE WHEN code = 3 THEN 2 ELSE 1 END)) AS copy FROM k WHERE code <> 0),
r AS (SELECT *, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST, role, text, copy) AS i, row_number() OVER (PARTITION BY conv_id, role, text ORDER BY turn NULLS FIRST, copy) > 1 AS again,
  rtrim(text, e' \t\n\x0b\f\r') AS bare FROM d),
f AS (SELECT *, left(role, 1) AS ini, CASE WHEN bare = '' THEN 'b' WHEN again THEN 'd' WHEN right(bare, 1) NOT IN ('.', '!', '?') THEN 't' ELSE '' END AS fault,
  left(lag(role) OVER (PARTITION BY conv_id ORDER BY i), 1) AS before FROM r),
c AS (SELECT conv_id, CASE WHEN count(turn) = 0 THEN 0 ELSE max(turn) - min(turn) + 1 - count(DISTINCT turn) END AS gaps, count(*) FILTER (fault = 'b') AS blank, count(*) FILTER (fault = 'd') AS duplicate,
  count(*) FILTER (fault = 't') AS truncated, count(*) FILTER (before || ini NOT IN ('su', 'ua', 'au')) AS illegal, max(i) AS n FROM f GROUP BY conv_id),
ins(p, q, cost, audit, ins) AS (VALUES (0, 0, 0, '', []), (1, 1, 0, '', []), (2, 2, 0, '', []), (3, 3, 0, '', []), (0, 2, 3, 'I', ['user:']), (0, 3, 6, 'II', ['user:', 'assistant:']),
  (1, 2, 3, 'I', ['user:']), (1, 3, 6, 'II', ['user:', 'assistant:']), (2, 3, 3, 'I', ['assistant:']), (3, 2, 3, 'I', ['user:'])),
step(p, q, who) AS (VALUES (0, 1, 's'), (0, 2, 'u'), (1, 2, 'u'), (3, 2, 'u'), (2, 3, 'a')),
e AS (SELECT conv_id, i, p, q, 'K' AS edit, CASE fault WHEN 't' THEN 3 ELSE 0 END AS cost, [role || ':' || text] AS rest FROM f JOIN step ON who = ini WHERE fault IN ('', 't')
  UNION ALL SELECT conv_id, i, p, q, 'R', 3 + CASE fault WHEN 't' THEN 3 ELSE 0 END, [CASE who WHEN 'u' THEN 'user:' ELSE 'assistant:' END || text] FROM f JOIN step ON who <> 's' WHERE fault IN ('', 't')
  UNION ALL SELECT conv_id, i, s.s, s.s, 'D', 4, [] FROM f, (SELECT unnest([0, 1, 2, 3]) AS s) s),
w AS (SELECT conv_id, 0::BIGINT AS i, 0 AS q, {'cost': 0, 'audit': '', 'rest': []::VARCHAR[]} AS best FROM c
  UNION ALL SELECT w.conv_id, e.i, e.q, min({'cost': (best).cost + ins.cost + e.cost, 'audit': (best).audit || ins.audit || e.edit, 'rest': list_concat((best).rest, list_concat(ins.ins, e.rest))})
  FROM w JOIN ins ON ins.p = w.q JOIN e ON e.conv_id IS NOT DISTINCT FROM w.conv_id AND e.i = w.i + 1 AND e.p = ins.q GROUP BY w.conv_id, e.i, e.q),
z AS (SELECT c.conv_id, min({'cost': (best).cost + ins.cost, 'audit': (best).audit || ins.audit, 'rest': list_concat((best).rest, ins.ins)}) AS best
  FROM c JOIN w ON w.conv_id IS NOT DISTINCT FROM c.conv_id AND w.i = c.n JOIN ins ON ins.p = w.q AND ins.q IN (0, 3) GROUP BY c.conv_id)
SELECT o.conv_id, coalesce(gaps, 0)::BIGINT AS gaps, coalesce(blank, 0)::BIGINT AS blank, coalesce(duplicate, 0)::BIGINT AS duplicate, coalesce(truncated, 0)::BIGINT AS truncated, coalesce(illegal, 0)::BIGINT AS illegal,
  coalesce((best).cost, 0)::BIGINT AS cost, coalesce((best).audit, '') AS audit, sha256(coalesce(array_to_string((best).rest, e'\n'), '')) AS repaired_sha256
FROM (SELECT DISTINCT conv_id FROM conversations) o LEFT JOIN c ON c.conv_id IS NOT DISTINCT FROM o.conv_id LEFT JOIN z ON z.conv_id IS NOT DISTINCT FROM o.conv_id
"""
