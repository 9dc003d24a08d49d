"""Bounded-space online packing of token sequences."""

from __future__ import annotations

import bisect
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import staged
from .tokens import token_ids

SCHEMA = "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long"
COLUMNS = ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset"]


class Windows:
    """At most ``most`` open windows of ``size`` tokens; best fit, and the fullest goes when none fits."""

    def __init__(self, size: int, most: int):
        self.size, self.most = size, most
        self.room: list[tuple[int, int]] = []  # (room left, window), ascending
        self.held: dict[int, list] = {}
        self.made = 0

    def place(self, piece: tuple, length: int) -> list | None:
        """Put a piece in; returns a window's pieces if one had to go."""
        gone = None
        at = bisect.bisect_left(self.room, (length, -1))
        if at < len(self.room):
            room, w = self.room.pop(at)
            self.held[w].append(piece)
        else:
            if len(self.room) >= self.most:
                gone = self.held.pop(self.room.pop(0)[1])
            room, w = self.size, self.made
            self.made += 1
            self.held[w] = [piece]
        if room == length:
            full = self.held.pop(w)
            if gone is None:
                return full
            return gone + [None] + full  # two windows went: parted by None
        bisect.insort(self.room, (room - length, w))
        return gone

    def rest(self) -> list[list]:
        return [self.held[w] for _, w in self.room]


def _rows(windows: list[list], base: int, n: int) -> tuple[list, int]:
    out = []
    for pieces in windows:
        at = 0
        for p in pieces:
            out.append((*p, base + n, at))
            at += p[2]
        n += 1
    return out, n


def _split(gone: list | None) -> list[list]:
    if not gone:
        return []
    if None in gone:
        i = gone.index(None)
        return [gone[:i], gone[i + 1 :]]
    return [gone]


def _batch(rows: list, schema: pa.Schema) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[]] * len(schema)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def pack(
    docs: DataFrame,
    tokenizer: str,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    size: int = 1024,
    end_id: int = 0,
    open_windows: int = 128,
    merge: int = 64,
) -> DataFrame:
    """Pieces of sequences: ``doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset``.

    A document is its ids and ``end_id``. Its whole runs of ``size`` are sequences of their own;
    the remainder goes to the open window that it fits best, of ``open_windows`` per partition,
    and the fullest window is closed when it fits none. What is open at a partition's end is
    merged: the leftovers of ``merge`` partitions are packed by one task, largest first, so no task sees more
    than ``merge * open_windows`` windows.

    Null texts are empty documents (``end_id`` alone); null and repeated ids pass through, each
    row is a document; texts of any length are cut as above; no rows give no rows. Columns other
    than the two named are not read.
    """
    long = pa.int64()
    first = pa.schema([pa.field(c, long) for c in COLUMNS] + [pa.field("open", pa.bool_()), pa.field("part", long)])
    final = pa.schema([pa.field(c, long) for c in COLUMNS])

    def online(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = TaskContext.get().partitionId()
        base, n = part << 32, 0
        windows = Windows(size, open_windows)
        for batch in batches:
            rows: list = []
            for doc_id, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                ids = np.append(token_ids(tokenizer, text.as_py() or ""), np.uint32(end_id)).astype("<u4")
                total = len(ids)
                for start in range(0, total, size):
                    length = min(size, total - start)
                    piece = (doc_id, start, length, zlib.crc32(ids[start : start + length]), total)
                    gone = [[piece]] if length == size else _split(windows.place(piece, length))
                    more, n = _rows(gone, base, n)
                    rows += more
            if rows:
                yield _batch([(*r, False, part) for r in rows], first)
        rows, n = _rows(windows.rest(), base, n)
        if rows:
            yield _batch([(*r, True, part) for r in rows], first)

    def leftovers(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        base, n = 1 << 61 | TaskContext.get().partitionId() << 32, 0
        windows = Windows(size, open_windows * merge)
        for batch in batches:
            rows = []
            for r in batch.to_pylist():
                piece = tuple(r[c] for c in COLUMNS[:5])
                more, n = _rows(_split(windows.place(piece, r["length"])), base, n)
                rows += more
            if rows:
                yield _batch(rows, final)
        rows, n = _rows(windows.rest(), base, n)
        if rows:
            yield _batch(rows, final)

    placed = staged(docs.select(F.col(f"`{id_col}`").cast("long"), f"`{text_col}`").mapInArrow(online, SCHEMA + ", open boolean, part long"), "packed")
    parts = placed.agg(F.max("part")).first()[0]
    tasks = (parts or 0) // merge + 1
    rest = (
        placed.where("open")
        .withColumn("to", (F.col("part") / merge).cast("long"))
        .repartition(tasks, "to")
        .sortWithinPartitions(F.col("length").desc(), "doc_id", "start", "ids_crc32")
        .select(*COLUMNS)
        .mapInArrow(leftovers, SCHEMA)
    )
    return placed.where("NOT open").select(*COLUMNS).unionByName(rest)


def op3_packing(spark, sf_dir: str) -> DataFrame:
    import public_tokenizers

    return pack(spark.read.parquet(f"{sf_dir}/documents.parquet"), public_tokenizers.path("byte_bpe_50k.json"))
