"""What the operators share: staging in the shared folder, and numpy helpers that run inside tasks."""

from __future__ import annotations

import atexit
import hashlib
import re
import tempfile
import uuid
from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# --- staging ---------------------------------------------------------------

_LOCAL: list[str] = []


def shared_dir(spark: SparkSession) -> str:
    """The folder that the cluster shares (``spark.checkpoint.dir``).

    Only where the setting is absent and all runs in one process, as in tests, is a temporary
    folder used; on a cluster its absence is an error.
    """
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _LOCAL:
        _LOCAL.append(f"file://{tempfile.mkdtemp(prefix='tessella-')}")
    return _LOCAL[0]


def _remove(spark: SparkSession, path: str) -> None:
    try:
        jvm = spark.sparkContext._jvm
        p = jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session has ended; the folder is the cluster's to clear
        return


def scratch(spark: SparkSession, label: str) -> str:
    """A fresh path in the shared folder, removed when the driver ends."""
    path = f"{shared_dir(spark)}/{label}-{uuid.uuid4().hex}"
    atexit.register(_remove, spark, path)
    return path


CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"


def staged(df: DataFrame, label: str) -> DataFrame:
    """Write ``df`` as Parquet in the shared folder and read it back: lineage ends there and
    a lost executor costs no recomputation. Spark deletes a write's shuffle files at its end, by
    a setting that is switched on once for the session, unless the session has set it itself."""
    spark = df.sparkSession
    if spark.conf.get(CLEANUP, "false") != "true":
        spark.conf.set(CLEANUP, "true")
    path = scratch(spark, label)
    df.write.parquet(path)
    back = spark.read.schema(df.schema).parquet(path)
    back.staged_at = path
    return back


def bucketed(df: DataFrame, label: str, key: str) -> DataFrame:
    """``staged``, in buckets of ``key``: a join by this key moves the other side's rows only."""
    spark = df.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    path, name = scratch(spark, label), f"tessella_{uuid.uuid4().hex}"
    df.repartition(parts, key).write.bucketBy(parts, key).option("path", path).saveAsTable(name)
    back = spark.table(name)
    back.staged_at, back.staged_as = path, name
    return back


def discard(*frames: DataFrame | None) -> None:
    """Delete what ``staged`` or ``bucketed`` wrote, once nothing reads it any more."""
    for df in frames:
        if df is not None and getattr(df, "staged_as", None):
            df.sparkSession.sql(f"DROP TABLE IF EXISTS {df.staged_as}")
        if df is not None and getattr(df, "staged_at", None):
            _remove(df.sparkSession, df.staged_at)


def refuse_names(columns: Iterable[str], *added: str) -> None:
    """Raise if a table has a column, in any case, that is to be added to it."""
    clash = {c.lower() for c in columns} & {c.lower() for c in added}
    if clash:
        raise ValueError(f"the table already has {', '.join(sorted(clash))}: rename before")


def with_key_of_many(rows: DataFrame, table: DataFrame, keys: list[str], counts: str, *, most: int = 10_000) -> DataFrame:
    """Inner join of ``rows`` with ``table`` (one row a key, ``counts`` of ``rows`` with it).

    Keys that hold more than one row in ``most`` of all, ``most`` keys at most, are broadcast, so
    that a key of a third of all rows meets in no task; the others are joined by a shuffle.
    """
    total = table.agg(F.sum(counts)).first()[0] or 0
    is_hot = F.col(counts) > max(1000, -(-total // most))
    hot, rest = table.where(is_hot), table.where(~is_hot).drop(counts)
    near = rows.join(F.broadcast(hot.drop(counts)), keys)
    far = rows.join(F.broadcast(hot.select(*keys)), keys, "left_anti").join(rest, keys)
    return near.unionByName(far)


# --- Arrow strings as bytes ------------------------------------------------


def text_bytes(col: pa.Array | pa.ChunkedArray) -> tuple[np.ndarray, np.ndarray]:
    """All bytes of a string column and the n + 1 offsets of its rows; null counts as empty."""
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    if col.null_count:
        col = col.fill_null("")
    if not len(col):
        return np.zeros(0, np.uint8), np.zeros(1, np.int64)
    wide = pa.types.is_large_string(col.type)
    _, offs, data = col.buffers()
    offsets = np.frombuffer(offs, np.int64 if wide else np.int32)[col.offset : col.offset + len(col) + 1].astype(np.int64)
    buf = np.frombuffer(data, np.uint8)[offsets[0] : offsets[-1]] if data is not None else np.zeros(0, np.uint8)
    return buf, offsets - offsets[0]


def pieces(offsets: np.ndarray, most: int = 1 << 21) -> Iterator[tuple[int, int]]:
    """Runs of rows [i, j) of at most ``most`` bytes, one row at least."""
    i, n = 0, len(offsets) - 1
    while i < n:
        j = max(i + 1, int(np.searchsorted(offsets, offsets[i] + most, "right")) - 1)
        yield i, j
        i = j


# --- 64-bit hashing --------------------------------------------------------

_BASE = np.uint64(0x9E3779B97F4A7C15 | 1)
_POW: list[np.ndarray] = []


def powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """base**i and base**-i modulo 2**64 for i < n, kept between calls up to 4 Mi entries."""
    if not _POW or len(_POW[0]) < n:
        size = max(n, 1 << 16)
        inv = np.uint64(pow(int(_BASE), -1, 1 << 64))
        made = []
        for b in (_BASE, inv):
            p = np.full(size, b, np.uint64)
            p[0] = 1
            made.append(np.multiply.accumulate(p))
        if size > 1 << 22:
            return made[0], made[1]
        _POW[:] = made
    return _POW[0], _POW[1]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective scrambling of 64-bit values."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x ^= x >> np.uint64(27)
    x *= np.uint64(0x94D049BB133111EB)
    x ^= x >> np.uint64(31)
    return x


def gram_hashes(b: np.ndarray, k: int) -> np.ndarray:
    """A hash for each run of k bytes of b."""
    if len(b) < k:
        return np.zeros(0, np.uint64)
    p, q = powers(len(b) + 1)
    h = np.zeros(len(b) + 1, np.uint64)
    np.cumsum((b.astype(np.uint64) + np.uint64(1)) * p[: len(b)], out=h[1:])
    return mix((h[k:] - h[:-k]) * q[: len(b) - k + 1])


def word_spans(b: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Start, end and row of each word ``[^\\x20\\x09-\\x0D]+``; words end where rows end."""
    if not len(b):
        z = np.zeros(0, np.int64)
        return z, z, z
    sep = (b == 32) | ((b >= 9) & (b <= 13))
    first = np.zeros(len(b) + 1, bool)
    first[offsets] = True
    before = np.empty(len(b), bool)
    before[0] = True
    before[1:] = sep[:-1]
    starts = np.flatnonzero(~sep & (before | first[:-1]))
    after = np.empty(len(b), bool)
    after[-1] = True
    after[:-1] = sep[1:]
    ends = np.flatnonzero(~sep & (after | first[1:])) + 1
    return starts, ends, np.searchsorted(offsets, starts, "right") - 1


_LONG_WORD = 64
_MASK = np.array([(1 << 8 * i) - 1 for i in range(8)] + [(1 << 64) - 1], np.uint64)


def word_hashes(b: np.ndarray, starts: np.ndarray, ends: np.ndarray, seed: int = 0) -> np.ndarray:
    """A 64-bit hash for each word, eight bytes mixed at a time; two seeds give 128 bits.

    Words of over 64 bytes are hashed by BLAKE2.
    """
    size = ends - starts
    h = mix(size.astype(np.uint64) + np.uint64((seed * 2 + 1) * 0x9E3779B97F4A7C15 & (1 << 64) - 1))
    if not len(starts):
        return h
    held = np.append(b, np.zeros(8, np.uint8))
    lanes = np.ndarray((len(b) + 1,), "<u8", held, strides=(1,))
    at = np.flatnonzero(size <= _LONG_WORD)
    step = 0
    while len(at):
        left = size[at] - step
        h[at] = mix((h[at] ^ (lanes[starts[at] + step] & _MASK[np.minimum(left, 8)])) * np.uint64(0xD6E8FEB86659FD93) + np.uint64(step + 1))
        step += 8
        at = at[left > 8]
    raw = None
    for i in np.flatnonzero(size > _LONG_WORD).tolist():
        raw = memoryview(b) if raw is None else raw
        digest = hashlib.blake2b(raw[starts[i] : ends[i]], digest_size=8, salt=str(seed).encode()).digest()
        h[i] = int.from_bytes(digest, "little")
    return h


def shingle_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """A hash for each run of n word hashes."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    m = len(words) - n + 1
    h = np.zeros(m, np.uint64)
    for i in range(n):
        h = h * np.uint64(0xD6E8FEB86659FD93) + words[i : i + m]
    return mix(h)


# --- sliding minima --------------------------------------------------------


def sliding(x: np.ndarray, w: int, pick=np.minimum) -> np.ndarray:
    """pick over each w consecutive values, by doubling; len(x) - w + 1 values."""
    if len(x) < w:
        return x[:0]
    m, have = x, 1
    while have < w:
        step = min(have, w - have)
        m = pick(m[: len(m) - step], m[step:])
        have += step
    return m


def minimizers(x: np.ndarray, row: np.ndarray, w: int) -> np.ndarray:
    """Where x is smallest in some w consecutive values of one row (all ties); row is that of each
    symbol, of which the first of x spans the first few.

    Equal stretches of w values choose equal places, whatever surrounds them.
    """
    if len(x) < w:
        return np.zeros(0, np.int64)
    m = sliding(x, w).copy()
    m[row[: len(m)] != row[len(row) - len(m) :]] = 0
    pad = np.zeros(w - 1, np.uint64)
    best = sliding(np.concatenate([pad, m, pad]), w, np.maximum)
    return np.flatnonzero((best == x) & (best != 0))


def signed(x: np.ndarray) -> np.ndarray:
    return x.view(np.int64)
