"""Document fingerprints from closed syncmers."""

from __future__ import annotations

import bisect
import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import powers, mix, sliding, staged

K, S, KEEP = 20, 10, 128
LOW = 1 << 61  # anchors of smaller hash are kept whatever their number: one in eight
BLOCK = 1 << 20


def anchors(raw: bytes, k: int = K, s: int = S) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of each closed syncmer: the k-byte runs whose smallest s-byte run (by hash)
    is the first or the last. Whether a run is one depends on its own bytes only."""
    b = np.frombuffer(raw, np.uint8)
    hashes, places = [], []
    for lo in range(0, max(1, len(b) - k + 1), BLOCK):  # runs that start in [lo, lo + BLOCK)
        part = b[lo : lo + BLOCK + k - 1]
        if len(part) < k:
            break
        p, q = powers(len(part) + 1)
        h = np.zeros(len(part) + 1, np.uint64)
        np.cumsum((part.astype(np.uint64) + np.uint64(1)) * p[: len(part)], out=h[1:])
        inner = mix((h[s:] - h[:-s]) * q[: len(part) - s + 1])
        w = k - s + 1
        low = sliding(inner, w)
        at = np.flatnonzero((inner[: len(low)] == low) | (inner[w - 1 :] == low))
        hashes.append(mix((h[at + k] - h[at]) * q[at]))
        places.append(at + lo)
    if not hashes or not sum(map(len, hashes)):
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    return np.concatenate(hashes), np.concatenate(places)


def fingerprint(raw: bytes, k: int = K, s: int = S, keep: int | None = KEEP) -> str:
    """The anchors of hash below ``LOW``, or the ``keep`` of smallest hash if those are more, as
    hash and first place in hexadecimal: an eighth of a long text's anchors, however long it is.
    Without ``keep`` all anchors.

    Equal texts have equal fingerprints. A text without an anchor (shorter than k, say) has one
    made of the hash of all of it; the empty text's fingerprint is empty.
    """
    if not raw:
        return ""
    h, at = anchors(raw, k, s)
    if not len(h):
        return hashlib.sha256(raw).hexdigest()[:8] + "0" * 8
    low = np.flatnonzero(h < np.uint64(LOW))
    h2, first = np.unique(h[low], return_index=True)
    if keep is not None and len(h2) >= keep:
        at = at[low][first]
    else:
        h2, first = np.unique(h, return_index=True)
        h2, at = h2[:keep], at[first][:keep]
    out = np.empty((len(h2), 2), ">u4")
    out[:, 0] = (h2 >> np.uint64(32)).astype(np.uint32)
    out[:, 1] = at
    return out.tobytes().hex()


def _whole_to(x: np.ndarray, keep: int | None) -> int:
    """The largest hash (its upper half) up to which a fingerprint holds all anchors of its text."""
    return 0xFFFFFFFF if keep is None or len(x) < keep else max(int(x[-1, 0]), (LOW >> 32) - 1)


def likeness(a: str, b: str, keep: int | None = KEEP) -> float:
    """0 to 1, from two fingerprints alone: the share of anchors that both texts hold, in the same
    order (twice the common ones over the sum of both), judged on the hashes up to which both
    fingerprints hold every anchor.

    1 for equal fingerprints, two empty ones included; 0 if one alone is empty.
    """
    if a == b:
        return 1.0
    if not a or not b:
        return 0.0
    x = np.frombuffer(bytes.fromhex(a), ">u4").reshape(-1, 2)
    y = np.frombuffer(bytes.fromhex(b), ">u4").reshape(-1, 2)
    top = min(_whole_to(x, keep), _whole_to(y, keep))
    x, y = x[x[:, 0] <= top], y[y[:, 0] <= top]
    both, i, j = np.intersect1d(x[:, 0], y[:, 0], return_indices=True)
    if not len(both):
        return 0.0
    union = np.union1d(x[:, 0], y[:, 0])
    order = np.argsort(x[i, 1], kind="stable")
    tails: list[int] = []
    for place in y[j[order], 1].tolist():  # the longest run of anchors in the same order
        t = bisect.bisect_left(tails, place)
        tails[t : t + 1] = [place]
    jaccard = len(tails) / len(union)
    return 2 * jaccard / (1 + jaccard)


def _edited(text: str, nxt: str) -> str:
    half = len(text) // 2
    return text[: len(text) - half] + nxt[:half]


SCHEMA = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"
_OUT = pa.schema(
    [("doc_id", pa.int64()), ("n_chars", pa.int64()), ("edited_sha256", pa.string()), ("fingerprint", pa.string())]
    + [("edited_fingerprint", pa.string()), ("near_edited", pa.float64()), ("near_next", pa.float64())]
)


def _row(doc_id, text: str, own: str, nxt: str, nxt_own: str, keep: int | None) -> tuple:
    raw = _edited(text, nxt).encode()
    fp = fingerprint(raw, keep=keep)
    return doc_id, len(text), hashlib.sha256(raw).hexdigest(), own, fp, likeness(own, fp, keep), likeness(own, nxt_own, keep)


def _batch(rows: list) -> pa.RecordBatch:
    cols = list(zip(*rows, strict=True)) if rows else [[]] * len(_OUT)
    return pa.RecordBatch.from_arrays([pa.array(c, f.type) for c, f in zip(cols, _OUT, strict=True)], schema=_OUT)


def _chain(keep: int | None):
    """Each row but the last of a sorted partition, beside the row after it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held = None
        for batch in batches:
            rows, size = [], 0
            for doc_id, x in zip(batch.column("doc_id").to_pylist(), batch.column("text"), strict=True):
                text = x.as_py()
                own = fingerprint(text.encode(), keep=keep)
                if held is not None:
                    rows.append(_row(*held, text, own, keep))
                    size += len(text)
                held = doc_id, text, own
                if size > 1 << 22:
                    yield _batch(rows)
                    rows, size = [], 0
            if rows:
                yield _batch(rows)

    return run


def _pairs(keep: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for r in batch.to_pylist():
                own, nxt = (fingerprint(r[c].encode(), keep=keep) for c in ("text", "next_text"))
                yield _batch([_row(r["doc_id"], r["text"], own, r["next_text"], nxt, keep)])

    return run


def _key(bounds: list[int]) -> list[Column]:
    over = F.size(F.filter(F.array(*[F.lit(b) for b in bounds]), lambda b: b > F.col("doc_id"))) if bounds else F.lit(0)
    return [
        F.when(F.col("doc_id").isNull(), len(bounds) + 1).otherwise(over).cast("int").alias("bucket"),
        F.bitwise_not(F.coalesce("doc_id", F.lit(0))).alias("k"),
        F.xxhash64("text").alias("tie"),
    ]


def fingerprints(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", keep: int | None = KEEP) -> DataFrame:
    """Each document's fingerprint and that of its edited text, whose second half (of code points)
    is the beginning of the next document in descending id, the first following the last.

    Ids are dealt to ranges by their approximate quantiles and sorted in each, so every task walks
    its range with one document in hand; the document after a range's last is the head of the
    next range, fetched for these rows alone (two ids a range, a bounded number).

    ``keep=None`` keeps all anchors: fingerprints as long as texts, and likeness without sampling.

    Null texts are empty. Null ids come after all others; rows of equal id are ordered by a hash
    of the text, and equal rows are interchangeable. A single row is its own next. No rows give
    no rows. Other columns are not read.
    """
    spark = docs.sparkSession
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.coalesce(f"`{text_col}`", F.lit("")).alias("text"))
    n = max(1, int(spark.conf.get("spark.sql.shuffle.partitions")))
    cuts = docs.select(F.percentile_approx("doc_id", [i / n for i in range(1, n)] or [0.5], 10_000)).first()[0]
    keyed = docs.select("doc_id", "text", *_key(sorted(set(cuts or []))))
    ends = keyed.groupBy("bucket").agg(F.min(F.struct("k", "tie")).alias("head"), F.max(F.struct("k", "tie")).alias("tail"))
    order = Window.partitionBy(F.lit(0)).orderBy("bucket")
    every = order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ends = ends.select(
        "bucket",
        "tail",
        F.coalesce(F.lead("head").over(order), F.first("head").over(every)).alias("head"),
        F.coalesce(F.lead("bucket").over(order), F.first("bucket").over(every)).alias("head_bucket"),
    )
    ends = staged(ends, "range-ends")  # a row for each range
    wanted = ends.select("bucket", "tail.*").unionByName(ends.select(F.col("head_bucket").alias("bucket"), "head.*")).distinct()
    texts = staged(
        keyed.join(F.broadcast(wanted), ["bucket", "k", "tie"]).groupBy("bucket", "k", "tie").agg(F.first("doc_id").alias("doc_id"), F.first("text").alias("text")),
        "range-texts",
    )
    tails = ends.select("bucket", "tail.*", F.col("head_bucket").alias("h_bucket"), F.col("head.k").alias("h_k"), F.col("head.tie").alias("h_tie"))
    heads = texts.select(F.col("bucket").alias("h_bucket"), F.col("k").alias("h_k"), F.col("tie").alias("h_tie"), F.col("text").alias("next_text"))
    last = tails.join(texts, ["bucket", "k", "tie"]).join(heads, ["h_bucket", "h_k", "h_tie"]).select("doc_id", "text", "next_text")
    inner = keyed.repartitionById(n + 2, F.col("bucket")).sortWithinPartitions("bucket", "k", "tie").select("doc_id", "text")
    return inner.mapInArrow(_chain(keep), SCHEMA).unionByName(last.mapInArrow(_pairs(keep), SCHEMA))


def op9_fingerprints(spark, sf_dir: str) -> DataFrame:
    return fingerprints(spark.read.parquet(f"{sf_dir}/documents.parquet"))
