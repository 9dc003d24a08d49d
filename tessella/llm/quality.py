"""Line-level quality with a linear-chain conditional random field, summed up to documents."""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import pieces, refuse_names, text_bytes, word_hashes, word_spans

FIT_DOCS = 3000  # labelled documents in the fit, at most
FIT_BYTES = 1 << 17  # longer documents take no part in the fit
THRESHOLD = 0.3
N_OWN = 13


@dataclass(frozen=True)
class Crf:
    """Weights of a two-label chain: label 1 against 0 for a line, and the four transitions."""

    weights: np.ndarray  # own, previous and next line's features, and a constant
    move: np.ndarray  # move[i, j]: from label i to label j
    mean: np.ndarray
    scale: np.ndarray


# --- features --------------------------------------------------------------

_KIND = np.full(256, 1, np.uint8)  # 0 white space, 1 letter (all bytes over 127), 2 capital, 3 digit, 4 usual mark, 5 other sign
_KIND[:128] = 5
_KIND[[9, 10, 11, 12, 13, 32]] = 0
_KIND[97:123] = 1
_KIND[65:91] = 2
_KIND[48:58] = 3
_KIND[[ord(c) for c in ".,;:'\"?-()"]] = 4


def line_features(b: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Own features of each non-empty line, its row, and its length in bytes.

    Shares of letters, capitals, digits, marks and other signs; length; mean word length; signs
    and bars a word; distinct and immediately repeated words; lines that occur again in the text.
    """
    cut = np.union1d(offsets[:-1], np.flatnonzero(b == 10) + 1)
    cut = cut[cut < len(b)]
    if not len(cut):
        return np.zeros((0, N_OWN)), np.zeros(0, np.int64), np.zeros(0, np.int64)
    ends = np.append(cut[1:], len(b))
    row = np.searchsorted(offsets, cut, "right") - 1
    kind = _KIND[b]
    n = (ends - cut).astype(np.float64)
    count = [np.add.reduceat((kind == k).astype(np.int64), cut).astype(np.float64) for k in range(1, 6)]
    bang = np.add.reduceat((b == 33).astype(np.int64), cut).astype(np.float64)
    bar = np.add.reduceat((b == 124).astype(np.int64), cut).astype(np.float64)

    starts, stops, _ = word_spans(b, offsets)
    hashes = word_hashes(b, starts, stops)
    line = np.searchsorted(cut, starts, "right") - 1
    words = np.bincount(line, minlength=len(cut)).astype(np.float64)
    again = np.bincount(line[1:][(hashes[1:] == hashes[:-1]) & (line[1:] == line[:-1])], minlength=len(cut)) if len(line) > 1 else np.zeros(len(cut))
    key = hashes ^ (line.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15))
    order = np.argsort(key, kind="stable")
    fresh = np.ones(len(order), bool)
    fresh[1:] = key[order][1:] != key[order][:-1]
    distinct = np.bincount(line[order[fresh]], minlength=len(cut))

    whole = np.zeros(len(cut), np.uint64)  # of a line's words, in order
    if len(line):
        at = np.arange(len(line)) - np.searchsorted(line, line)
        np.add.at(whole, line, hashes * (2 * at.astype(np.uint64) + np.uint64(1)))
    same = whole ^ (row.astype(np.uint64) * np.uint64(0xD6E8FEB86659FD93))
    _, back, times = np.unique(same, return_inverse=True, return_counts=True)

    w = np.maximum(words, 1)
    x = np.column_stack(
        [c / n for c in count]
        + [np.log1p(n), count[0] / w, count[4] / w, np.minimum(bang / w, 4), np.minimum(bar / w, 4), distinct / w, again / w, np.minimum(times[back] - 1, 5)]
    )
    full = words > 0
    return x[full], row[full], (ends - cut)[full]


def with_neighbours(x: np.ndarray, row: np.ndarray) -> np.ndarray:
    """Own features, those of the line before and after in the same text (0 if none), and 1."""
    before, after = np.zeros_like(x), np.zeros_like(x)
    if len(x) > 1:
        same = (row[1:] == row[:-1])[:, None]
        before[1:] = x[:-1] * same
        after[:-1] = x[1:] * same
    return np.column_stack([x, before, after, np.ones(len(x))])


# --- the chain -------------------------------------------------------------


def _steps(row: np.ndarray) -> list[np.ndarray]:
    """For t = 0, 1, ..: the lines that are the t-th of their text, texts with most lines first."""
    starts = np.flatnonzero(np.r_[True, row[1:] != row[:-1]]) if len(row) else np.zeros(0, np.int64)
    n = np.diff(np.append(starts, len(row)))
    order = np.argsort(-n, kind="stable")
    starts, n = starts[order], n[order]
    return [starts[: np.searchsorted(-n, -t, "left")] + t for t in range(int(n[0]) if len(n) else 0)]


def forward_backward(s: np.ndarray, row: np.ndarray, move: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Log odds of label 1 from the lines up to each (itself included), and from those after it."""
    steps = _steps(row)
    r, back = s.copy(), np.zeros_like(s)
    for t in range(1, len(steps)):
        at = steps[t]
        p = r[at - 1]
        r[at] = s[at] + np.logaddexp(move[0, 1], move[1, 1] + p) - np.logaddexp(move[0, 0], move[1, 0] + p)
    for t in range(len(steps) - 1, 0, -1):
        at = steps[t]
        q = s[at] + back[at]
        back[at - 1] = np.logaddexp(move[1, 0], move[1, 1] + q) - np.logaddexp(move[0, 0], move[0, 1] + q)
    return r, back


def _sigmoid(x: np.ndarray) -> np.ndarray:
    return 1 / (1 + np.exp(-np.clip(x, -500, 500)))


def fit(x: np.ndarray, row: np.ndarray, label: np.ndarray, rounds: int = 100, ridge: float = 1e-3) -> Crf:
    """Maximise the penalised likelihood of the lines' labels by Adam; each document weighs alike."""
    mean, scale = (x.mean(0), x.std(0) + 1e-6) if len(x) else (np.zeros(N_OWN), np.ones(N_OWN))
    z = with_neighbours((x - mean) / scale, row)
    w, move = np.zeros(z.shape[1]), np.zeros((2, 2))
    if not len(x) or len(np.unique(label)) < 2:
        return Crf(w, move, mean, scale)
    _, doc, size = np.unique(row, return_inverse=True, return_counts=True)
    each = 1 / size[doc] / len(size)
    inner = np.flatnonzero(row[1:] == row[:-1]) + 1
    seen = np.zeros((2, 2))
    np.add.at(seen, (label[inner - 1], label[inner]), each[inner])
    m, v = np.zeros(len(w) + 4), np.zeros(len(w) + 4)
    for i in range(1, rounds + 1):
        s = z @ w
        r, back = forward_backward(s, row, move)
        grad_w = z.T @ (each * (label - _sigmoid(r + back))) - ridge * w
        pair = np.stack([i_ * r[inner - 1] + move[i_, j] + j * (s[inner] + back[inner]) for i_ in (0, 1) for j in (0, 1)])
        pair = np.exp(pair - pair.max(0))
        pair /= pair.sum(0)
        g = np.r_[grad_w, (seen.ravel() - pair @ each[inner]) - ridge * move.ravel()]
        m, v = 0.9 * m + 0.1 * g, 0.99 * v + 0.01 * g * g
        step = 0.1 * (m / (1 - 0.9**i)) / (np.sqrt(v / (1 - 0.99**i)) + 1e-8)
        w, move = w + step[:-4], move + step[-4:].reshape(2, 2)
    return Crf(w, move, mean, scale)


def scores(model: Crf, b: np.ndarray, offsets: np.ndarray) -> np.ndarray:
    """For each text the mean marginal of label 1 over its lines, weighted by their lengths; 0 without lines."""
    x, row, n = line_features(b, offsets)
    total = np.zeros(len(offsets) - 1)
    if len(x):
        s = with_neighbours((x - model.mean) / model.scale, row) @ model.weights
        r, back = forward_backward(s, row, model.move)
        good = np.bincount(row, n * _sigmoid(r + back), len(total))
        size = np.bincount(row, n, len(total))
        total = np.divide(good, size, out=total, where=size > 0)
    return total


# --- on Spark --------------------------------------------------------------


def held_out(doc_id: Column) -> Column:
    return F.coalesce(F.crc32(doc_id.cast("string").cast("binary")) % 5 == 0, F.lit(False))


def fit_quality(docs: DataFrame, labels: DataFrame, *, fit_docs: int = FIT_DOCS, fit_bytes: int = FIT_BYTES) -> Crf:
    """The chain, fitted on the ``fit_docs`` labelled documents of smallest id hash that are not
    held out, of ``fit_bytes`` at most each: what reaches the driver is bounded by the two.

    Rows with a null id, text or label are left out, as are labels other than 0 and 1. With no
    rows, or one label only, the chain has zero weights and scores every text with lines 0.5.
    """
    sample = (
        labels.where("doc_id IS NOT NULL AND quality IN (0, 1)")
        .where(~held_out(F.col("doc_id")))
        .select(F.col("doc_id").alias("l_id"), "quality", F.xxhash64(F.col("doc_id").cast("string"), F.lit("fit")).alias("h"))
        .orderBy("h", "l_id", "quality")
        .limit(fit_docs)
    )
    texts = docs.where(F.octet_length("text") <= fit_bytes).select("doc_id", "text")
    rows = texts.join(F.broadcast(sample), F.col("doc_id") == F.col("l_id")).select("h", "doc_id", "quality", "text").orderBy("h", "doc_id", "text").limit(2 * fit_docs).toArrow()
    x, row, _ = line_features(*text_bytes(rows.column("text")))
    return fit(x, row, rows.column("quality").to_numpy().astype(np.int64)[row])


def score_quality(docs: DataFrame, model: Crf, *, text_col: str = "text") -> DataFrame:
    """``docs`` with ``quality_score`` (0 to 1) and ``quality_good`` (score >= 0.3).

    Every text is scored whole, from its lines alone. Null, empty and blank texts score 0; other
    columns pass through, but one of an added name raises ``ValueError``.
    """
    refuse_names(docs.columns, "quality_score", "quality_good")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b, offsets = text_bytes(batch.column(at))
            done = np.concatenate([np.zeros(0)] + [scores(model, b[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i]) for i, j in pieces(offsets)])
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(done, pa.float64())], names=[*batch.schema.names, "quality_score"])

    at = docs.columns.index(text_col)
    out = T.StructType([*docs.schema.fields, T.StructField("quality_score", T.DoubleType())])
    return docs.mapInArrow(run, out).withColumn("quality_good", F.col("quality_score") >= THRESHOLD)


def op4_quality(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    model = fit_quality(docs, spark.read.parquet(f"{sf_dir}/labels.parquet"))
    scored = score_quality(docs, model)
    return scored.select(
        "doc_id",
        held_out(F.col("doc_id")).alias("held_out"),
        F.col("quality_score").alias("score"),
        F.col("quality_good").cast("int").alias("predicted"),
    )
