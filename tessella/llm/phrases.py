"""Phrase collocations: weighted automata of word windows, summed by prefix range and composed with their cuts."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import discard, mix, pieces, signed, staged, text_bytes, word_hashes

LONGEST, LEAST, SHARE, REPORTED = 4, 30, 80, 2000
CHUNK = 1 << 22  # bytes of text that make a shard
PENDING = 1 << 21  # counted pairs that a task holds before it looks for equal ones
FILTER_BITS = 28  # the largest filter of frequent pairs has 2**28 bits

_CLASS = np.zeros(256, np.uint8)
_CLASS[[0x20, 0x09]] = 1
_CLASS[[*b".,;:!?", 0x0A, 0x0B, 0x0C, 0x0D]] = 2

# --- words -----------------------------------------------------------------


def piece_words(b: np.ndarray, offsets: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """Of all texts, A-Z lower-cased: the bytes, start, end and row of each word, and whether the
    next word follows in the same piece."""
    low = b + ((b >= 65) & (b <= 90)).astype(np.uint8) * np.uint8(32)
    kind = _CLASS[low]
    inside = kind == 0
    first = np.zeros(len(low) + 1, bool)
    first[offsets] = True
    starts = np.flatnonzero(inside & (np.r_[True, ~inside[:-1]] | first[:-1])[: len(low)])
    ends = np.flatnonzero(inside & (np.r_[~inside[1:], True] | first[1:])[: len(low)]) + 1
    row = np.searchsorted(offsets, starts, "right") - 1
    piece = np.cumsum(kind == 2, dtype=np.int32)[starts] if len(starts) else starts
    joined = np.zeros(len(starts), bool)
    joined[:-1] = (piece[1:] == piece[:-1]) & (row[1:] == row[:-1])
    return low, starts, ends, row, joined


def _shards(batch: pa.RecordBatch) -> Iterator[tuple]:
    """``lang, text`` shard by shard: the languages' names and each row's, then ``piece_words``."""
    b, offsets = text_bytes(batch.column(1))
    langs = batch.column(0).dictionary_encode()
    of_row, names = langs.indices.to_numpy(zero_copy_only=False), langs.dictionary
    for i, j in pieces(offsets, CHUNK):
        low, starts, ends, row, joined = piece_words(b[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i])
        if len(starts):
            yield names, of_row[i:j][row].astype(np.int64), low, starts, ends, joined


def _pair_hashes(names: pa.Array, lang: np.ndarray, low: np.ndarray, starts: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """A hash of each word with the next, and their language."""
    raw, at = text_bytes(names.cast(pa.string()))
    of_lang = word_hashes(raw, at[:-1], at[1:], 1)
    words = word_hashes(low, starts, ends)
    out = words * np.uint64(0xD6E8FEB86659FD93) + of_lang[lang]
    out[:-1] += mix(words[1:])
    return mix(out)


# --- pairs of words that are frequent ----------------------------------------


def _summed(hashes: list[np.ndarray], counts: list[np.ndarray], least: int) -> tuple[np.ndarray, np.ndarray]:
    h, c = np.concatenate(hashes), np.concatenate(counts)
    order = np.argsort(h)
    h, c = h[order], c[order]
    at = np.flatnonzero(np.r_[True, h[1:] != h[:-1]]) if len(h) else np.zeros(0, np.int64)
    return h[at], np.minimum(np.add.reduceat(c, at), least) if len(h) else c


_PAIRS = pa.schema([("bucket", pa.int32()), ("n", pa.int32()), ("z", pa.binary())])


def _packed(h: np.ndarray, c: np.ndarray, buckets: int) -> pa.RecordBatch:
    """A row for each range of hashes: their differences and counts, compressed."""
    width = np.uint64(64 - (buckets.bit_length() - 1))
    bucket = (h >> width).astype(np.int64)
    cut = np.flatnonzero(np.r_[True, bucket[1:] != bucket[:-1], True])
    rows = []
    for i, j in zip(cut[:-1].tolist(), cut[1:].tolist(), strict=True):
        steps = np.diff(h[i:j], prepend=np.uint64(0)).view(np.uint8).reshape(-1, 8).T  # the bytes of equal rank together
        rows.append((int(bucket[i]), j - i, pa.compress(steps.tobytes() + c[i:j].astype(np.uint8).tobytes(), "zstd", asbytes=True)))
    return pa.RecordBatch.from_arrays([pa.array(x, f.type) for x, f in zip(zip(*rows, strict=True), _PAIRS, strict=True)], schema=_PAIRS)


def _unpacked(n: int, z: bytes) -> tuple[np.ndarray, np.ndarray]:
    raw = np.frombuffer(pa.decompress(z, 9 * n, "zstd"), np.uint8)
    steps = np.ascontiguousarray(raw[: 8 * n].reshape(8, n).T).view(np.uint64).ravel()
    return np.cumsum(steps, dtype=np.uint64), raw[8 * n :].astype(np.int64)


def _pairs(buckets: int, least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hashes, counts, held = [], [], 0
        for batch in batches:
            for names, lang, low, starts, ends, joined in _shards(batch):
                h, c = np.unique(_pair_hashes(names, lang, low, starts, ends)[joined], return_counts=True)
                hashes.append(h)
                counts.append(np.minimum(c, least))
                held += len(h)
                if held >= PENDING:
                    h, c = _summed(hashes, counts, least)
                    hashes, counts, held = [h], [c], len(h)
                    if held >= PENDING // 2:
                        yield _packed(h, c, buckets)
                        hashes, counts, held = [], [], 0
        if held:
            yield _packed(*_summed(hashes, counts, least), buckets)

    return run


def _frequent(least: int):
    """Of rows in order of ``bucket`` the hashes that are counted ``least`` times or more in all."""
    out = pa.schema([("h", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        now, hashes, counts, held = None, [], [], 0

        def found() -> pa.RecordBatch:
            h, c = _summed(hashes, counts, least)
            return pa.RecordBatch.from_arrays([pa.array(signed(h[c >= least]))], schema=out)

        for batch in batches:
            for r in batch.to_pylist():
                if now is not None and r["bucket"] != now:
                    yield found()
                    hashes, counts, held = [], [], 0
                now = r["bucket"]
                h, c = _unpacked(r["n"], r["z"])
                hashes.append(h)
                counts.append(c)
                held += len(h)
                if held > PENDING:
                    h, c = _summed(hashes, counts, least)
                    hashes, counts, held = [h], [c], 0
        if hashes:
            yield found()

    return run


def frequent_pairs(texts: DataFrame, least: int) -> tuple[bytes, int]:
    """A filter of the adjacent words that occur ``least`` times or more: bits, and the logarithm of
    their number. It has no false negatives. Of 16 bits a pair, up to ``2**FILTER_BITS`` in all, so
    what is broadcast is bounded; beyond some 10**8 frequent pairs it lets more of the others through,
    which costs time and changes no result."""
    parts = int(texts.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    buckets = min(1 << 14, 1 << (4 * parts).bit_length())
    counted = texts.mapInArrow(_pairs(buckets, least), "bucket int, n int, z binary")
    kept = staged(counted.repartition(parts, "bucket").sortWithinPartitions("bucket").mapInArrow(_frequent(least), "h long"), "frequent-pairs")
    bits = min(FILTER_BITS, max(10, (16 * kept.count()).bit_length()))
    place = F.shiftrightunsigned("h", 64 - bits)
    words = kept.select(F.shiftright(place, 6).alias("word"), F.expr(f"shiftleft(1L, cast(shiftrightunsigned(h, {64 - bits}) & 63 as int))").alias("bit"))
    table = words.groupBy("word").agg(F.bit_or("bit").alias("bit")).toArrow()
    out = np.zeros(1 << (bits - 6), np.int64)
    out[table.column("word").to_numpy()] = table.column("bit").to_numpy()
    discard(kept)
    return out.tobytes(), bits


# --- automata of windows -----------------------------------------------------

WORDS = [f"w{k + 1}" for k in range(LONGEST)]
_WINDOWS = pa.schema([("lang", pa.string()), *[(w, pa.string()) for w in WORDS], ("weight", pa.int64())])


def _ahead(x: np.ndarray, k: int) -> np.ndarray:
    """What stands k places later, and zeros at the end."""
    return np.r_[x[k:], np.zeros(min(k, len(x)), x.dtype)]


def _windows(filter_, bits: int):
    """For each shard its windows in order, with their counts: the paths of a weighted automaton.

    Each word starts one window, of up to ``LONGEST`` words, that goes on as long as adjacent words
    are frequent together; so the count of a phrase is the sum over the range of windows that begin
    with it, for each phrase that may be frequent.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen = np.frombuffer(filter_.value, np.uint8)
        for batch in batches:
            for names, lang, low, starts, ends, joined in _shards(batch):
                place = (_pair_hashes(names, lang, low, starts, ends) >> np.uint64(64 - bits)).astype(np.int64)
                on = joined & (seen[place >> 3] >> (place & 7).astype(np.uint8) & 1).astype(bool)
                edge = np.r_[0, np.cumsum(ends - starts)].astype(np.int32)
                held = pa.Array.from_buffers(pa.binary(), len(starts), [None, pa.py_buffer(edge), pa.py_buffer(low[_CLASS[low] == 0])]).dictionary_encode()
                order = pc.sort_indices(held.dictionary).to_numpy()
                rank = np.empty(len(order), np.int64)
                rank[order] = np.arange(1, len(order) + 1)
                ids, n = rank[held.indices.to_numpy()], len(order) + 1
                labels, open_ = [ids], np.ones(len(ids), bool)
                for k in range(1, LONGEST):
                    open_ = open_ & _ahead(on, k - 1)
                    labels.append(np.where(open_, _ahead(ids, k), 0))
                head, tail = (lang * n + labels[0]) * n + labels[1], labels[2] * n + labels[3]
                by = np.lexsort((tail, head))
                head, tail = head[by], tail[by]
                at = np.flatnonzero(np.r_[True, (head[1:] != head[:-1]) | (tail[1:] != tail[:-1])])
                weight = np.diff(np.r_[at, len(head)])
                words = held.dictionary.take(pa.array(order)).cast(pa.string())
                taken = [words.take(pa.array(x[by[at]] - 1, mask=x[by[at]] == 0)) for x in labels]
                yield pa.RecordBatch.from_arrays([names.take(pa.array(lang[by[at]])), *taken, pa.array(weight)], schema=_WINDOWS)

    return run


_STATES = pa.schema([("lang", pa.string()), ("phrase", pa.string()), ("words", pa.int32()), ("f", pa.int64())])


def _states(least: int):
    """Of paths in order the states with their weights: each common prefix with the sum of its range.

    States below ``least`` go, but for those at the ends of a batch, whose ranges may go on in the
    next: their sums are parts, and are added up afterwards.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            new = np.zeros(batch.num_rows, bool)
            new[0] = True
            weight, phrase = batch.column("weight").to_numpy(), None
            for k, name in enumerate(["lang", *WORDS]):
                c = batch.column(name).fill_null("")
                new[1:] |= pc.not_equal(c.slice(1), c.slice(0, len(c) - 1)).to_numpy(zero_copy_only=False)
                if not k:
                    continue
                phrase = c if phrase is None else pc.binary_join_element_wise(phrase, c, " ")
                at = np.flatnonzero(new)
                total = np.add.reduceat(weight, at)
                keep = total >= least
                keep[[0, -1]] = True
                keep &= pc.not_equal(c.take(pa.array(at)), "").to_numpy(zero_copy_only=False)
                at, total = pa.array(at[keep]), total[keep]
                if len(at):
                    yield pa.RecordBatch.from_arrays([batch.column("lang").take(at), phrase.take(at), pa.array(np.full(len(at), k, np.int32)), pa.array(total)], schema=_STATES)

    return run


# --- on Spark ------------------------------------------------------------------


def _part(words: Column, start, length) -> Column:
    return F.array_join(F.slice(words, start, length), " ")


def count_phrases(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", least: int = LEAST) -> tuple[DataFrame, DataFrame]:
    """``lang, phrase, words, f`` of all phrases of up to ``LONGEST`` words with ``least`` occurrences or
    more, and ``lang, n``, the number of words."""
    spark = docs.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    texts = docs.select(F.coalesce(F.col(f"`{lang_col}`").cast("string"), F.lit("und")).alias("lang"), F.col(f"`{text_col}`").alias("text")).where("text IS NOT NULL")
    raw, bits = frequent_pairs(texts, least)
    shared = spark.sparkContext.broadcast(raw)
    shards = staged(texts.mapInArrow(_windows(shared, bits), ", ".join([f"{c} string" for c in ["lang", *WORDS]] + ["weight long"])), "windows")
    total = staged(shards.groupBy("lang").agg(F.sum("weight").alias("n")), "words")
    union = shards.repartitionByRange(parts, "lang", *WORDS).sortWithinPartitions("lang", *WORDS)
    states = union.mapInArrow(_states(least), "lang string, phrase string, words int, f long")
    found = staged(states.groupBy("lang", "phrase", "words").agg(F.sum("f").alias("f")).where(F.col("f") >= least), "phrases")
    discard(shards)
    shared.unpersist()
    return found, total


def collocations(docs: DataFrame, *, text_col: str = "text", lang_col: str = "lang", least: int = LEAST, most: int = REPORTED) -> DataFrame:
    """``lang, rank, phrase, a, l, r, n, score``: the first ``most`` phrases of each language.

    Texts are cut at ``.,;:!?`` and line breaks, words at blanks and tabs; A-Z are lower-cased. A
    phrase of two to four words with ``a`` of ``least`` or more occurrences is cut in two where
    floor(2000000 * a / (l + r)) is least (then at the first such place), ``l`` and ``r`` being the
    counts of the two parts. Phrases inside a longer one with at least 80 % of their count are left out.
    Ties in rank go to the larger ``a``, then to the phrase that comes first in bytes. Counts are
    exact: 64-bit hashes only decide which windows are followed further, never against a phrase.

    Null texts count as empty, a null language as ``und``; repeated rows count again. Texts without
    frequent phrases and empty tables give no rows. Other columns are not read.
    """
    found, total = count_phrases(docs, text_col=text_col, lang_col=lang_col, least=least)
    words = F.split("phrase", " ")
    longer = found.where("words > 2").select("lang", "f", "words", words.alias("w"))
    sub = longer.select("lang", "f", "words", "w", F.explode(F.sequence(F.lit(2), F.col("words") - 1)).alias("size"))
    sub = sub.select("lang", "f", "w", "size", F.explode(F.sequence(F.lit(1), F.col("words") - F.col("size") + 1)).alias("at"))
    held = sub.groupBy("lang", _part(F.col("w"), F.col("at"), F.col("size")).alias("phrase")).agg(F.max("f").alias("within"))
    wide = F.coalesce("within", F.lit(0)).cast("decimal(19,0)") * 100
    own = found.where("words > 1").join(held, ["lang", "phrase"], "left").where(wide < F.col("f").cast("decimal(19,0)") * SHARE)
    cut = own.select("lang", "phrase", F.col("f").alias("a"), words.alias("w"), F.explode(F.sequence(F.lit(1), F.col("words") - 1)).alias("k"))
    cut = cut.select("lang", "phrase", "a", "k", _part(F.col("w"), F.lit(1), F.col("k")).alias("left"), _part(F.col("w"), F.col("k") + 1, F.size("w") - F.col("k")).alias("right"))
    counts = found.select("lang", "phrase", "f")
    both = cut.join(counts.select("lang", F.col("phrase").alias("left"), F.col("f").alias("l")), ["lang", "left"]).join(counts.select("lang", F.col("phrase").alias("right"), F.col("f").alias("r")), ["lang", "right"])
    scored = both.withColumn("score", F.expr("(cast(2000000 as decimal(7,0)) * cast(a as decimal(19,0))) div (cast(l as decimal(19,0)) + cast(r as decimal(19,0)))").cast("long"))
    best = scored.groupBy("lang", "phrase", "a").agg(F.min(F.struct("score", "k", "l", "r")).alias("m")).select("lang", "phrase", "a", "m.score", "m.l", "m.r")
    rank = F.row_number().over(Window.partitionBy("lang").orderBy(F.desc("score"), F.desc("a"), "phrase"))
    top = best.withColumn("rank", rank).where(F.col("rank") <= most)
    return top.join(total, "lang").select("lang", F.col("rank").cast("long").alias("rank"), "phrase", "a", "l", "r", "n", "score")


def op12_phrases(spark, sf_dir: str) -> DataFrame:
    return collocations(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP12_SQL = r"""
WITH p AS (SELECT coalesce(lang, 'und') AS lang, doc_id, unnest(regexp_split_to_array(translate(text, 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[.,;:!?\x0A-\x0D]')) AS piece FROM documents),
w AS (SELECT lang, regexp_extract_all(piece, '[^\x20\x09]+') AS w FROM p),
t AS (SELECT lang, sum(len(w))::BIGINT AS n FROM w GROUP BY lang),
g AS (SELECT lang, words, unnest(list_transform(range(1, len(w) - words + 2), lambda i: array_to_string(w[i:i + words - 1], ' '))) AS phrase FROM w, (SELECT unnest([1, 2, 3, 4]) AS words) WHERE len(w) >= words),
f AS (SELECT lang, words, phrase, count(*) AS f FROM g GROUP BY ALL HAVING count(*) >= 30),
s AS (SELECT lang, f, string_split(phrase, ' ') AS w, words, unnest(range(2, words)) AS size FROM f WHERE words > 2),
h AS (SELECT lang, f, w, size, unnest(range(1, words - size + 2)) AS pos FROM s),
i AS (SELECT lang, array_to_string(w[pos:pos + size - 1], ' ') AS phrase, max(f) AS within FROM h GROUP BY ALL),
o AS (SELECT f.lang, f.phrase, f AS a, string_split(f.phrase, ' ') AS w, unnest(range(1, words)) AS k FROM f LEFT JOIN i ON i.lang = f.lang AND i.phrase = f.phrase WHERE words > 1 AND 100::HUGEINT * coalesce(within, 0) < 80::HUGEINT * f),
c AS (SELECT o.lang, o.phrase, a, k, x.f AS l, y.f AS r, ((2000000::HUGEINT * a) // (x.f + y.f))::BIGINT AS score FROM o JOIN f x ON x.lang = o.lang AND x.phrase = array_to_string(w[1:k], ' ') JOIN f y ON y.lang = o.lang AND y.phrase = array_to_string(w[k + 1:], ' ')),
b AS (SELECT lang, phrase, a, min({'score': score, 'k': k, 'l': l, 'r': r}) AS m FROM c GROUP BY ALL),
z AS (SELECT lang, row_number() OVER (PARTITION BY lang ORDER BY (m).score DESC, a DESC, phrase) AS rank, phrase, a, (m).l AS l, (m).r AS r, (m).score AS score FROM b)
SELECT z.lang, rank, phrase, a, l, r, n, score FROM z JOIN t ON t.lang = z.lang WHERE rank <= 2000
"""
