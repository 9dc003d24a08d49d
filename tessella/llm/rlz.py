"""Substring dedup by Relative Lempel-Ziv parsing against an index of first occurrences."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, minimizers, pieces, powers, refuse_names, shingle_hashes, signed, staged, text_bytes, word_hashes, word_spans

WORDS = 13
SEED = 8
APART = 64  # words between hits of one reference that are sent to it separately
IN_BLOCK = 512  # excerpts that one task parses against one reference

# --- in tasks --------------------------------------------------------------


def _batch(schema: pa.Schema, *cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def _seeds(window: int, seed: int):
    """The runs of ``seed`` words with the smallest hash of some window."""
    out = pa.schema([("seed", pa.int64()), ("doc_id", pa.int64()), ("at", pa.int32())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            doc_id = batch.column(0).to_numpy()
            b, offsets = text_bytes(batch.column(1))
            for i, j in pieces(offsets):
                part = b[offsets[i] : offsets[j]]
                starts, ends, row = word_spans(part, offsets[i : j + 1] - offsets[i])
                grams = shingle_hashes(word_hashes(part, starts, ends), seed)
                at = minimizers(grams, row, window - seed + 1) if len(grams) > window - seed else np.zeros(0, np.int64)
                if len(at):
                    first = np.searchsorted(row, row[at])
                    yield _batch(out, signed(grams[at]), doc_id[i + row[at]], (at - first).astype(np.int32))

    return run


class Words:
    """The words of some texts end to end: where they are, their hashes, prefix sums to compare
    stretches by, and the seeds' hashes (those across two texts mean nothing)."""

    def __init__(self, raws: list[np.ndarray], seed: int):
        self.raw = np.concatenate(raws)
        offsets = np.cumsum([0, *map(len, raws)])
        self.starts, self.ends, self.row = word_spans(self.raw, offsets)
        self.edge = np.searchsorted(self.row, np.arange(len(raws) + 1))
        self.h = word_hashes(self.raw, self.starts, self.ends)
        self.grams = shingle_hashes(self.h, seed)

    def __len__(self) -> int:
        return len(self.starts)

    def sums(self) -> np.ndarray:
        out = np.zeros(len(self) + 1, np.uint64)
        np.cumsum(self.h * powers(len(self) + 1)[0][: len(self)], out=out[1:])
        return out

    def stretch(self, i: int, j: int) -> bytes:
        return self.raw[self.starts[i] : self.ends[j - 1]].tobytes()

    def window_ids(self, at: np.ndarray, window: int) -> tuple[np.ndarray, np.ndarray]:
        """128 bits of the windows at some places."""
        again = word_hashes(self.raw, self.starts, self.ends, 1)
        return shingle_hashes(self.h, window)[at], shingle_hashes(again, window)[at]


def _tag(raw: np.ndarray) -> int:
    """Tells the texts of rows of equal id apart."""
    import xxhash

    return xxhash.xxh64_intdigest(raw.tobytes()) - (1 << 63)


def _excerpts(window: int, seed: int, all_own: bool):
    """For each document and each reference of its hits the words around them.

    A document's own first place of a seed needs no parse, unless ``all_own``."""
    out = pa.schema([("ref", pa.int64()), ("doc_id", pa.int64()), ("tag", pa.int64()), ("base", pa.int32()), ("raw", pa.binary()), ("at", pa.list_(pa.int32()))])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b, offsets = text_bytes(batch.column(1))
            for r, doc_id in enumerate(batch.column(0).to_pylist()):
                raw = b[offsets[r] : offsets[r + 1]]
                text = Words([raw], seed)
                hits = batch.column(2)[r].values
                value, ref, at = (hits.field(c).to_numpy() for c in range(3))
                mine = (at < len(text.grams)) & (signed(text.grams)[np.minimum(at, len(text.grams) - 1)] == value) if len(text.grams) else np.zeros(len(at), bool)
                order = np.lexsort((at, ref))
                order = order[mine[order]]
                value, ref, at = value[order], ref[order], at[order]
                if not all_own:
                    own = np.flatnonzero(ref == doc_id)
                    _, first = np.unique(value[own], return_index=True)
                    value, ref, at = (np.delete(c, own[first]) for c in (value, ref, at))
                if not len(at):
                    continue
                cut = np.flatnonzero(np.r_[True, (ref[1:] != ref[:-1]) | (at[1:] - at[:-1] > APART)])
                rows = []
                for i, j in zip(cut.tolist(), [*cut[1:].tolist(), len(at)], strict=True):
                    lo, hi = max(0, int(at[i]) - window + seed), min(len(text), int(at[j - 1]) + window)
                    rows.append((int(ref[i]), doc_id, _tag(raw), lo, raw[text.starts[lo] : text.ends[hi - 1]].tobytes(), at[i:j] - lo))
                yield _batch(out, *zip(*rows, strict=True))

    return run


class Reference(Words):
    """The texts of one document id, with the first place of each seed."""

    def __init__(self, raws: list[np.ndarray], window: int, seed: int):
        super().__init__(raws, seed)
        self.window, self.seed = window, seed
        at = minimizers(self.grams, self.row, window - seed + 1)
        self.value, first = np.unique(self.grams[at], return_index=True)
        self.place, self.total = at[first], self.sums()


def _common(a: np.ndarray, i: np.ndarray, b: np.ndarray, j: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
    """How many words, ``most`` at most, are equal from place i of one text and j of another on, or
    before them: by bisection over prefix sums, for all pairs of places at once."""
    inverse = powers(max(len(a), len(b)))[1]
    n = np.zeros(len(i), np.int64)
    step = 1 << int(most.max(initial=1)).bit_length()
    while step := step >> 1:
        to = n + step
        fits = np.flatnonzero(to <= most)
        p, q, t = i[fits], j[fits], to[fits]
        if back:
            p, q = p - t, q - t
        same = (a[p + t] - a[p]) * inverse[p] == (b[q + t] - b[q]) * inverse[q]
        n[fits[same]] = t[same]
    return n


def parse(text: Words, at: np.ndarray, ref: Reference) -> tuple[list[tuple[int, int, int]], np.ndarray]:
    """Greedy factors ``start, words, start in the reference`` through the seeds at ``at``, and the
    windows to check elsewhere; places count from the first of the texts.

    From a seed a factor goes on, in both directions, as long as the text and the reference have
    the same words; seeds that it meets on its way are of the same factor. A window
    belongs to the first seed of smallest hash in it. If the factor through that seed doesn't
    hold the window, it crosses the factor's boundary, and no occurrence of the window anywhere
    is in the reference at this place: such windows are returned. Long factors are compared byte
    by byte, or word by word where the space between words differs, and cut at the first difference.
    """
    place = ref.place[np.searchsorted(ref.value, text.grams[at])]
    first, last = text.edge[text.row[at]], text.edge[text.row[at] + 1]
    sums = text.sums()
    low = at - _common(sums, at, ref.total, place, np.minimum(at - first, place - ref.edge[ref.row[place]]), True)
    high = at + _common(sums, at, ref.total, place, np.minimum(last - at, ref.edge[ref.row[place] + 1] - place), False)
    shift, long = place - at, np.flatnonzero(high - low >= ref.window)
    one = np.stack([low[long], high[long], shift[long]])  # seeds of one factor follow each other
    edge = np.flatnonzero(np.r_[True, (one[:, 1:] != one[:, :-1]).any(0), True]) if len(long) else []
    for p, q in zip(edge[:-1], edge[1:], strict=True):
        i, j, k = one[:, p].tolist()
        if text.stretch(i, j) != ref.stretch(i + k, j + k):
            apart = [w for w in range(i, j) if text.stretch(w, w + 1) != ref.stretch(w + k, w + k + 1)]  # none if the space between words differs
            for s in long[p:q].tolist() if apart else ():  # equal sums by accident: cut at the first difference on either side
                low[s], high[s] = max((w + 1 for w in apart if w < at[s]), default=i), min((w for w in apart if w >= at[s]), default=j)
    long = high - low >= ref.window
    factors = [(i, j - i, q) for i, j, q in set(zip(low[long].tolist(), high[long].tolist(), (shift + low)[long].tolist(), strict=True))]
    reach = ref.window - ref.seed + 1
    start = at[:, None] + np.arange(1 - reach, 1)
    inside = (start >= first[:, None]) & (start + ref.window <= last[:, None])
    inside &= (start < low[:, None]) | (start + ref.window > high[:, None])
    which, back = np.nonzero(inside)
    start = start[which, back]
    grams = text.grams[start[:, None] + np.arange(reach)]
    return factors, np.unique(start[start + grams.argmin(1) == at[which]])


def _parsed(window: int, seed: int):
    """Factors and windows to check of the excerpts that follow their reference's texts (rows without ``doc_id``)."""
    names = ["doc_id", "tag", "start", "words", "ref_doc", "ref_start", "h1", "h2"]
    kinds = [pa.int64(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.int32(), pa.int64(), pa.int64()]
    out = pa.schema(list(zip(names, kinds, strict=True)))

    def rows(texts: list[np.ndarray], keys: list[tuple], hits: list[np.ndarray], ref: Reference, ref_doc: int) -> Iterator[tuple]:
        text = Words(texts, seed)
        factors, loose = parse(text, np.concatenate([h + e for h, e in zip(hits, text.edge[:-1], strict=True)]), ref)
        for s, n, q in factors:
            doc_id, tag, base = keys[text.row[s]]
            if ref_doc < doc_id:
                yield doc_id, tag, base + s - int(text.edge[text.row[s]]), n, ref_doc, q - int(ref.edge[ref.row[q]]), None, None
        if len(loose):
            row = text.row[loose]
            for s, r, x, y in zip((loose - text.edge[row]).tolist(), row.tolist(), *(signed(h).tolist() for h in text.window_ids(loose, window)), strict=True):
                doc_id, tag, base = keys[r]
                yield doc_id, tag, base + s, window, None, None, x, y

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: list[np.ndarray] = []
        ref, current = None, None
        for batch in batches:
            found: list[tuple] = []
            held: tuple[list, list, list] = ([], [], [])
            size = 0
            for r, (ref_doc, salt, *key) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True)):
                raw = np.frombuffer(batch.column(5)[r].as_buffer(), np.uint8)
                if held[0] and (size > 1 << 20 or current != (ref_doc, salt)):
                    found += rows(*held, ref, current[0])
                    held, size = ([], [], []), 0
                if key[0] is None:
                    if current != (ref_doc, salt):
                        anchors, ref, current = [], None, (ref_doc, salt)
                    anchors.append(raw.copy())
                    continue
                if ref is None:
                    ref = Reference(anchors, window, seed)
                for to, x in zip(held, (raw, key, batch.column(6)[r].values.to_numpy().astype(np.int64)), strict=True):
                    to.append(x)
                size += len(raw)
            if held[0]:
                found += rows(*held, ref, current[0])
            if found:
                yield _batch(out, *zip(*found, strict=True))

    return run


# --- on Spark --------------------------------------------------------------


def _in_two(rows: DataFrame, keys: list[str], label: str) -> DataFrame:
    """The keys that occur in two documents at least, with ``lo``, the smallest id. What a hot key
    has in common is combined before the shuffle."""
    ends = rows.groupBy(*keys).agg(F.min("doc_id").alias("lo"), F.max("doc_id").alias("hi"))
    return staged(ends.where("lo < hi").select(*keys, "lo"), label)


def duplicate_spans(docs: DataFrame, *, words: int = WORDS, seed: int = SEED) -> DataFrame:
    """``doc_id, spans`` of ``doc_id, text`` (no null ids): spans ``tag, start, words, ref_doc,
    ref_start`` made of windows that start in a document of smaller id.

    1. Any ``words``-word window holds the smallest of its ``seed``-word runs, wherever it occurs.
       Of the runs that two documents share, the reference is the one of smallest id.
    2. Every document is parsed against each of its references, excerpt by excerpt, in blocks of a
       reference and at most about ``IN_BLOCK`` excerpts; the factors of ``words`` words or more are spans.
    3. The windows at the factors' boundaries are looked up by 128 bits among the same windows of
       all documents, which is complete: where a window is not in its reference at the seed, none
       of its occurrences is.

    What a seed or window has in common is a partial aggregate, joined back as one row a key.
    """
    n_parts = int(docs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    repeated = not docs.groupBy("doc_id").count().where("count > 1").isEmpty()
    seeds = docs.mapInArrow(_seeds(words, seed), "seed long, doc_id long, at int")
    shared = _in_two(seeds, ["seed"], "seeds")
    hits = seeds.join(shared, "seed").groupBy("doc_id").agg(F.collect_list(F.struct("seed", "lo", "at")).alias("hits"))
    hits = staged(hits, "hits")
    discard(shared)
    sent = docs.join(hits, "doc_id").select("doc_id", "text", "hits").mapInArrow(_excerpts(words, seed, repeated), "ref long, doc_id long, tag long, base int, raw binary, at array<int>")
    sent = staged(sent, "excerpts")
    discard(hits)

    blocks = staged(sent.groupBy("ref").agg(F.ceil(F.count("*") / IN_BLOCK).alias("blocks")), "references")
    salted = sent.join(blocks, "ref").withColumn("salt", F.pmod(F.xxhash64("doc_id", "base"), F.col("blocks")))
    texts = docs.withColumnRenamed("doc_id", "ref").join(blocks, "ref").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    anchors = texts.select("ref", "salt", F.lit(None).cast("long").alias("doc_id"), F.xxhash64("text").alias("tag"), F.lit(0).alias("base"), F.coalesce("text", F.lit("")).cast("binary").alias("raw"), F.array().cast("array<int>").alias("at"))
    both = anchors.unionByName(salted.select(*anchors.columns))
    in_turn = both.repartition(n_parts, "ref", "salt").sortWithinPartitions("ref", "salt", F.col("doc_id").asc_nulls_first(), "tag", "base")
    found = in_turn.mapInArrow(_parsed(words, seed), "doc_id long, tag long, start int, words int, ref_doc long, ref_start int, h1 long, h2 long")
    found = staged(found, "factors")
    discard(sent, blocks)

    loose = found.where("h1 IS NOT NULL").select("h1", "h2", "doc_id", "tag", "start", "words")
    two = _in_two(loose, ["h1", "h2"], "repeated")
    edge = loose.join(two, ["h1", "h2"]).where("doc_id > lo").select("doc_id", "tag", "start", "words", F.col("lo").alias("ref_doc"), F.lit(None).cast("int").alias("ref_start"))
    span = F.struct("tag", "start", "words", "ref_doc", "ref_start")
    spans = found.where("h1 IS NULL").select(*edge.columns).unionByName(edge).groupBy("doc_id").agg(F.collect_list(span).alias("spans"))
    spans = staged(spans, "spans")
    discard(found, two)
    return spans


FACTORS = "array<struct<start:int,words:int,ref_doc:bigint,ref_start:int>>"


def _apply(text_at: int):
    kind = pa.list_(pa.struct([("start", pa.int32()), ("words", pa.int32()), ("ref_doc", pa.int64()), ("ref_start", pa.int32())]))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = batch.column(batch.num_columns - 1)
            b, offsets = text_bytes(batch.column(text_at))
            n_words, removed, kept, factors = [], [], [], []
            for r in range(batch.num_rows):
                raw = b[offsets[r] : offsets[r + 1]]
                starts, ends, _ = word_spans(raw, np.array([0, len(raw)]))
                found: list[dict] = []
                cover = np.zeros(len(starts) + 1, np.int32)
                if spans[r].is_valid:
                    own = _tag(raw)
                    found = sorted(({k: v for k, v in s.items() if k != "tag"} for s in spans[r].as_py() if s["tag"] == own), key=lambda s: (s["start"], -s["words"]))
                    lo = np.array([s["start"] for s in found], np.int64)
                    np.add.at(cover, lo, 1)
                    np.add.at(cover, lo + np.array([s["words"] for s in found], np.int64), -1)
                keep = np.flatnonzero(np.cumsum(cover[:-1]) == 0)
                data = raw.tobytes()
                kept.append(b" ".join([data[s:e] for s, e in zip(starts[keep].tolist(), ends[keep].tolist(), strict=True)]))
                n_words.append(len(starts))
                removed.append(len(starts) - len(keep))
                factors.append(found)
            new = [pa.array(n_words, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.binary()).cast(pa.string()), pa.array(factors, kind)]
            yield pa.RecordBatch.from_arrays([*batch.columns[:-1], *new], names=[*batch.schema.names[:-1], *ADDED])

    return run


ADDED = ["rlz_words", "rlz_removed", "rlz_kept", "rlz_factors"]


def substring_dedup(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, seed: int = SEED) -> DataFrame:
    """``docs`` with ``rlz_words, rlz_removed, rlz_kept, rlz_factors``.

    A word is removed if it lies in a window of ``words`` words whose sequence also starts in a
    document of smaller id; windows are judged on the input. ``rlz_kept`` is the words left,
    joined by one blank; a text without a removed word keeps its text in ``text_col`` all the
    same, which callers may prefer. ``rlz_factors`` are the parse: start and number of words,
    and the document and place of the reference (no place for a window found at a boundary).

    Ids are whole numbers; others raise ``ValueError``. Null texts have no words. Rows with a null
    id lose nothing and are no reference. Rows of equal id are no reference for each other; equal
    rows are treated alike. Other columns pass through, but a column of an added name raises
    ``ValueError``. No rows give no rows.
    """
    refuse_names(docs.columns, *ADDED, "rlz_id", "rlz_spans")
    if not isinstance(docs.schema[id_col].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)):
        raise ValueError(f"{id_col} must be a whole number")
    some = docs.where(F.col(f"`{id_col}`").isNotNull())
    none = docs.where(F.col(f"`{id_col}`").isNull())
    plain = some.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    found = duplicate_spans(plain, words=words, seed=seed).select(F.col("doc_id").alias("rlz_id"), F.col("spans").alias("rlz_spans"))
    both = some.join(found, F.col(f"`{id_col}`") == F.col("rlz_id"), "left").drop("rlz_id")
    both = both.unionByName(none, allowMissingColumns=True)
    out = T.StructType(list(docs.schema.fields) + list(T._parse_datatype_string(f"rlz_words long, rlz_removed long, rlz_kept string, rlz_factors {FACTORS}").fields))
    return both.mapInArrow(_apply(docs.columns.index(text_col)), out)


def op10_substrings(spark, sf_dir: str) -> DataFrame:
    out = substring_dedup(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    return out.select("doc_id", F.col("rlz_words").alias("n_words"), F.col("rlz_removed").alias("n_removed"), F.sha2(F.col("rlz_kept").cast("binary"), 256).alias("kept_sha256"))


OP10_SQL = r"""
WITH w AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, unnest(range(1, len(w) - 11)) AS i FROM w WHERE len(w) >= 13),
h AS (SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS h FROM s JOIN w USING (doc_id)),
f AS (SELECT h, min(doc_id) AS first FROM h GROUP BY h),
c AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS i FROM h JOIN f USING (h) WHERE first < doc_id),
g AS (SELECT doc_id, list(i) AS gone FROM c GROUP BY doc_id),
k AS (SELECT w.doc_id, len(w)::BIGINT AS n_words, coalesce(len(gone), 0)::BIGINT AS n_removed,
  CASE WHEN gone IS NULL THEN w ELSE list_transform(list_filter(range(1, len(w) + 1), lambda j: NOT list_contains(gone, j)), lambda j: w[j]) END AS kept
  FROM w LEFT JOIN g USING (doc_id))
SELECT doc_id, n_words, n_removed, sha256(array_to_string(kept, ' ')) AS kept_sha256 FROM k
"""
