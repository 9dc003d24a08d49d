"""Substring dedup: every stretch made of strings of a fixed length that start in several places."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, gram_hashes, minimizers, powers, refuse_names, signed, staged, text_bytes

LENGTH = 400
REMEMBERED = 200_000
CHUNK = 1 << 20
IN_BLOCK = 512  # excerpts that one task compares with one reference
ROWS, SIZE = 1 << 16, 1 << 20  # rows, or bytes, of many texts that leave a task together


def seed_length(length: int) -> int:
    """Bytes of the runs by which strings of ``length`` bytes are found."""
    return length - max(1, length * 3 // 20)


# --- in tasks --------------------------------------------------------------


def _batch(schema: pa.Schema, *cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def _new_texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[int, int, np.ndarray]]:
    """Key, tag and bytes of each text, most copies within a task left out."""
    seen: set[tuple[int, int]] = set()
    for batch in batches:
        b, offsets = text_bytes(batch.column(2))
        for r, key in enumerate(zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True)):
            if key in seen:
                continue
            if len(seen) >= REMEMBERED:
                seen.clear()
            seen.add(key)
            yield *key, b[offsets[r] : offsets[r + 1]]


def chosen(b: np.ndarray, length: int, chunk: int = CHUNK) -> tuple[np.ndarray, np.ndarray]:
    """Hash and place of the runs of ``seed_length`` bytes with the smallest hash of some string of ``length`` bytes."""
    k = seed_length(length)
    hashes, places = [np.zeros(0, np.uint64)], [np.zeros(0, np.int64)]
    for lo in range(0, len(b) - length + 1, chunk):
        part = b[lo : lo + chunk + length - 1]
        grams = gram_hashes(part, k)
        at = minimizers(grams, np.zeros(len(part), np.int8), length - k + 1)
        hashes.append(grams[at])
        places.append(at + lo)
    place, first = np.unique(np.concatenate(places), return_index=True)
    return np.concatenate(hashes)[first], place


def _seeds(length: int):
    """The seeds of each text, and whether one occurs in it again."""
    out = pa.schema([("seed", pa.int64()), ("key", pa.int64()), ("at", pa.int32()), ("again", pa.bool_())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, size = [], 0
        for key, _, b in _new_texts(batches):
            value, at = chosen(b, length)
            if len(at):
                _, back, times = np.unique(value, return_inverse=True, return_counts=True)
                held.append((signed(value), np.full(len(at), key), at.astype(np.int32), times[back] > 1))
                size += len(at)
            if size >= ROWS:
                yield _batch(out, *map(np.concatenate, zip(*held, strict=True)))
                held, size = [], 0
        if held:
            yield _batch(out, *map(np.concatenate, zip(*held, strict=True)))

    return run


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Key, tag, text compressed for the shuffle, and its size."""
    out = pa.schema([("key", pa.int64()), ("tag", pa.int64()), ("z", pa.binary()), ("size", pa.int64())])
    held, size = [], 0
    for key, tag, b in _new_texts(batches):
        held.append((key, tag, pa.compress(b.tobytes(), "zstd", asbytes=True), len(b)))
        size += len(held[-1][2])
        if size >= SIZE:
            yield _batch(out, *zip(*held, strict=True))
            held, size = [], 0
    if held:
        yield _batch(out, *zip(*held, strict=True))


def _unpacked(z: pa.Scalar, size: pa.Scalar) -> np.ndarray:
    return np.frombuffer(pa.decompress(z.as_buffer(), size.as_py(), "zstd"), np.uint8)


def _excerpts(length: int, all_own: bool):
    """For each text and each reference of its seeds the bytes around them. A text's own first
    place of a seed needs no comparison, unless ``all_own``."""
    out = pa.schema([("ref", pa.int64()), ("key", pa.int64()), ("tag", pa.int64()), ("base", pa.int32()), ("raw", pa.binary()), ("at", pa.list_(pa.int32()))])
    k = seed_length(length)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rows, size = [], 0
        for batch in batches:
            for r in range(batch.num_rows):
                key, tag, b, hits = batch.column(0)[r].as_py(), batch.column(1)[r].as_py(), _unpacked(batch.column(2)[r], batch.column(3)[r]), batch.column(4)[r].values
                value, ref, at = (hits.field(c).to_numpy() for c in range(3))
                grams = signed(gram_hashes(b, k))  # hits of another text of this key are left out
                mine = (at < len(grams)) & (grams[np.minimum(at, len(grams) - 1)] == value) if len(grams) else np.zeros(len(at), bool)
                order = np.lexsort((at, ref))
                order = order[mine[order]]
                value, ref, at = value[order], ref[order], at[order]
                if not all_own:
                    own = np.flatnonzero(ref == key)
                    _, first = np.unique(value[own], return_index=True)
                    value, ref, at = (np.delete(c, own[first]) for c in (value, ref, at))
                cut = np.flatnonzero(np.r_[True, (ref[1:] != ref[:-1]) | (np.diff(at) > length)])
                for i, j in zip(cut.tolist(), [*cut[1:].tolist(), len(at)], strict=True) if len(at) else ():
                    lo, hi = max(0, int(at[i]) - length + k), min(len(b), int(at[j - 1]) + length)
                    rows.append((int(ref[i]), key, tag, lo, b[lo:hi].tobytes(), at[i:j] - lo))
                    size += hi - lo
                if size >= SIZE:
                    yield _batch(out, *zip(*rows, strict=True))
                    rows, size = [], 0
        if rows:
            yield _batch(out, *zip(*rows, strict=True))

    return run


class Bytes:
    """Texts end to end, with prefix sums to compare stretches by."""

    def __init__(self, raws: list[np.ndarray]):
        self.raw = np.concatenate(raws)
        self.edge = np.cumsum([0, *map(len, raws)])
        self.total = np.zeros(len(self.raw) + 1, np.uint64)
        np.cumsum((self.raw.astype(np.uint64) + np.uint64(1)) * powers(len(self.raw) + 1)[0][: len(self.raw)], out=self.total[1:])

    def row(self, at: np.ndarray) -> np.ndarray:
        return np.searchsorted(self.edge, at, "right") - 1


class Reference(Bytes):
    """The texts of one key, with the first place of each seed."""

    def __init__(self, raws: list[np.ndarray], tags: list[int], length: int):
        super().__init__(raws)
        self.tags = tags
        found = [chosen(b, length) for b in raws]
        self.value, first = np.unique(np.concatenate([v for v, _ in found]), return_index=True)
        self.place = np.concatenate([p + e for (_, p), e in zip(found, self.edge[:-1], strict=True)])[first]


def common(x: Bytes, i: np.ndarray, y: Bytes, j: np.ndarray, most: np.ndarray, back: bool) -> np.ndarray:
    """How many bytes, ``most`` at most, are equal from place i of x and j of y on, or before them:
    by bisection over prefix sums, for all pairs of places at once."""
    inverse = powers(max(len(x.total), len(y.total)))[1]
    n = np.zeros(len(i), np.int64)
    step = 1 << int(most.max(initial=1)).bit_length()
    while step := step >> 1:
        to = n + step
        fits = np.flatnonzero(to <= most)
        p, q, t = i[fits], j[fits], to[fits]
        if back:
            p, q = p - t, q - t
        same = (x.total[p + t] - x.total[p]) * inverse[p] == (y.total[q + t] - y.total[q]) * inverse[q]
        n[fits[same]] = t[same]
    return n


def compare(text: Bytes, at: np.ndarray, ref: Reference, length: int) -> tuple[list[tuple[int, int, int]], np.ndarray]:
    """Stretches ``start, bytes, start in the reference`` of ``length`` bytes or more that the
    texts have in common with the reference through the seeds at ``at``, and the strings to check
    elsewhere.

    Stretches are found by sums and then compared byte by byte, and cut where sums were equal by accident.
    A string belongs to the first seed of smallest hash in it. If the stretch through that seed
    doesn't hold the string, no occurrence of it anywhere is in the reference at this place.
    """
    k = seed_length(length)
    reach = length - k + 1
    hashes = gram_hashes(text.raw, k)
    place = ref.place[np.searchsorted(ref.value, hashes[at])]
    row, ref_row = text.row(at), ref.row(place)
    first, last = text.edge[row], text.edge[row + 1]
    low = at - common(text, at, ref, place, np.minimum(at - first, place - ref.edge[ref_row]), True)
    high = at + common(text, at, ref, place, np.minimum(last - at, ref.edge[ref_row + 1] - place), False)
    shift, long = place - at, np.flatnonzero(high - low >= length)
    one = np.stack([low[long], high[long], shift[long]])  # seeds of one stretch follow each other
    edge = np.flatnonzero(np.r_[True, (one[:, 1:] != one[:, :-1]).any(0), True]) if len(long) else []
    for p, q in zip(edge[:-1], edge[1:], strict=True):
        i, j, k = one[:, p].tolist()
        if not np.array_equal(text.raw[i:j], ref.raw[i + k : j + k]):  # equal sums by accident: cut at the first difference on either side
            apart = np.flatnonzero(text.raw[i:j] != ref.raw[i + k : j + k]) + i
            for s in long[p:q].tolist():
                low[s], high[s] = max(apart[apart < at[s]], default=i - 1) + 1, min(apart[apart >= at[s]], default=j)
    long = high - low >= length
    found = [(i, j - i, q) for i, j, q in set(zip(low[long].tolist(), high[long].tolist(), (shift + low)[long].tolist(), strict=True))]
    start = at[:, None] + np.arange(1 - reach, 1)
    inside = (start >= first[:, None]) & (start + length <= last[:, None])
    inside &= (start < low[:, None]) | (start + length > high[:, None])
    which, back = np.nonzero(inside)
    loose = [np.zeros(0, np.int64)]
    for lo in range(0, len(which), 1 << 17):
        w, s = which[lo : lo + (1 << 17)], start[which[lo : lo + (1 << 17)], back[lo : lo + (1 << 17)]]
        loose.append(s[s + hashes[s[:, None] + np.arange(reach)].argmin(1) == at[w]])
    return found, np.unique(np.concatenate(loose))


def _compared(length: int):
    """Stretches of the excerpts, and of the reference whose texts they follow (rows without
    ``key``), that both have, and 128 bits of the strings to check."""
    kinds = {"key": pa.int64(), "tag": pa.int64(), "lo": pa.int32(), "hi": pa.int32(), "h1": pa.int64(), "h2": pa.int64()}
    out = pa.schema(list(kinds.items()))
    half = length // 2

    def rows(raws: list[np.ndarray], keys: list[tuple], hits: list[np.ndarray], ref: Reference, ref_key: int) -> Iterator[tuple]:
        text = Bytes(raws)
        at = np.concatenate([h + e for h, e in zip(hits, text.edge[:-1], strict=True)])
        row = text.row(at)
        place = ref.place[np.searchsorted(ref.value, gram_hashes(text.raw, seed_length(length))[at])]
        here = np.array([(k, t) for k, t, _ in keys], np.int64)[row]
        base = np.array([b for *_, b in keys], np.int64)[row]
        there = np.array(ref.tags, np.int64)[ref.row(place)]
        same = (here[:, 0] == ref_key) & (here[:, 1] == there) & (base + at - text.edge[row] == place - ref.edge[ref.row(place)])
        found, loose = compare(text, at[~same], ref, length)
        for s, n, q in found:
            r, t = int(text.row(np.array([s]))[0]), int(ref.row(np.array([q]))[0])
            key, tag, b = keys[r]
            lo, to = b + s - int(text.edge[r]), q - int(ref.edge[t])
            yield key, tag, lo, lo + n, None, None
            yield ref_key, ref.tags[t], to, to + n, None, None
        if len(loose):
            row = text.row(loose)
            h1, h2 = signed(gram_hashes(text.raw, half))[loose], signed(gram_hashes(text.raw, length - half))[loose + half]
            for s, r, x, y in zip((loose - text.edge[row]).tolist(), row.tolist(), h1.tolist(), h2.tolist(), strict=True):
                key, tag, b = keys[r]
                yield key, tag, b + s, b + s + length, x, y

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchors: tuple[list, list] = ([], [])
        ref, current = None, None
        for batch in batches:
            found: list[tuple] = []
            held: tuple[list, list, list] = ([], [], [])
            size = 0
            for r, (ref_key, salt, *key) in enumerate(zip(*(batch.column(c).to_pylist() for c in range(5)), strict=True)):
                if held[0] and (size > 1 << 19 or current != (ref_key, salt)):
                    found += rows(*held, ref, current[0])
                    held, size = ([], [], []), 0
                if key[0] is None:
                    if current != (ref_key, salt):
                        anchors, ref, current = ([], []), None, (ref_key, salt)
                    anchors[0].append(_unpacked(batch.column("z")[r], batch.column("size")[r]))
                    anchors[1].append(key[1])
                    continue
                if ref is None:
                    ref = Reference(*anchors, length)
                raw = np.frombuffer(batch.column("z")[r].as_buffer(), np.uint8)
                for to, x in zip(held, (raw, key, batch.column("at")[r].values.to_numpy().astype(np.int64)), strict=True):
                    to.append(x)
                size += len(raw)
                if len(found) > 1 << 18:
                    yield _batch(out, *zip(*found, strict=True))
                    found = []
            if held[0]:
                found += rows(*held, ref, current[0])
            if found:
                yield _batch(out, *zip(*found, strict=True))

    return run


def _fields(list_scalar: pa.Scalar) -> list[np.ndarray]:
    """Columns of an array of structs whose first field is a place, sorted by it."""
    v = list_scalar.values
    cols = [v.field(i).to_numpy() for i in range(v.type.num_fields)]
    order = np.argsort(cols[0], kind="stable")
    return [c[order] for c in cols]


# --- on Spark --------------------------------------------------------------


def repeated_stretches(texts: DataFrame, length: int = LENGTH) -> DataFrame:
    """``key, tag, lo, hi`` of ``key, tag, text`` (both keys together tell texts apart, each of which
    may be in any number of rows): stretches made of strings of ``length`` bytes that start in
    several places of the distinct texts.

    1. Any ``length`` bytes hold the smallest of their shorter runs, the seed, wherever they occur.
       Of the seeds that occur twice, the reference is the text of smallest key, at its first place.
    2. Every text is compared with its references, in blocks of a reference and about ``IN_BLOCK``
       excerpts: what both have around a seed, if it is long enough, is repeated in both.
    3. Strings that hold a seed but reach beyond what the reference has are looked up by 128 bits
       among the same strings of all texts, which is complete: where a string isn't in its
       reference at the seed, none of its occurrences is.

    What a seed or string has in common is a partial aggregate, joined back as one row a key.
    """
    spark = texts.sparkSession
    n = int(spark.conf.get("spark.sql.shuffle.partitions"))
    long_ones = texts.where(F.octet_length("text") >= length).select("key", "tag", "text")
    seeds = staged(long_ones.mapInArrow(_seeds(length), "seed long, key long, at int, again boolean"), "all-seeds")
    ends = seeds.groupBy("seed").agg(F.min("key").alias("ref"), F.max("key").alias("hi"), F.max("again").alias("again"))
    shared = staged(ends.where("ref < hi OR again").select("seed", "ref"), "seeds")
    hits = seeds.join(shared, "seed").groupBy("key").agg(F.collect_set(F.struct("seed", "ref", "at")).alias("hits"))
    hits = staged(hits, "hits")
    discard(seeds, shared)
    keys = hits.select("key").unionByName(hits.select(F.explode("hits.ref").alias("key"))).distinct()
    once = long_ones.mapInArrow(_packed, "key long, tag long, z binary, size long").join(keys, "key", "left_semi")
    near = staged(once.groupBy("key", "tag").agg(F.first("z").alias("z"), F.first("size").alias("size")), "texts")
    clash = not near.groupBy("key").count().where("count > 1").isEmpty()
    sent = near.join(hits, "key").select("key", "tag", "z", "size", "hits").mapInArrow(_excerpts(length, clash), "ref long, key long, tag long, base int, raw binary, at array<int>")
    sent = staged(sent, "excerpts")
    discard(hits)

    blocks = staged(sent.groupBy("ref").agg(F.ceil(F.count("*") / IN_BLOCK).alias("blocks")), "references")
    salted = sent.join(blocks, "ref").withColumn("salt", F.pmod(F.xxhash64("key", "base"), F.col("blocks")))
    salted = salted.select("ref", "salt", "key", "tag", "base", F.col("raw").alias("z"), F.lit(0).cast("long").alias("size"), "at")
    anchors = near.withColumnRenamed("key", "ref").join(blocks, "ref").withColumn("salt", F.explode(F.sequence(F.lit(0).cast("long"), F.col("blocks") - 1)))
    anchors = anchors.select("ref", "salt", F.lit(None).cast("long").alias("key"), "tag", F.lit(0).alias("base"), "z", "size", F.array().cast("array<int>").alias("at"))
    in_turn = anchors.unionByName(salted).repartition(n, "ref", "salt").sortWithinPartitions("ref", "salt", F.col("key").asc_nulls_first(), "tag", "base")
    found = in_turn.mapInArrow(_compared(length), "key long, tag long, lo int, hi int, h1 long, h2 long")
    found = staged(found, "compared")
    discard(near, sent, blocks)

    loose = found.where("h1 IS NOT NULL")
    place = F.xxhash64("key", "tag", "lo")
    two = loose.groupBy("h1", "h2").agg(F.min(place).alias("p"), F.max(place).alias("q")).where("p <> q").select("h1", "h2")
    two = staged(two, "twice")
    marks = found.where("h1 IS NULL").drop("h1", "h2").unionByName(loose.join(two, ["h1", "h2"]).drop("h1", "h2"))
    marks = staged(marks.groupBy("key", "tag", "lo").agg(F.max("hi").alias("hi")), "marks")
    discard(found, two)
    return marks


def _pack_column(at: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b, offsets = text_bytes(batch.column(at))
            valid = batch.column(at).is_valid().to_pylist()
            z = [pa.compress(b[i:j].tobytes(), "zstd", asbytes=True) if ok else None for i, j, ok in zip(offsets[:-1], offsets[1:], valid, strict=True)]
            names = [*batch.schema.names, "sa_size"]
            cols = [*batch.columns[:at], pa.array(z, pa.binary()), *batch.columns[at + 1 :], pa.array(np.diff(offsets))]
            yield pa.RecordBatch.from_arrays(cols, names=names)

    return run


def _cut(at: int, length: int):
    spans_type = pa.list_(pa.struct([("start", pa.int64()), ("size", pa.int64())]))
    names = ["sa_bytes", "sa_spans", "sa_kept"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            z, size, marks = batch.column(at), batch.column(batch.num_columns - 2), batch.column(batch.num_columns - 1)
            texts, spans, kept = [], [], []
            for r in range(batch.num_rows):
                if not z[r].is_valid:
                    texts.append(None)
                    spans.append([])
                    kept.append(b"")
                    continue
                b = _unpacked(z[r], size[r])
                texts.append(b.tobytes())
                if not marks[r].is_valid or len(b) < length:
                    spans.append([])
                    kept.append(texts[-1])
                    continue
                lo, hi = _fields(marks[r])
                step = np.zeros(len(b) + 1, np.int32)
                np.add.at(step, lo, 1)
                np.add.at(step, np.minimum(hi, len(b)), -1)
                gone = np.cumsum(step) > 0
                edges = np.flatnonzero(np.diff(gone.astype(np.int8), prepend=0)).reshape(-1, 2)
                spans.append([{"start": i, "size": j - i} for i, j in edges.tolist()])
                kept.append(b[~gone[:-1]].tobytes())
            new = [pa.array(np.asarray(size)), pa.array(spans, spans_type), pa.array(kept, pa.binary())]
            cols = [*batch.columns[:at], pa.array(texts, pa.binary()).cast(pa.string()), *batch.columns[at + 1 : -2], *new]
            yield pa.RecordBatch.from_arrays(cols, names=[*batch.schema.names[:-2], *names])

    return run


ADDED = ["sa_bytes", "sa_spans", "sa_kept"]


def cut_repeats(docs: DataFrame, *, text_col: str = "text", length: int = LENGTH) -> DataFrame:
    """``docs`` with ``sa_bytes`` (size of the text), ``sa_spans`` (maximal stretches removed) and
    ``sa_kept`` (the bytes left, which need not be valid UTF-8).

    A byte goes if a string of ``length`` bytes that covers it also starts anywhere else: in another
    row, or elsewhere in the same text; overlaps count, and all is judged on the input. ``length``
    is 12 at least. Equal texts of ``length`` bytes or more are repeats of each other from start to
    end, so such rows lose everything and are compared once.

    Null and empty texts have no bytes. Repeated rows are copies. Other columns pass through, but
    a column named ``sa_...`` raises ``ValueError``. No rows give no rows. Texts are told apart by 128
    bits, as are the strings at the ends of stretches; stretches are compared byte by byte.
    """
    if clash := [c for c in docs.columns if c.lower().startswith("sa_")]:
        refuse_names(docs.columns, *clash)
    plain = F.coalesce(F.col(f"`{text_col}`"), F.lit(""))
    keyed = docs.withColumn("sa_key", F.xxhash64(plain)).withColumn("sa_tag", F.xxhash64(F.lit("tag"), F.reverse(plain)))
    texts = keyed.select(F.col("sa_key").alias("key"), F.col("sa_tag").alias("tag"), F.col(f"`{text_col}`").alias("text"))
    copies = texts.groupBy("key", "tag").count().where("count > 1").select("key", "tag", F.lit(0).alias("lo"), F.lit(2**31 - 1).alias("hi"))
    marks = repeated_stretches(texts, length).unionByName(copies)
    marks = marks.groupBy(F.col("key").alias("sa_mark_key"), F.col("tag").alias("sa_mark_tag")).agg(F.collect_list(F.struct("lo", "hi")).alias("sa_marks"))
    at = docs.columns.index(text_col)
    fields = [T.StructField(f.name, T.BinaryType()) if i == at else f for i, f in enumerate(keyed.schema.fields)]
    packed = keyed.mapInArrow(_pack_column(at), T.StructType([*fields, T.StructField("sa_size", T.LongType())]))
    both = packed.join(marks, (F.col("sa_key") == F.col("sa_mark_key")) & (F.col("sa_tag") == F.col("sa_mark_tag")), "left").drop("sa_key", "sa_tag", "sa_mark_key", "sa_mark_tag")
    more = T._parse_datatype_string("sa_bytes long, sa_spans array<struct<start:long,size:long>>, sa_kept binary").fields
    return both.mapInArrow(_cut(at, length), T.StructType([*docs.schema.fields, *more]))


def op6_suffixes(spark, sf_dir: str) -> DataFrame:
    out = cut_repeats(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text"))
    removed = F.aggregate("sa_spans", F.lit(0).cast("long"), lambda n, s: n + s["size"])
    return out.select("doc_id", F.col("sa_bytes").alias("n_bytes"), removed.alias("n_removed"), F.size("sa_spans").cast("long").alias("n_spans"), F.sha2("sa_kept", 256).alias("kept_sha256"))
