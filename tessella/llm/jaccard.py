"""Set-similarity join of word shingles with PartEnum signatures, and its connected components."""

from __future__ import annotations

from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import discard, mix, pieces, shingle_hashes, signed, staged, text_bytes, with_key_of_many, word_hashes, word_spans
from .components import components

WORDS, LEAST, OF = 5, 80, 100
THIRDS = 3  # second-level parts of a first-level part, of which a signature leaves one out
REMEMBERED = 200_000
ROUNDS = 2  # of tests against hubs, before what is left apart is paired
HELD_BY_TASK = 1024  # sets that are compared with one other in a task
IN_BLOCK = 2048  # sets of one signature, of several components, that are paired in a task
FIRST = 16  # of a set's signatures, known to all, by which a pair is left to the first that both have

# --- sets ------------------------------------------------------------------


def shingle_sets(b: np.ndarray, offsets: np.ndarray, n: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct hashes of the n-word shingles (A-Z lower-cased) of all texts, sorted within
    each; the n + 1 bounds of the texts' sets; and second hashes, from other word hashes.

    A text of fewer words has one element for all of them; one without words has none.
    """
    low = b + ((b >= 65) & (b <= 90)).astype(np.uint8) * np.uint8(32)
    starts, ends, row = word_spans(low, offsets)
    at = np.searchsorted(row, np.arange(len(offsets)))
    count = np.diff(at)
    hashes = []
    for seed in (0, 1):
        words = word_hashes(low, starts, ends, seed)
        grams = np.zeros(len(words), np.uint64)
        grams[: max(0, len(words) - n + 1)] = shingle_hashes(words, n)
        for r in np.flatnonzero((count > 0) & (count < n)).tolist():
            grams[at[r]] = mix(shingle_hashes(words[at[r] : at[r + 1]], int(count[r])) + np.uint64(count[r]))[0]
        hashes.append(grams)
    place = np.arange(len(row)) - at[row]
    keep = np.flatnonzero((place + n <= count[row]) | ((place == 0) & (count[row] < n)))
    x, y, r = hashes[0][keep], hashes[1][keep], row[keep]
    order = np.lexsort((x, r))
    x, y, r = x[order], y[order], r[order]
    new = np.ones(len(x), bool)
    new[1:] = (x[1:] != x[:-1]) | (r[1:] != r[:-1])
    return x[new], np.searchsorted(r[new], np.arange(len(offsets))), y[new]


def _sums(x: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """Sums modulo 2**64 of the stretches between the edges."""
    total = np.zeros(len(x) + 1, np.uint64)
    np.cumsum(x, out=total[1:])
    return total[edge[1:]] - total[edge[:-1]]


def set_ids(x: np.ndarray, edge: np.ndarray, y: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """128 bits of each set: sums of its elements' scrambled hashes, from independent word hashes."""
    size = np.diff(edge).astype(np.uint64)
    return mix(_sums(mix(x ^ np.uint64(0xA0761D6478BD642F)), edge) ^ size), mix(_sums(mix(y ^ np.uint64(0xE7037ED1A0B428DB)), edge) + size)


def short_ids(hi: np.ndarray, lo: np.ndarray) -> np.ndarray:
    """57 bits of a set's id, above six that are free and a sign of 0: a key to join by, not an identity."""
    return mix(hi ^ lo * np.uint64(0xD6E8FEB86659FD93)) >> np.uint64(7) << np.uint64(6)


# --- signatures ------------------------------------------------------------


@cache
def _bands(least: int, of: int) -> tuple[np.ndarray, np.ndarray]:
    """Sizes low to high, inclusive, such that similar sets lie in one band or in two adjacent ones."""
    low = [1]
    while low[-1] < 1 << 40:
        low.append(int(low[-1] * (of / least) ** 1.5) + 1)
    return np.array(low[:-1]), np.array(low[1:]) - 1


@cache
def _scheme(least: int, of: int) -> tuple[np.ndarray, np.ndarray]:
    """For each band, for pairs whose larger set is in it: the number of first-level parts of the
    domain, and how many of them are sure to hold at most one of the elements that differ.

    Similar sets differ in k elements at most, so in at most k // 2 parts by two or more.
    """
    _, high = _bands(least, of)
    k = 2 * high * (of - least) // (of + least)
    spare = np.where(k > 0, 1 + k // 7, 0)
    return k // 2 * (k > 0) + spare, spare


def signatures(x: np.ndarray, edge: np.ndarray, least: int, of: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """PartEnum signatures of all sets, the set of each, and for each set how many of its own a
    similar set has too, at least.

    In the scheme of its own band, and in that of the next if a similar set may lie there, the
    domain is dealt to first-level parts and each of these to three second-level parts. A
    signature stands for the elements of two of the three. Similar sets differ by at most one
    element in ``spare`` first-level parts or more, and share a signature in each of those.

    Signatures of no element are left out: the t first-level parts that lose one take t from
    ``spare``. Only a set for which nothing would be sure that way has them all; a pair of two such
    sets shares these, and any other pair one of the rest.
    """
    low, high = _bands(least, of)
    parts_of, spare_of = _scheme(least, of)
    n = np.diff(edge)
    own = np.searchsorted(high, n)
    scrambled = mix(x ^ np.uint64(0x8EBC6AF09C88C6E3))
    need = np.full(len(n), 63, np.int64)
    sigs, sets = [], []
    for up in (0, 1):
        band = own + up
        some = (n > 0) & (parts_of[band] > 0)
        if up:
            some &= n * of >= low[band] * least
        parts = parts_of[band] * some
        base = np.append(0, np.cumsum(parts))
        count, held = np.zeros(base[-1] * THIRDS, np.int64), np.zeros(base[-1] * THIRDS, np.uint64)
        of_set = np.repeat(np.arange(len(n)), n)
        mine = np.flatnonzero(some[of_set])
        to = base[of_set[mine]] * THIRDS + ((x[mine] >> np.uint64(20)) % (parts * THIRDS).astype(np.uint64)[of_set[mine]]).astype(np.int64)
        np.add.at(count, to, 1)
        np.add.at(held, to, scrambled[mine])
        count, held = count.reshape(-1, THIRDS), held.reshape(-1, THIRDS)
        count, held = count.sum(1)[:, None] - count, held.sum(1, dtype=np.uint64)[:, None] - held
        whose = np.repeat(np.arange(len(n)), parts)
        lost = np.bincount(whose[(count == 0).any(1)], minlength=len(n))
        sure = spare_of[band] - lost
        need = np.where(some, np.minimum(need, np.maximum(sure, 1)), need)
        given = (count > 0) | (sure < 1)[whose][:, None]
        name = ((band[whose] << 40) + np.arange(base[-1]) - base[whose])[:, None] * THIRDS + np.arange(THIRDS)
        sigs.append(mix(held ^ mix(name.astype(np.uint64)))[given])
        sets.append(np.broadcast_to(whose[:, None], given.shape)[given])
    return np.concatenate(sigs), np.concatenate(sets), need


# --- sketches --------------------------------------------------------------


def sketch(x: np.ndarray) -> bytes:
    """Parities of a set's elements in as many classes as it has elements, a power of two, 64 at least.

    An element in which two sets differ changes one parity, so the sets differ in at least as many
    elements as their sketches in bits; a longer sketch is folded to the size of a shorter one.
    """
    size = max(64, 1 << max(0, int(len(x) - 1).bit_length()))
    odd = np.bincount((x >> np.uint64(9)).astype(np.int64) & (size - 1), minlength=size) & 1
    return np.packbits(odd.astype(np.uint8), bitorder="little").tobytes()


def apart_by(a: list[bytes], b: list[bytes]) -> np.ndarray:
    """Lower bounds of the numbers of elements in which pairs of sets differ, from their sketches."""
    out = np.zeros(len(a), np.int64)
    la, lb = (np.fromiter(map(len, s), np.int64, len(s)) for s in (a, b))
    for p, q in set(zip(la.tolist(), lb.tolist(), strict=True)):
        at = np.flatnonzero((la == p) & (lb == q))
        if max(p, q) > 4 * min(p, q):  # sizes that no similar sets have
            out[at] = 1 << 40
            continue
        m = min(p, q)
        for some in np.array_split(at, max(1, len(at) * max(p, q) >> 22)):
            x, y = (np.frombuffer(b"".join([s[i] for i in some]), "<u8").reshape(len(some), -1, m // 8) for s in (a, b))
            out[some] = np.bitwise_count(np.bitwise_xor.reduce(x, 1) ^ np.bitwise_xor.reduce(y, 1)).sum(1, dtype=np.int64)
    return out


# --- in tasks --------------------------------------------------------------


def _batch(schema: pa.Schema, *cols) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([c if isinstance(c, pa.Array) else pa.array(c, f.type) for c, f in zip(cols, schema, strict=True)], schema=schema)


def _sets(batch: pa.RecordBatch, column: int, n: int) -> Iterator[tuple]:
    """First row, and sets, of the texts piece by piece."""
    b, offsets = text_bytes(batch.column(column))
    for i, j in pieces(offsets):
        yield i, *shingle_sets(b[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], n)


def _sized(n: int):
    out = pa.schema([("doc_id", pa.int64()), ("hi", pa.int64()), ("lo", pa.int64()), ("n_shingles", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, x, edge, y in _sets(batch, 1, n):
                hi, lo = set_ids(x, edge, y)
                yield _batch(out, batch.column(0).slice(i, len(hi)), signed(hi), signed(lo), np.diff(edge))

    return run


def _signed(n: int, least: int, of: int):
    """Each signature with the short id of its set, whose six free bits say how many the set must share."""
    out = pa.schema([("sig", pa.int64()), ("v", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        seen: set[tuple[int, int]] = set()
        for batch in batches:
            for _, x, edge, y in _sets(batch, 0, n):
                hi, lo = set_ids(x, edge, y)
                ids = short_ids(hi, lo)
                fresh = np.zeros(len(ids), bool)
                for i, v in enumerate(zip(hi.tolist(), lo.tolist(), strict=True)):  # most copies within a task are left out
                    if v not in seen:
                        if len(seen) >= REMEMBERED:
                            seen.clear()
                        seen.add(v)
                        fresh[i] = True
                size = np.diff(edge)
                sig, whose, need = signatures(x[np.repeat(fresh, size)], np.append(0, np.cumsum(size[fresh])), least, of)
                v = ids[fresh] | np.minimum(need, 63).astype(np.uint64)
                for lo in range(0, len(sig), 1 << 17):
                    yield _batch(out, signed(sig[lo : lo + (1 << 17)]), signed(v[whose[lo : lo + (1 << 17)]]))

    return run


def _shared(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of rows sorted by ``sig, v`` the distinct ones whose signature occurs with another ``v``.
    One row is carried over from batch to batch."""
    out = pa.schema([("sig", pa.int64()), ("v", pa.int64())])
    last, due = None, False  # the last row, and whether it has still to be given out
    for batch in batches:
        sig, v = (batch.column(i).to_numpy() for i in (0, 1))
        if last is not None:
            sig, v = np.append(last[0], sig), np.append(last[1], v)
        if not len(sig):
            continue
        new = np.r_[True, (sig[1:] != sig[:-1]) | (v[1:] != v[:-1])]
        sig, v = sig[new], v[new]
        same = sig[1:] == sig[:-1]
        keep = np.r_[False, same] | np.r_[same, False]
        if last is not None and not due:
            keep[0] = False
        open_ = len(sig) == 1 and (last is None or due)
        due = open_ or (len(sig) > 1 and not keep[-1])
        last = sig[-1:], v[-1:]
        if keep.any():
            yield _batch(out, sig[keep], v[keep])


def _described(n: int, made):
    """Ids, size, sketch and compressed text of each set."""
    out = pa.schema([("hi", pa.int64()), ("lo", pa.int64()), ("n", pa.int64()), ("sketch", pa.binary()), ("z", pa.binary()), ("size", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b, offsets = text_bytes(batch.column(0))
            for i, x, edge, y in _sets(batch, 0, n):
                hi, lo = set_ids(x, edge, y)
                raw = [b[offsets[r] : offsets[r + 1]].tobytes() for r in range(i, i + len(hi))]
                yield _batch(out, signed(hi), signed(lo), np.diff(edge), [made(x[p:q]) for p, q in zip(edge[:-1], edge[1:], strict=True)], [pa.compress(t, "zstd", asbytes=True) for t in raw], [len(t) for t in raw])

    return run


def _near(least: int, of: int):
    """The pairs whose sketches and sizes do not rule out a link."""
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b, x, y, n, m = (batch.column(c) for c in ("a", "b", "x", "y", "n", "m"))
            most = (n.to_numpy() + m.to_numpy()) * (of - least) // (of + least)
            at = np.flatnonzero((np.minimum(n, m) * of >= np.maximum(n, m) * least) & (apart_by(x.to_pylist(), y.to_pylist()) <= most))
            if len(at):
                yield _batch(out, a.take(pa.array(at)), b.take(pa.array(at)))

    return run


def _linked(n: int, least: int, of: int):
    """Of the sets that follow an anchor (the row without ``b``), those linked to it, by comparing all elements."""
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def elements(z, size) -> np.ndarray:
        raw = np.frombuffer(pa.decompress(z.as_buffer(), size.as_py(), "zstd"), np.uint8)
        return shingle_sets(raw, np.array([0, len(raw)]), n)[0]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        anchor = None
        for batch in batches:
            found = []
            a, b = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for i, z, size in zip(range(len(a)), batch.column(2), batch.column(3), strict=True):
                x = elements(z, size)
                if b[i] is None:
                    anchor = x
                    continue
                both = len(np.intersect1d(anchor, x, assume_unique=True))
                if both * of >= (len(anchor) + len(x) - both) * least:
                    found.append((a[i], b[i]))
            if found:
                yield _batch(out, *map(list, zip(*found, strict=True)))

    return run


def across(allowed):
    """Of rows sorted by ``sig, i, j`` the pairs of one group and different labels that ``allowed`` lets
    through: called with a group's table, it gives a function of a row and some others, with a score
    (less is nearer) for each that may be linked, and -1 for the rest.

    A pair is left to another group if both rows have that group's signature among their ``first`` ones
    and it is less than their own: of the groups that a pair shares one gives it out, or a few if the
    first signatures of its rows have none in common.

    With ``nearest`` each row of the smaller of two labels is paired with the nearest of the larger
    one alone, so that a row is not paired with every member of a component it belongs to.
    """
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def pairs(held: list[pa.RecordBatch], nearest: bool) -> Iterator[pa.RecordBatch]:
        t = pa.Table.from_batches(held)
        node, label = (t.column(c).to_numpy() for c in ("node", "label"))
        scores = allowed(t)
        sig, lists = held[0].column("sig")[0].as_py(), t.column("first").combine_chunks()
        whose, value = lists.value_parent_indices().to_numpy(), lists.flatten().to_numpy()
        whose, value = whose[value < sig], value[value < sig]
        _, value = np.unique(value, return_inverse=True)
        has = np.zeros((len(node), int(value.max(initial=-1)) + 1), bool)
        has[whose, value] = True
        _, own, size = np.unique(label, return_inverse=True, return_counts=True)
        rank = size[own] * len(size) + own  # labels by size, then by name
        order = np.argsort(rank, kind="stable")
        node, rank, place = node[order], rank[order], np.searchsorted(rank[order], rank[order], "right")
        for x in range(len(node)):
            others = np.arange(place[x], len(node))  # of larger labels
            if not len(others):
                break
            others = others[~has[order[others]][:, has[order[x]]].any(1)]
            if not len(others):
                continue
            score = scores(order[x], order[others])
            others, score = others[score >= 0], score[score >= 0]
            if nearest and len(others):
                by = np.lexsort((others, score, rank[others]))
                others = others[by[np.r_[True, np.diff(rank[others[by]]) != 0]]]
            if len(others):
                yield _batch(out, np.minimum(node[others], node[x]), np.maximum(node[others], node[x]))

    def for_(nearest: bool):
        def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            held, last = [], None
            for batch in batches:
                key = np.column_stack([batch.column(c).to_numpy() for c in ("sig", "i", "j")])
                cut = [0, *(np.flatnonzero((key[1:] != key[:-1]).any(1)) + 1).tolist(), len(key)]
                for i, j in zip(cut[:-1], cut[1:], strict=True):
                    if j > i:
                        if held and last != key[i].tolist():
                            yield from pairs(held, nearest)
                            held = []
                        held.append(batch.slice(i, j - i))
                        last = key[i].tolist()
            if held:
                yield from pairs(held, nearest)

        return run

    return for_


def _parities(least: int, of: int):
    """Scores by parity sketches: the elements in which two sets differ at least."""

    def allowed(t: pa.Table):
        n, sketches = t.column("n").to_numpy(), t.column("sketch").to_pylist()
        length = np.array([len(x) for x in sketches])
        bits = {s: np.frombuffer(b"".join(x for x in sketches if len(x) == s), "<u8").reshape(-1, s // 8) for s in set(length.tolist())}
        at = np.zeros(len(n), np.int64)
        for s in bits:
            at[length == s] = np.arange((length == s).sum())

        def scores(x: int, others: np.ndarray) -> np.ndarray:
            out = np.full(len(others), -1)
            near = np.minimum(n[others], n[x]) * of >= np.maximum(n[others], n[x]) * least
            for s in bits:
                some = np.flatnonzero(near & (length[others] == s))
                if not len(some) or max(s, length[x]) > 4 * min(s, length[x]):
                    continue
                m = min(s, length[x]) // 8
                y = np.bitwise_xor.reduce(bits[s][at[others[some]]].reshape(len(some), -1, m), 1)
                own = np.bitwise_xor.reduce(bits[length[x]][at[x]].reshape(-1, m), 0)
                apart = np.bitwise_count(y ^ own).sum(1, dtype=np.int64)
                out[some] = np.where(apart <= (n[others[some]] + n[x]) * (of - least) // (of + least), apart, -1)
            return out

        return scores

    return allowed


# --- on Spark --------------------------------------------------------------


def _ordered(x: str, y: str) -> list[Column]:
    return [F.least(x, y).alias("a"), F.greatest(x, y).alias("b")]


def _members(docs: DataFrame, classes: DataFrame, n: int, least: int, of: int) -> DataFrame:
    """``sig, node, in_sig`` of the sets that share enough signatures with others: those with too
    few go, then the signatures left with one set; ``in_sig`` sets have a signature.

    Signatures meet their set's node in the shuffle that counts them, and keep the size of their
    group from there on, since later steps take or leave a signature with all its sets.
    """
    spark = docs.sparkSession
    sigs = docs.select("text").mapInArrow(_signed(n, least, of), "sig long, v long")
    n_parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    found = staged(sigs.repartition(n_parts, "sig").sortWithinPartitions("sig", "v").mapInArrow(_shared, "sig long, v long"), "shared")
    own = Window.partitionBy("short")
    counted = found.withColumn("short", F.col("v").bitwiseAND(F.lit(-64))).withColumn("shares", F.count("*").over(own))
    enough = counted.where(F.col("shares") >= F.col("v").bitwiseAND(F.lit(63))).select("sig", "short")
    alive = staged(enough.join(classes.select(F.col("v").alias("short"), "node"), "short").select("sig", "node"), "alive")
    sizes = alive.groupBy("sig").agg(F.count("*").alias("in_sig")).where("in_sig > 1")
    out = staged(alive.join(sizes, "sig"), "members")
    discard(found, alive)
    return out


def described_sets(docs: DataFrame, classes: DataFrame, wanted: DataFrame, n: int, made=sketch) -> DataFrame:
    """``node, n, sketch, z, size`` of the sets of the wanted nodes, read again from a document each;
    ``made`` gives a set's sketch."""
    named = staged(classes.join(wanted, "node", "left_semi").select("node", "hi", "lo", "least_id"), "named")
    ids = named.select(F.col("least_id").alias("doc_id")).distinct()
    texts = docs.join(ids, "doc_id", "left_semi")
    if not named.where("least_id IS NULL").isEmpty():
        texts = texts.unionByName(docs.where("doc_id IS NULL"))
    seen = texts.select("text").mapInArrow(_described(n, made), "hi long, lo long, n long, sketch binary, z binary, size long")
    out = staged(seen.join(named, ["hi", "lo"]).groupBy("node").agg(*[F.first(c).alias(c) for c in ("n", "sketch", "z", "size")]), "sets")
    discard(named)
    return out


def similar(pairs: DataFrame, sets: DataFrame, words: int, least: int, of: int, near) -> DataFrame:
    """Of the pairs ``a, b`` those with ``of * intersection >= least * union``.

    Sizes and sketches (``near``) rule out most of those that are not linked; of the others all
    elements are compared, each ``a`` standing before up to ``HELD_BY_TASK`` of its ``b`` in a task.
    """
    n_parts = int(pairs.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    x = sets.select(F.col("node").alias("a"), F.col("n"), F.col("sketch").alias("x"))
    y = sets.select(F.col("node").alias("b"), F.col("n").alias("m"), F.col("sketch").alias("y"))
    near = staged(pairs.join(x, "a").join(y, "b").select("a", "b", "x", "y", "n", "m").mapInArrow(near, "a long, b long"), "near")
    groups = near.groupBy("a").agg(F.ceil(F.count("*") / HELD_BY_TASK).alias("groups"))
    salted = near.join(groups, "a").withColumn("salt", F.pmod(F.xxhash64("b"), F.col("groups")))
    members = salted.join(sets.select(F.col("node").alias("b"), "z", "size"), "b").select("a", "salt", "b", "z", "size")
    anchors = groups.select("a", F.explode(F.sequence(F.lit(0), F.col("groups") - 1)).alias("salt")).join(sets.select(F.col("node").alias("a"), "z", "size"), "a")
    both = members.unionByName(anchors.withColumn("b", F.lit(None).cast("long")))
    in_turn = both.repartition(n_parts, "a", "salt").sortWithinPartitions("a", "salt", F.col("b").asc_nulls_first())
    out = staged(in_turn.select("a", "b", "z", "size").mapInArrow(_linked(words, least, of), "a long, b long"), "linked")
    discard(near)
    return out


def _merged(labels: DataFrame | None, links: DataFrame) -> DataFrame:
    """``node, root`` after the further links ``a, b``."""
    if labels is None:
        return components(links)
    ends = links.join(labels.select(F.col("node").alias("a"), F.col("root").alias("ra")), "a", "left")
    ends = ends.join(labels.select(F.col("node").alias("b"), F.col("root").alias("rb")), "b", "left")
    ends = staged(ends.select("a", "b", F.coalesce("ra", "a").alias("x"), F.coalesce("rb", "b").alias("y")), "links")
    up = components(ends.select(F.col("x").alias("a"), F.col("y").alias("b"))).select(F.col("node").alias("root"), F.col("root").alias("top"))
    old = labels.join(up, "root", "left").select("node", F.coalesce("top", "root").alias("root"))
    single = ends.select(F.explode(F.array("a", "b")).alias("node")).distinct().join(labels, "node", "left_anti")
    new = single.join(up.withColumnRenamed("root", "node"), "node", "left").select("node", F.coalesce("top", "node").alias("root"))
    out = staged(old.unionByName(new), "labels")
    discard(ends, labels)
    return out


def linked_sets(docs: DataFrame, classes: DataFrame, words: int, least: int, of: int) -> DataFrame | None:
    """``node, root`` of the classes that are linked to others; None if there are none."""
    members = _members(docs, classes, words, least, of)
    sets = described_sets(docs, classes, members.select("node").distinct(), words)
    return joined(members, sets, words, least, of, _near(least, of), across(_parities(least, of)))


def joined(members: DataFrame, sets: DataFrame, words: int, least: int, of: int, near, across) -> DataFrame | None:
    """``node, root`` of the linked among the ``members`` (``sig, node, in_sig``); None if there are none.
    ``near`` and ``across`` rule out pairs by sketches. Both tables are deleted at the end.

    Each set is compared with one hub of its signatures, the set that stands in most of them, which a
    group of near copies has in common, so that such a group costs a comparison a member. Signatures
    whose sets form one component by then are done. For the others other hubs follow, a set of each
    component for the largest component beside it. What is still apart after ``ROUNDS`` is paired up
    across components, within a signature and in blocks, where sizes and sketches allow a link: first
    each set with the nearest of a component, then, of what that leaves apart, with all. A pair is given
    out by the first of the signatures its sets share. No link between components is lost.
    """
    labels = None
    for k in range(ROUNDS):
        if k == 0:
            weighed = members.withColumn("w", F.sum("in_sig").over(Window.partitionBy("node")))
            hubs = weighed.groupBy("sig").agg(F.max(F.struct("w", "node")).alias("m"))
            best = members.join(hubs, "sig").where("node <> m.node").groupBy("node").agg(F.max("m").alias("m"))
            pairs = best.select(*_ordered("node", "m.node"))
        else:
            drawn = _named(members, labels).groupBy("sig", "label").agg(F.count("*").alias("n"), F.min(F.struct(F.xxhash64("node", "sig", F.lit(k)), "node")).alias("m"))
            drawn = drawn.select("sig", "label", "n", F.col("m.node").alias("node"))
            first = drawn.groupBy("sig").agg(F.max(F.struct("n", "node", "label")).alias("hub"))
            best = drawn.join(first, "sig").where("label <> hub.label").groupBy("label").agg(F.max(F.struct("hub", "node")).alias("m"))
            pairs = best.select(*_ordered("m.node", "m.hub.node"))
        labels, links = _linked_more(labels, staged(pairs.distinct(), "pairs"), sets, words, least, of, near)
        if not links:
            break
        members = _still_apart(members, labels)
    n_parts = int(members.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    for nearest in (True, False):
        named = _named(members, labels).withColumn("blocks", F.ceil(F.col("in_sig") / IN_BLOCK))
        named = named.withColumn("x", F.pmod(F.xxhash64("node"), "blocks")).withColumn("y", F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)))
        rows = named.select("node", "sig", F.least("x", "y").alias("i"), F.greatest("x", "y").alias("j"), "label").join(sets.select("node", "n", "sketch"), "node")
        rows = rows.join(members.groupBy("node").agg(F.slice(F.array_sort(F.collect_list("sig")), 1, FIRST).alias("first")), "node")
        sorted_rows = rows.select("sig", "i", "j", "node", "label", "n", "sketch", "first").repartition(n_parts, "sig", "i", "j").sortWithinPartitions("sig", "i", "j")
        left = staged(sorted_rows.mapInArrow(across(nearest), "a long, b long").distinct(), "left")
        labels, links = _linked_more(labels, left, sets, words, least, of, near)
        if nearest and links:
            members = _still_apart(members, labels)
    discard(members, sets)
    return labels


def _named(members: DataFrame, labels: DataFrame | None) -> DataFrame:
    """The members with the label of their component, their own node at first."""
    if labels is None:
        return members.withColumn("label", F.col("node"))
    return members.join(labels.select("node", F.col("root").alias("label")), "node", "left").withColumn("label", F.coalesce("label", "node"))


def _linked_more(labels: DataFrame | None, pairs: DataFrame, sets: DataFrame, words: int, least: int, of: int, near) -> tuple[DataFrame | None, bool]:
    """The labels after the links among some pairs, and whether there were any."""
    links = similar(pairs, sets, words, least, of, near)
    discard(pairs)
    some = not links.isEmpty()
    if some:
        labels = _merged(labels, links)
    discard(links)
    return labels, some


def _still_apart(members: DataFrame, labels: DataFrame) -> DataFrame:
    """The rows of signatures that hold several components; the given table is deleted."""
    mixed = _named(members, labels).groupBy("sig").agg(F.min("label").alias("p"), F.max("label").alias("q")).where("p <> q").select("sig")
    out = staged(members.join(mixed, "sig", "left_semi"), "members")
    discard(members)
    return out


def jaccard_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, least: int = LEAST, of: int = OF) -> DataFrame:
    """``doc_id, n_shingles, component_id``, a row for each row of ``docs``.

    Documents link when ``of * intersection >= least * union`` of their sets of ``words``-word
    shingles; ``component_id`` is the smallest id that links lead to. Texts with equal sets are
    one class from the start, so a group of copies costs one set, and copies are never paired.
    Classes are told apart by 128 bits, from two independent hashes of each word; elements of the
    two sets of a comparison by 64, so that a comparison of n with m elements errs with a chance of
    n * m / 2**64 at most.

    Null and blank texts have no shingles and stand alone, as does their id. A null id is never
    the smallest; a component of null ids alone has a null ``component_id``. Repeated rows are
    copies. No rows give no rows; other columns are not read.
    """
    return labelled(*linked_groups(docs, id_col=id_col, text_col=text_col, words=words, least=least, of=of))


def linked_groups(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, least: int = LEAST, of: int = OF) -> tuple[DataFrame, DataFrame]:
    """``doc_id, hi, lo, n_shingles`` of each row, and ``hi, lo, copies, root, component_id`` of each
    class; ``root`` tells apart the components of null ids alone."""
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    sized = staged(docs.mapInArrow(_sized(words), "doc_id long, hi long, lo long, n_shingles long"), "sized")
    grouped = sized.where("n_shingles > 0").groupBy("hi", "lo").agg(F.min("doc_id").alias("least_id"), F.count("*").alias("copies"))
    grouped = grouped.withColumn("node", F.monotonically_increasing_id())
    classes = staged(grouped.mapInArrow(_with_short_id, "hi long, lo long, least_id long, copies long, node long, v long"), "classes")
    return sized, rooted_classes(classes, linked_sets(docs, classes, words, least, of))


def rooted_classes(classes: DataFrame, labels: DataFrame | None) -> DataFrame:
    """``hi, lo, copies, root, component_id`` of each class, from its label, if it has any."""
    if labels is None:
        return classes.select("hi", "lo", "copies", F.col("node").alias("root"), F.col("least_id").alias("component_id"))
    rooted = staged(classes.join(labels, "node", "left").select("hi", "lo", "copies", "least_id", F.coalesce("root", "node").alias("root")), "rooted")
    discard(classes, labels)
    least_of = rooted.groupBy("root").agg(F.min("least_id").alias("component_id"))
    out = staged(rooted.join(least_of, "root").select("hi", "lo", "copies", "root", "component_id"), "components")
    discard(rooted)
    return out


def _with_short_id(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        hi, lo = (batch.column(i).to_numpy().view(np.uint64) for i in (0, 1))
        yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(signed(short_ids(hi, lo)))], names=[*batch.schema.names, "v"])


def labelled(sized: DataFrame, classes: DataFrame) -> DataFrame:
    """``doc_id, n_shingles, component_id`` of each row."""
    some = with_key_of_many(sized.where("n_shingles > 0"), classes.select("hi", "lo", "copies", "component_id"), ["hi", "lo"], "copies")
    none = sized.where("n_shingles = 0").withColumn("component_id", F.col("doc_id"))
    return some.select("doc_id", "n_shingles", "component_id").unionByName(none.select("doc_id", "n_shingles", "component_id"))


def with_set_id(docs: DataFrame, *, text_col: str = "text", words: int = WORDS) -> DataFrame:
    """``docs`` with the ``hi, lo`` of each text's set, null without words."""
    at = docs.columns.index(text_col)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for i, x, edge, y in _sets(batch, at, words):
                none = np.diff(edge) == 0
                ids = [pa.array(signed(c), mask=none) for c in set_ids(x, edge, y)]
                yield pa.RecordBatch.from_arrays([*[c.slice(i, len(none)) for c in batch.columns], *ids], names=[*batch.schema.names, "hi", "lo"])

    return docs.mapInArrow(run, T.StructType([*docs.schema.fields, T.StructField("hi", T.LongType()), T.StructField("lo", T.LongType())]))


def op5_jaccard(spark, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet")
    return jaccard_components(docs, words=3, least=90)


OP5_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) >= 3 THEN list_distinct(list_transform(range(1, len(w) - 1), lambda i: w[i] || ' ' || w[i + 1] || ' ' || w[i + 2]))
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE []::VARCHAR[] END AS s FROM w),
e AS (SELECT doc_id, unnest(s) AS x FROM s),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM e a JOIN e b USING (x) WHERE a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM i JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE 100 * n >= 90 * (len(x.s) + len(y.s) - n)),
u AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
c AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT c.a, u.b FROM c JOIN u ON c.b = u.a)
SELECT s.doc_id, len(s.s)::BIGINT AS n_shingles, m.component_id FROM s JOIN (SELECT a, min(b) AS component_id FROM c GROUP BY a) m ON m.a = s.doc_id
"""
