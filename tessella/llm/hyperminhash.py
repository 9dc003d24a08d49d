"""Near-duplicate documents by HyperMinHash sketches: banded registers, corrected estimates, full comparison."""

from __future__ import annotations

import math
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import bucketed, discard, mix, pieces, signed, staged, text_bytes
from .jaccard import _bands as size_bands
from .jaccard import _batch, across, apart_by, joined, labelled, rooted_classes, set_ids, shingle_sets
from .jaccard import sketch as parities

WORDS, LEAST, OF = 5, 85, 100
BUCKETS = 128  # registers of a sketch, a power of two
MANTISSA = 10  # bits kept behind the leading one of a bucket's smallest hash
BAND = 4  # registers of a band of large sets; they fill 64 bits
SPARE = 1  # bands of small sets that may be empty while another is sure to be shared
LOST = 1e-11  # chance that the estimate rules out a linked pair
_RANK = 53  # bits of a hash that ranks and mantissas are taken from

# --- sketches --------------------------------------------------------------


def registers(x: np.ndarray, edge: np.ndarray) -> np.ndarray:
    """A row of registers for each set: of the elements dealt to a bucket the smallest hash counts,
    as its number of leading zeros and the ``MANTISSA`` bits that follow the leading one, in 16
    bits; 0 where a bucket has no element."""
    n = len(edge) - 1
    own = np.repeat(np.arange(n), np.diff(edge))
    scrambled = mix(x ^ np.uint64(0xD1B54A32D192ED03))
    width = np.uint64(BUCKETS.bit_length() - 1)
    low = np.full(n * BUCKETS, (1 << 64) - 1, np.uint64)
    np.minimum.at(low, own * BUCKETS + (scrambled >> (np.uint64(64) - width)).astype(np.int64), scrambled << width >> np.uint64(64 - _RANK))
    empty = low == (1 << 64) - 1
    low[empty] = 0
    length = np.frexp(low.astype(np.float64))[1].astype(np.int64)  # up to 53 bits are exact
    shift = length - 1 - MANTISSA
    rest = np.where(shift >= 0, low >> np.maximum(shift, 0).astype(np.uint64), low << np.maximum(-shift, 0).astype(np.uint64)).astype(np.int64)
    out = 1 + ((_RANK - length) << MANTISSA) + (rest & ((1 << MANTISSA) - 1))
    return np.where(empty, 0, out).astype(np.uint16).reshape(n, BUCKETS)


def bands(regs: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The key of each band that holds an element, and its row of ``regs``.

    Two sets of similarity s have equal bands with a chance of s ** BAND each, so that a pair at the
    threshold of 0.85 shares none of 32 with a chance of 6e-11. A band that neither set has, or in
    which no differing element is smallest, is equal at once, so small sets do better still.
    """
    packed = np.ascontiguousarray(regs).view("<u8").reshape(len(regs), -1)
    row, at = np.nonzero(packed)
    return mix(packed[row, at] ^ mix(at.astype(np.uint64) + np.uint64(1))), row


@cache
def _wide(least: int, of: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The bands of sizes of ``jaccard._bands``, low to high, and for pairs whose larger set is in one,
    into how many bands the registers are dealt: ``SPARE`` + 1 more than linked sets differ in elements,
    none where only equal sets link, and -1 where these bands would be narrower than ``BAND``."""
    low, high = size_bands(least, of)
    k = 2 * high * (of - least) // (of + least)
    parts = np.where(k > 0, k + 1 + SPARE, 0)
    return low, high, np.where(parts * BAND > BUCKETS, -1, parts)


def band_keys(regs: np.ndarray, n: np.ndarray, least: int, of: int) -> tuple[np.ndarray, np.ndarray]:
    """The keys of the bands of sets of n elements, and their rows of ``regs``.

    Large sets have the keys of ``bands``. Of small sets, whose registers are mostly empty, such a band
    is often one element, which many sets have that are not linked; they have fewer, wider bands, as
    many as their size needs, in the scheme of their own band of sizes and, if a linked set may lie in
    the next, in that one's too. An element in which two sets differ changes one band, so linked sets
    have more than ``SPARE`` equal bands for sure. Bands without an element have a key only in sets that
    have more than ``SPARE`` of them: two such sets share these, any other pair one with elements.
    """
    if least >= of or not len(n):  # only equal sets link
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    low, high, parts_of = _wide(least, of)
    own = np.searchsorted(high, n)
    next_too = (n > 0) & (n * of >= low[own + 1] * least)
    large = np.flatnonzero((n > 0) & ((parts_of[own] < 0) | (next_too & (parts_of[own + 1] < 0))))
    key, row = bands(regs[large]) if len(large) else (np.zeros(0, np.uint64), large)
    keys, rows = [key], [large[row]]
    small = np.flatnonzero(n * (parts_of[own] >= 0) > 0)
    scrambled = mix(regs[small].astype(np.uint64) + (np.arange(BUCKETS, dtype=np.uint64) << np.uint64(16)))
    for band in range(int(own[small].max(initial=-1)) + 2):
        parts = int(parts_of[band])
        at = np.flatnonzero((own[small] == band) | (next_too[small] & (own[small] + 1 == band)))
        if parts < 1 or not len(at):
            continue
        edge = np.arange(parts) * BUCKETS // parts
        some = np.logical_or.reduceat(regs[small[at]] > 0, edge, 1)
        given = some | ((~some).sum(1) > SPARE)[:, None]
        name = np.uint64(band << 40) + np.arange(parts, dtype=np.uint64)
        key = mix(np.add.reduceat(scrambled[at], edge, 1) ^ mix(name + np.uint64(1 << 32)))
        keys.append(key[given])
        rows.append(np.broadcast_to(small[at][:, None], given.shape)[given])
    return np.concatenate(keys), np.concatenate(rows)


@cache
def _fewest(least: int, of: int) -> np.ndarray:
    """For n registers that either of two sets has, the fewest equal ones of a linked pair, but for
    a chance of ``LOST``: the tail of a binomial of that similarity."""
    s, out = least / of, [0]
    for n in range(1, BUCKETS + 1):
        total, t = 0.0, 0
        while (total := total + math.comb(n, t) * s**t * (1 - s) ** (n - t)) <= LOST:
            t += 1
        out.append(t)
    return np.array(out)


def may_link(x: np.ndarray, y: np.ndarray, n: np.ndarray, m: np.ndarray, least: int, of: int) -> np.ndarray:
    """Whether the registers x, y of sets of n and m elements leave a link possible.

    Equal registers estimate the similarity once those are taken off that are equal by accident:
    unequal smallest hashes agree in rank and mantissa with a chance of 0.1699 * d / 2**MANTISSA,
    where d = 4 * (n / m) / (1 + n / m)**2.
    """
    ratio = n / m
    chance = 0.1699 * 4 * ratio / (1 + ratio) ** 2 / (1 << MANTISSA)
    some = ((x > 0) | (y > 0)).sum(1)
    equal = ((x == y) & (x > 0)).sum(1)
    corrected = (equal - chance * some) / (1 - chance)
    return (np.minimum(n, m) * of >= np.maximum(n, m) * least) & (corrected >= _fewest(least, of)[some] - 0.5)


def estimated_similarity(x: np.ndarray, y: np.ndarray, n: int, m: int) -> float:
    """The similarity of two sets of n and m elements by their registers, corrected for accidents."""
    chance = 0.1699 * 4 * (n / m) / (1 + n / m) ** 2 / (1 << MANTISSA)
    some = int(((x > 0) | (y > 0)).sum())
    return max(0.0, (int(((x == y) & (x > 0)).sum()) - chance * some) / (1 - chance) / some) if some else 0.0


# --- in tasks --------------------------------------------------------------


def _sketched(n: int):
    """Ids, size, sketch (registers, then parities) and compressed text of each set."""
    out = pa.schema([("doc_id", pa.int64()), ("hi", pa.int64()), ("lo", pa.int64()), ("n_shingles", pa.int64()), ("sketch", pa.binary()), ("z", pa.binary()), ("size", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            b, offsets = text_bytes(batch.column(1))
            for i, j in pieces(offsets):
                x, edge, y = shingle_sets(b[offsets[i] : offsets[j]], offsets[i : j + 1] - offsets[i], n)
                hi, lo = set_ids(x, edge, y)
                sketch = [r.tobytes() + parities(x[p:q]) for r, p, q in zip(registers(x, edge), edge[:-1], edge[1:], strict=True)]
                z = [pa.compress(b[offsets[r] : offsets[r + 1]].tobytes(), "zstd", asbytes=True) for r in range(i, j)]
                yield _batch(out, batch.column(0).slice(i, j - i), signed(hi), signed(lo), np.diff(edge), sketch, z, np.diff(offsets[i : j + 1]))

    return run


def _rows(sketches: list[bytes]) -> np.ndarray:
    """The registers in front of each sketch."""
    return np.frombuffer(b"".join([s[: 2 * BUCKETS] for s in sketches]), np.uint16).reshape(len(sketches), BUCKETS)


def _banded(least: int, of: int):
    out = pa.schema([("sig", pa.int64()), ("node", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                key, row = band_keys(_rows(batch.column(1).to_pylist()), batch.column(2).to_numpy(), least, of)
                yield _batch(out, signed(key), batch.column(0).to_numpy()[row])

    return run


def _most_apart(n, m, least: int, of: int):
    """The most elements in which linked sets of n and m elements differ."""
    return (n + m) * (of - least) // (of + least)


def _near(least: int, of: int):
    """The pairs that registers, sizes and then parities leave possible."""
    out = pa.schema([("a", pa.int64()), ("b", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if batch.num_rows:
                a, b, n, m = (batch.column(c) for c in ("a", "b", "n", "m"))
                x, y = (batch.column(c).to_pylist() for c in ("x", "y"))
                n, m = n.to_numpy(), m.to_numpy()
                at = np.flatnonzero(may_link(_rows(x), _rows(y), n, m, least, of))
                apart = apart_by([x[i][2 * BUCKETS :] for i in at], [y[i][2 * BUCKETS :] for i in at])
                at = at[apart <= _most_apart(n[at], m[at], least, of)]
                yield _batch(out, a.take(pa.array(at)), b.take(pa.array(at)))

    return run


def _scores(least: int, of: int):
    """For pairs within a band's group: less the more registers are equal."""

    def allowed(t: pa.Table):
        n, sketches = t.column("n").to_numpy(), t.column("sketch").to_pylist()
        regs = _rows(sketches)

        def scores(x: int, others: np.ndarray) -> np.ndarray:
            out = np.full(len(others), -1)
            at = np.flatnonzero(may_link(regs[others], regs[x][None, :], n[others], n[x], least, of))
            apart = apart_by([sketches[i][2 * BUCKETS :] for i in others[at]], [sketches[x][2 * BUCKETS :]] * len(at))
            at = at[apart <= _most_apart(n[others[at]], n[x], least, of)]
            out[at] = BUCKETS - ((regs[others[at]] == regs[x]) & (regs[x] > 0)).sum(1)
            return out

        return scores

    return allowed


# --- on Spark --------------------------------------------------------------


def hyperminhash_components(docs: DataFrame, *, id_col: str = "doc_id", text_col: str = "text", words: int = WORDS, least: int = LEAST, of: int = OF) -> DataFrame:
    """``doc_id, n_shingles, component_id, kept``, a row for each row of ``docs``.

    Documents link when ``of * intersection >= least * union`` of their sets of ``words``-word
    shingles; ``component_id`` is the smallest id that links lead to, and the document of that id is
    ``kept``. Texts of equal sets are one class, told apart by 128 bits, with one sketch, so copies
    are never paired. Classes that share a band of registers are candidates; bands are as wide as a
    set's size allows, so that small sets are none for one element in common. Estimates rule out most
    of those that are not linked, and parities of the sets (``jaccard.sketch``, which never rule out a
    link) most of the others; the rest is compared on all elements (64 bits each), by hubs, as
    ``jaccard.joined`` says. A linked pair of small sets always shares a band. One of large sets at the
    threshold shares none with a chance of 6e-11, and any is ruled out by the estimate with one of 1e-11; ``least`` far below 85 would need more bands.

    Null and blank texts have no shingles and stand alone. A null id is never the smallest; a
    component of null ids alone has a null ``component_id`` and keeps its rows. Repeated rows are
    copies, and all rows of the smallest id are kept. No rows give no rows; other columns are not read.
    """
    docs = docs.select(F.col(f"`{id_col}`").cast("long").alias("doc_id"), F.col(f"`{text_col}`").alias("text"))
    seen = docs.mapInArrow(_sketched(words), "doc_id long, hi long, lo long, n_shingles long, sketch binary, z binary, size long")
    whole = staged(seen, "sketched")
    sized = staged(whole.select("doc_id", "hi", "lo", "n_shingles"), "sized")
    # Copies combine within a task; one text of each class goes on, in buckets of its node.
    grouped = whole.where("n_shingles > 0").groupBy("hi", "lo").agg(
        F.min("doc_id").alias("least_id"), F.count("*").alias("copies"), F.min(F.struct("sketch", "n_shingles", "z", "size")).alias("m")
    )
    sets = bucketed(grouped.select("hi", "lo", "least_id", "copies", F.monotonically_increasing_id().alias("node"), F.col("m.n_shingles").alias("n"), "m.sketch", "m.z", "m.size"), "sets", "node")
    classes = staged(sets.select("hi", "lo", "least_id", "copies", "node"), "classes")
    discard(whole)
    banded = staged(sets.select("node", "sketch", "n").mapInArrow(_banded(least, of), "sig long, node long"), "banded")
    sizes = banded.groupBy("sig").agg(F.count("*").alias("in_sig")).where("in_sig > 1")
    members = staged(banded.join(sizes, "sig"), "members")
    discard(banded)
    labels = joined(members, sets, words, least, of, _near(least, of), across(_scores(least, of)))
    found = labelled(sized, rooted_classes(classes, labels))
    return found.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("component_id")))


def op13_hyperminhash(spark, sf_dir: str) -> DataFrame:
    return hyperminhash_components(spark.read.parquet(f"{sf_dir}/documents.parquet"))


OP13_SQL = r"""
WITH RECURSIVE w AS (SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w FROM documents),
s AS (SELECT doc_id, CASE WHEN len(w) >= 5 THEN list_distinct(list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' ')))
  WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE []::VARCHAR[] END AS s FROM w),
e AS (SELECT doc_id, unnest(s) AS x FROM s),
i AS (SELECT a.doc_id AS a, b.doc_id AS b, count(*) AS n FROM e a JOIN e b USING (x) WHERE a.doc_id < b.doc_id GROUP BY ALL),
l AS (SELECT a, b FROM i JOIN s x ON x.doc_id = a JOIN s y ON y.doc_id = b WHERE 100 * n >= 85 * (len(x.s) + len(y.s) - n)),
u AS (SELECT a, b FROM l UNION SELECT b, a FROM l),
c AS (SELECT doc_id AS a, doc_id AS b FROM s UNION SELECT c.a, u.b FROM c JOIN u ON c.b = u.a),
m AS (SELECT a, min(b) AS component_id FROM c GROUP BY a)
SELECT doc_id, len(s)::BIGINT AS n_shingles, component_id, doc_id = component_id AS kept FROM s JOIN m ON a = doc_id
"""
