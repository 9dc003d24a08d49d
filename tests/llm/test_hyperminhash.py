"""HyperMinHash sketches against plain definitions, and their near-duplicate groups against brute force."""

import random

import numpy as np
import pytest

from tessella.llm import hyperminhash as H

SCHEMA = "doc_id long, text string, sig long, node long"


def near_copies(seed, n, size):
    """Texts of distinct words with some replaced, of many similarities around the threshold; odd ones too."""
    r = random.Random(seed)
    base = [[f"w{r.randrange(10**6)}" for _ in range(size)] for _ in range(4)]
    out = [None, "", " \t", "one", "One", "a b c d", "a b c d e", "A b c d E f"]
    for _ in range(n):
        w = list(r.choice(base))
        for _ in range(r.randint(0, size // 40)):
            w[r.randrange(size)] = f"x{r.randrange(10**6)}"
        out.append(" ".join(w))
    return out + [out[9], out[9].upper(), out[10] + " more"]


def by_hand(texts, n=5, least=85):
    words = [(t or "").lower().split() for t in texts]
    sets = [{tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set()) for w in words]
    root = list(range(len(sets)))
    for _ in sets:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                if a and b and root[i] != root[j] and 100 * len(a & b) >= least * len(a | b):
                    root[i] = root[j] = min(root[i], root[j])
    return {i: (len(s), root[i], root[i] == i) for i, s in enumerate(sets)}


@pytest.mark.parametrize(("seed", "size"), [(1, 60), (2, 400)])
def test_groups_equal_brute_force(spark, seed, size, monkeypatch):
    from tessella.llm import jaccard

    monkeypatch.setattr(jaccard, "IN_BLOCK", 8)
    texts = near_copies(seed, 70, size)
    rows = spark.createDataFrame([(i, t, 1, 2) for i, t in enumerate(texts)], SCHEMA).repartition(3)
    want = by_hand(texts)
    assert {r.doc_id: (r.n_shingles, r.component_id, r.kept) for r in H.hyperminhash_components(rows).collect()} == want
    assert len({root for _, root, _ in want.values()}) < len(texts) - 20


def test_null_ids_repeats_and_no_rows(spark):
    a, b = " ".join(map(str, range(30))), " ".join(map(str, range(90, 120)))
    rows = [(7, a), (7, a), (3, a), (None, a), (None, b), (None, b), (None, None), (9, None), (9, None)]
    got = H.hyperminhash_components(spark.createDataFrame([(i, t, 0, 0) for i, t in rows], SCHEMA)).collect()
    assert sorted(map(repr, [(r.doc_id, r.n_shingles, r.component_id, r.kept) for r in got])) == sorted(map(repr, [
        (7, 26, 3, False), (7, 26, 3, False), (3, 26, 3, True), (None, 26, 3, False), (None, 26, None, True), (None, 26, None, True), (None, 0, None, True), (9, 0, 9, True), (9, 0, 9, True),
    ]))
    empty = H.hyperminhash_components(spark.createDataFrame([], SCHEMA))
    assert empty.count() == 0 and empty.columns == ["doc_id", "n_shingles", "component_id", "kept"]


def test_registers_hold_leading_zeros_and_mantissa():
    r = np.random.default_rng(3)
    x = r.integers(0, 1 << 64, 3000, np.uint64)
    edge = np.array([0, 0, 1, 40, 3000])
    got = H.registers(x, edge)
    for k in range(4):
        best = {}
        for v in H.mix(x[edge[k] : edge[k + 1]] ^ np.uint64(0xD1B54A32D192ED03)).tolist():
            value = (v << 7 & (1 << 64) - 1) >> 11
            best[v >> 57] = min(value, best.get(v >> 57, value))
        for bucket in range(H.BUCKETS):
            if bucket not in best:
                assert got[k, bucket] == 0
                continue
            bits = f"{best[bucket]:053b}"
            zeros = len(bits) - len(bits.lstrip("0"))
            mantissa = int((bits[zeros + 1 :] + "0" * 10)[:10], 2)
            assert got[k, bucket] == 1 + (zeros << 10) + mantissa


@pytest.mark.parametrize("s", [0.3, 0.85, 0.95])
def test_estimates_are_near_the_similarity_and_keep_links(s):
    r = np.random.default_rng(int(100 * s))
    errors, kept = [], []
    for _ in range(60):
        union = r.integers(0, 1 << 64, 2000, np.uint64)
        both = int(s * 2000)
        x, y = union[: both + (2000 - both) // 2], np.r_[union[:both], union[both + (2000 - both) // 2 :]]
        rx, ry = (H.registers(v, np.array([0, len(v)]))[0] for v in (x, y))
        errors.append(H.estimated_similarity(rx, ry, len(x), len(y)) - both / 2000)
        kept.append(H.may_link(rx[None], ry[None], np.array([len(x)]), np.array([len(y)]), 85, 100)[0])
    assert abs(np.mean(errors)) < 0.02 and np.std(errors) < 0.07
    assert all(kept) if s >= 0.85 else not any(kept)


def test_bands_of_small_sets_have_elements():
    x = np.arange(3, dtype=np.uint64)
    key, row = H.bands(H.registers(x, np.array([0, 0, 3])))
    assert len(key) <= 3 and set(row.tolist()) == {1}


@pytest.mark.parametrize(("least", "n"), [(85, n) for n in (6, 7, 8, 12, 20, 25, 26, 60, 93, 94, 120, 153)] + [(70, 30), (97, 140)])
def test_linked_small_sets_share_a_key(least, n):
    r = np.random.default_rng(n)
    for other in range(n * least // 100, n + 1):
        both = -(-least * (n + other) // (100 + least))  # the fewest of a linked pair
        if both > other:
            continue
        for _ in range(20):
            union = r.integers(0, 1 << 64, n + other - both, np.uint64)
            x, y = union[:n], np.r_[union[:both], union[n:]]
            key, row = H.band_keys(H.registers(np.r_[x, y], np.array([0, n, n + other])), np.array([n, other]), least, 100)
            assert set(key[row == 0].tolist()) & set(key[row == 1].tolist())


def test_keys_of_equal_sets_only_and_of_no_sets():
    regs = H.registers(np.arange(9, dtype=np.uint64), np.array([0, 9, 9]))
    assert [len(x) for x in H.band_keys(regs, np.array([9, 0]), 100, 100)] == [0, 0]
    assert [len(x) for x in H.band_keys(regs[:0], np.zeros(0, np.int64), 85, 100)] == [0, 0]
    assert set(H.band_keys(regs, np.array([9, 0]), 85, 100)[1].tolist()) == {0}


def test_a_common_passage_makes_no_candidates_of_short_texts(spark, monkeypatch):
    seen = []

    def counted(members, sets, *_):
        seen.append(members.count())

    monkeypatch.setattr(H, "joined", counted)
    passage = " ".join(f"p{i}" for i in range(9))
    texts = [" ".join(f"w{i}_{j}" for j in range(size)) + " " + passage for i in range(60) for size in (16, 30, 55)]
    H.hyperminhash_components(spark.createDataFrame([(i, t, 0, 0) for i, t in enumerate(texts)], SCHEMA)).collect()
    assert seen[0] < len(texts) // 4
