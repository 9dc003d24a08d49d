"""Packing against a naive best fit, the fit of the chain against differences, and fingerprints of all anchors."""

import itertools
import random

import numpy as np
import pytest

from tessella.llm import packing, quality, syncmers


def naive_best_fit(lengths, size, most):
    """Windows as they close, and those open at the end: [piece, ..] by number."""
    windows, closed, made = {}, [], 0
    for i, n in enumerate(lengths):
        fits = [w for w, held in windows.items() if size - sum(lengths[k] for k in held) >= n]
        if fits:
            w = min(fits, key=lambda w: (size - sum(lengths[k] for k in windows[w]), w))
        else:
            if len(windows) >= most:
                fullest = min(windows, key=lambda w: (size - sum(lengths[k] for k in windows[w]), w))
                closed.append(windows.pop(fullest))
            w, made = made, made + 1
            windows[w] = []
        windows[w].append(i)
        if sum(lengths[k] for k in windows[w]) == size:
            closed.append(windows.pop(w))
    return closed, sorted(windows.values())


@pytest.mark.parametrize(("seed", "most"), [(1, 1), (2, 3), (3, 16), (4, 200)])
def test_placing_equals_a_naive_best_fit(seed, most):
    r = random.Random(seed)
    size = 64
    lengths = [r.choice([1, 7, 32, 63, r.randint(1, 64)]) for _ in range(600)]
    windows, closed = packing.Windows(size, most), []
    for i, n in enumerate(lengths):
        closed += packing._split(windows.place((i,), n))
    want, rest = naive_best_fit(lengths, size, most)
    assert [[p[0] for p in w] for w in closed] == want
    assert sorted([p[0] for p in w] for w in windows.rest()) == rest


def objective(z, row, label, w, move, ridge):
    """The penalised likelihood by listing all labellings of each document; each weighs alike, by line."""
    docs, total = np.unique(row), 0.0
    for d in docs:
        at = np.flatnonzero(row == d)
        s = z[at] @ w

        def score(y, s=s):
            return float(np.dot(y, s)) + sum(move[a, b] for a, b in zip(y, y[1:], strict=False))

        every = [score(y) for y in itertools.product((0, 1), repeat=len(at))]
        total += (score(tuple(label[at])) - np.logaddexp.reduce(every)) / len(at) / len(docs)
    return total - ridge / 2 * (w @ w + (move**2).sum())


def test_the_fit_is_where_differences_vanish():
    r = np.random.default_rng(4)
    row = np.repeat(np.arange(12), r.integers(1, 6, 12))
    x = r.normal(size=(len(row), quality.N_OWN))
    label = (x[:, 0] + r.normal(size=len(row)) > 0).astype(np.int64)
    ridge = 0.05
    model = quality.fit(x, row, label, rounds=4000, ridge=ridge)
    z = quality.with_neighbours((x - model.mean) / model.scale, row)
    at_best = objective(z, row, label, model.weights, model.move, ridge)
    def slopes(w, move):
        for k in range(0, len(w), 5):
            e = np.zeros(len(w))
            e[k] = 1e-4
            yield (objective(z, row, label, w + e, move, ridge) - objective(z, row, label, w - e, move, ridge)) / 2e-4
        for i, j in itertools.product((0, 1), repeat=2):
            e = np.zeros((2, 2))
            e[i, j] = 1e-4
            yield (objective(z, row, label, w, move + e, ridge) - objective(z, row, label, w, move - e, ridge)) / 2e-4

    before, after = (np.abs(list(slopes(*at))) for at in ((model.weights * 0, model.move * 0), (model.weights, model.move)))
    assert after.max() < 0.03 * before.max()  # steps of fixed size end near the top, not on it
    assert at_best > objective(z, row, label, model.weights * 0, model.move * 0, ridge)


def test_fingerprints_of_all_anchors(spark):
    r = random.Random(6)
    texts = ["".join(r.choice("abcdefgh ") for _ in range(n)) for n in (0, 5, 300, 12_000, 12_000)]
    df = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string").repartition(3)
    got = {x.doc_id: x for x in syncmers.fingerprints(df, keep=None).collect()}
    for i, t in enumerate(texts):
        hashes = {int(h) >> 32 for h in syncmers.anchors(t.encode())[0]}
        if hashes:
            assert {int(got[i].fingerprint[k : k + 8], 16) for k in range(0, len(got[i].fingerprint), 16)} == hashes
    half = texts[4][:6000] + texts[3][:6000]
    mine, other = ({int(h) for h in syncmers.anchors(t.encode())[0]} for t in (texts[4], half))
    assert got[4].near_edited == pytest.approx(2 * len(mine & other) / (len(mine) + len(other)), abs=0.002)
    assert len(syncmers.fingerprint(texts[3].encode())) < len(got[3].fingerprint) / 3
