"""Sets that share many signatures are paired by one of them."""

import numpy as np
import pyarrow as pa
import pytest

from tessella.llm import jaccard as J


def given_out(held, first, nearest=False):
    """The pairs of the groups of ``held`` (signatures of each node), each node a component of its own."""
    rows = sorted((sig, 0, 0, node, node, 1, b"", sorted(sigs)[:first]) for node, sigs in held.items() for sig in sigs)
    names = ["sig", "i", "j", "node", "label", "n", "sketch", "first"]
    types = [pa.int64()] * 6 + [pa.binary(), pa.list_(pa.int64())]
    batches = pa.Table.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), types, strict=True)], names=names).to_batches(max_chunksize=7)
    out = J.across(lambda t: lambda x, others: np.zeros(len(others), np.int64))(nearest)(iter(batches))
    return [p for b in out for p in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True)]


@pytest.mark.parametrize("first", [0, 2, 16, 100])
def test_each_pair_of_many_common_signatures_is_given_out(first):
    r = np.random.default_rng(3)
    sigs = r.integers(-(1 << 62), 1 << 62, 90).tolist()
    held = {n: {s for s in sigs if r.random() < 0.7} for n in range(30)} | {90: {7}, 91: {7}, 92: {8}}
    got = given_out(held, first)
    assert set(got) == {(a, b) for a in held for b in held if a < b and held[a] & held[b]}
    if first == 0:
        assert len(got) > 30 * len(set(got))
    if first >= 16:
        assert len(got) == len(set(got)) == 30 * 29 // 2 + 1
    assert set(given_out(held, first, nearest=True)) <= set(got)
