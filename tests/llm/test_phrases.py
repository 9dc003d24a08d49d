"""Collocations against plain counting."""

import random
import re
from collections import Counter, defaultdict

import numpy as np
import pytest

from tessella.llm import phrases

SCHEMA = "doc_id long, text string, lang string, n long, phrase string"


def by_hand(rows, least, most):
    n, f = Counter(), defaultdict(Counter)
    for text, lang in rows:
        lang = "und" if lang is None else lang
        low = "".join(c.lower() if "A" <= c <= "Z" else c for c in text or "")
        for piece in re.split(r"[.,;:!?\x0A-\x0D]", low):
            w = re.findall(r"[^\x20\x09]+", piece)
            n[lang] += len(w)
            for k in range(1, 5):
                f[lang].update(tuple(w[i : i + k]) for i in range(len(w) - k + 1))
    out = []
    for lang, counts in f.items():
        held = {p: c for p, c in counts.items() if c >= least}
        kept = []
        for p, a in held.items():
            if len(p) < 2 or any(len(q) > len(p) and 100 * c >= 80 * a and any(q[i : i + len(p)] == p for i in range(len(q) - len(p) + 1)) for q, c in held.items()):
                continue
            score, k = min((2000000 * a // (held[p[:k]] + held[p[k:]]), k) for k in range(1, len(p)))
            kept.append((-score, -a, " ".join(p).encode(), held[p[:k]], held[p[k:]]))
        out += [(lang, i + 1, p.decode(), -a, left, right, n[lang], -s) for i, (s, a, p, left, right) in enumerate(sorted(kept)[:most])]
    return sorted(out)


def found(df):
    return sorted((r.lang, r["rank"], r.phrase, r.a, r.l, r.r, r.n, r.score) for r in df.collect())


def texts(seed, n):
    r = random.Random(seed)
    words = ["The", "cat", "sat", "é", "on\x01a", "on", "a", "mat\x1f", "DOG", "|", "x" * 90, "Ä"]
    fixed = ["the cat sat on a mat", "é on | dog", "x y z u v"]
    out = [(None, "en"), ("", None), (" \t", "en"), ("a", "fr"), ("a.b", "fr")]
    for _ in range(n):
        body = "".join(r.choice(fixed if r.random() < 0.3 else words) + r.choice([" ", " ", " ", "\t", "  ", ". ", ",", "\n", "\x0b", ""]) for _ in range(r.randint(0, 30)))
        out.append((body, r.choice(["en", "en", "de", None, "und"])))
    return out + out[8:12]


@pytest.mark.parametrize(("seed", "least", "most"), [(1, 5, 2000), (2, 12, 7), (3, 30, 2000)])
def test_collocations_equal_plain_counts(spark, seed, least, most):
    rows = texts(seed, 250)
    df = spark.createDataFrame([(i, t, lang, 0, "p") for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(3)
    want = by_hand(rows, least, most)
    assert found(phrases.collocations(df, least=least, most=most)) == want and len(want) > 10


def test_no_rows_and_no_frequent_words(spark):
    df = spark.createDataFrame([(1, "a b a b", "en", 0, "p")], SCHEMA)
    assert found(phrases.collocations(df)) == [] and found(phrases.collocations(df.limit(0))) == []
    assert [r[2:6] for r in found(phrases.collocations(df, least=2))] == [("a b", 2, 2, 2)]


def test_a_hot_phrase_and_a_long_text(spark):
    rows = [("of the " * 40_000, "en")] + [("of the x", "en")] * 50
    df = spark.createDataFrame([(i, t, lang, 0, "p") for i, (t, lang) in enumerate(rows)], SCHEMA).repartition(4)
    assert found(phrases.collocations(df)) == by_hand(rows, 30, 2000)


def test_large_counts_stay_exact(spark, monkeypatch):
    """Products beyond 64 bits, from counts as they would be for a very large corpus."""
    big = 9 * 10**15
    f = spark.createDataFrame([("en", "a", 1, 2 * big), ("en", "b", 1, big), ("en", "a b", 2, big - 1)], "lang string, phrase string, words int, f long")
    n = spark.createDataFrame([("en", 4 * big)], "lang string, n long")
    monkeypatch.setattr(phrases, "count_phrases", lambda docs, **_: (f, n))
    assert found(phrases.collocations(f)) == [("en", 1, "a b", big - 1, 2 * big, big, 4 * big, 2000000 * (big - 1) // (3 * big))]


def test_packed_counts_come_back():
    r = np.random.default_rng(1)
    h = np.unique(r.integers(0, 1 << 64, 1000, np.uint64))
    c = r.integers(1, 31, len(h))
    got = [phrases._unpacked(x["n"], x["z"]) for x in phrases._packed(h, c, 16).to_pylist()]
    assert np.array_equal(np.concatenate([x for x, _ in got]), h) and np.array_equal(np.concatenate([y for _, y in got]), c)
