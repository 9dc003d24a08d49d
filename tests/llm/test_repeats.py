"""Similarity joins, top-k search and both kinds of substring dedup against brute force."""

import random
import re
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from tessella.llm import jaccard, rlz, suffixes, topk

WORD = re.compile(r"[^\x20\x09-\x0D]+")


def patchwork(seed, length):
    """Texts of pieces of a few common strings, with edits; empty, periodic and equal ones too."""
    r = random.Random(seed)
    base = ["".join(r.choice("abcdé ") for _ in range(r.randint(0, 6 * length))) for _ in range(12)]
    texts = [None, "", "a" * (3 * length), "a" * (length - 1), "ab" * length]
    for _ in range(50):
        t = "".join(b[(i := r.randint(0, len(b))) : i + r.randint(0, 4 * length)] for b in r.choices(base, k=r.randint(0, 5)))
        for _ in range(r.randint(0, 2) if t else 0):
            i = r.randrange(len(t))
            t = t[:i] + r.choice("xyz") + t[i + 1 :]
        texts.append(t)
    return texts + texts[5:9]


def cut_by_hand(texts, length):
    raw = [(t or "").encode() for t in texts]
    seen = Counter(b[i : i + length] for b in raw for i in range(len(b) - length + 1))
    for b in raw:
        gone = [False] * len(b)
        for i in range(len(b) - length + 1):
            if seen[b[i : i + length]] > 1:
                gone[i : i + length] = [True] * length
        spans = [(m.start(), m.end() - m.start()) for m in re.finditer("1+", "".join("01"[g] for g in gone))]
        yield len(b), spans, bytes(x for x, g in zip(b, gone, strict=True) if not g)


@pytest.mark.parametrize(("seed", "length"), [(1, 12), (3, 28), (5, 100)])
def test_repeated_strings_go_as_by_brute_force(spark, seed, length):
    texts = patchwork(seed, length)
    rows = spark.createDataFrame([(i, t, 7) for i, t in enumerate(texts)], "doc_id long, text string, key int")
    want = list(cut_by_hand(texts, length))
    got = suffixes.cut_repeats(rows, length=length).collect()
    assert len(got) == len(texts)
    for r in got:
        assert (r.sa_bytes, [tuple(s) for s in r.sa_spans], bytes(r.sa_kept)) == want[r.doc_id]
        assert r.text == texts[r.doc_id] and r.key == 7


def test_repeats_in_long_texts(spark, monkeypatch):
    """Texts of several chunks, blocks of few excerpts, and keys that two texts share."""
    r = random.Random(6)
    monkeypatch.setattr(suffixes, "IN_BLOCK", 2)
    base = "".join(r.choice("abcdefg ") for _ in range(1 << 20))
    long = base + "".join(r.choice("hijk") for _ in range(9000)) + base[500:3000] + "end"
    texts = [long, base[700_000:700_900] + "x" + base[10:800], None, "short", base[5:420]] + [base[600:1500] + str(i) for i in range(9)]
    rows = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "doc_id long, text string").repartition(4)
    want = list(cut_by_hand(texts, 400))
    for r in suffixes.cut_repeats(rows).collect():
        assert (r.sa_bytes, [tuple(s) for s in r.sa_spans], bytes(r.sa_kept)) == want[r.doc_id]
    keyed = rows.where("text IS NOT NULL").select((F.col("doc_id") % 2).alias("key"), F.col("doc_id").alias("tag"), "text")
    marks = suffixes.repeated_stretches(keyed).collect()
    for i, t in enumerate(texts):
        gone = [False] * len(t or "")
        for m in marks:
            if m.tag == i:
                gone[m.lo : m.hi] = [True] * (m.hi - m.lo)
        assert sum(gone) == sum(n for _, n in want[i][1])


def test_repeats_of_nothing_and_names(spark):
    with pytest.raises(ValueError, match="sa_key"):
        suffixes.cut_repeats(spark.createDataFrame([("a", 1)], "text string, sa_key int"))
    assert suffixes.cut_repeats(spark.createDataFrame([], "doc_id long, text string")).count() == 0


def words_of(seed, n, most):
    """Word lists with shared passages and near copies."""
    r = random.Random(seed)
    common = [[r.choice("abcdefgh") + str(r.randint(0, 9)) for _ in range(40)] for _ in range(4)]
    out = [None, "", " \t", "one", "one two", "one two"]
    for _ in range(n):
        w = sum((b[(i := r.randint(0, 20)) : i + r.randint(0, most)] for b in r.choices(common, k=3)), [])
        for _ in range(r.randint(0, 2) if w else 0):
            w[r.randrange(len(w))] = "edit"
        out.append(" ".join(w))
    return out + [out[8], out[9], out[9]]


def sets_by_hand(texts, n):
    for t in texts:
        w = WORD.findall((t or "").lower())
        yield {tuple(w[i : i + n]) for i in range(len(w) - n + 1)} or ({tuple(w)} if w else set())


@pytest.mark.parametrize(("words", "least"), [(3, 90), (2, 80), (1, 60)])
def test_jaccard_components_equal_brute_force(spark, words, least):
    texts = words_of(words, 80, 30)
    sets = list(sets_by_hand(texts, words))
    root = list(range(len(sets)))
    for _ in sets:
        for i, a in enumerate(sets):
            for j, b in enumerate(sets[:i]):
                if a and b and root[i] != root[j] and 100 * len(a & b) >= least * len(a | b):
                    root[i] = root[j] = min(root[i], root[j])
    rows = spark.createDataFrame([(i, t, i) for i, t in enumerate(texts)], "doc_id long, text string, sig long")
    got = {r.doc_id: (r.n_shingles, r.component_id) for r in jaccard.jaccard_components(rows, words=words, least=least).collect()}
    assert got == {i: (len(s), root[i]) for i, s in enumerate(sets)}
    assert jaccard.jaccard_components(rows.limit(0), words=words, least=least).count() == 0


@pytest.mark.parametrize(("window", "seed"), [(13, 5), (4, 2)])
def test_windows_of_earlier_documents_go(spark, window, seed):
    texts = words_of(window, 60, 35)
    split = [WORD.findall(t or "") for t in texts]
    first = {}
    for i, w in enumerate(split):
        for j in range(len(w) - window + 1):
            first.setdefault(tuple(w[j : j + window]), i)
    rows = spark.createDataFrame([(i, t, 0) for i, t in enumerate(texts)] + [(None, texts[9], 0)], "doc_id long, text string, hits int")
    for r in rlz.substring_dedup(rows, words=window, seed=seed).collect():
        w = split[r.doc_id] if r.doc_id is not None else split[9]
        gone = set()
        for j in range(len(w) - window + 1 if r.doc_id is not None else 0):
            if first[tuple(w[j : j + window])] < r.doc_id:
                gone |= set(range(j, j + window))
        assert r.rlz_words == len(w) and r.rlz_removed == len(gone)
        assert r.rlz_kept == " ".join(x for j, x in enumerate(w) if j not in gone)


def test_top_k_equals_brute_force(spark):
    r = random.Random(4)
    vecs = [(i, [r.uniform(-1, 1) for _ in range(5)]) for i in range(300)]
    vecs += [(300 + i, list(vecs[i][1])) for i in range(40)] + [(400, None), (401, [1.0, None, 0.0, 0.0, 0.0]), (402, [float("nan")] * 5)]
    rows = spark.createDataFrame(vecs, "vec_id long, embedding array<double>")
    out = topk.voronoi_top_k(rows, F.col("vec_id") % 20 == 0, k=5, pivots=6).collect()
    whole = {i: [int(x * 256 // 1) for x in v] for i, v in vecs if i < 400}
    want = set()
    for q in range(0, 400, 20):
        if q in whole:
            ranked = sorted((-sum(a * b for a, b in zip(whole[q], v, strict=True)), i) for i, v in whole.items() if i != q)
            want |= {(q, k + 1, i, -s) for k, (s, i) in enumerate(ranked[:5])}
    assert {(x.query_id, x["rank"], x.vec_id, x.score) for x in out} == want and len(out) == len(want)


@pytest.mark.parametrize("own", [[(9.0, 0.25, 0.5)] * 7, [(9.0, a * x, b * y) for a in (1, -1) for b in (1, -1) for x, y in ((0.25, 0.5), (0.5, 0.25))]])
def test_top_k_of_an_id_in_many_rows(spark, own):
    """Own rows are no candidates, however many there are and in whatever cells."""
    r = random.Random(7)
    vecs = [(20, list(v)) for v in own] + [(1 + i, [r.uniform(-1, 1) for _ in range(3)]) for i in range(12)] + [(50, [0.5, 0.5, 0.5])] * 3
    rows = spark.createDataFrame(vecs, "vec_id long, embedding array<double>")
    whole = [(i, tuple(int(x * 256 // 1) for x in v)) for i, v in vecs]
    want = []
    for v in {v for i, v in whole if i == 20}:
        ranked = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in whole if i != 20)
        want += [(20, n + 1, i, -s) for n, (s, i) in enumerate(ranked[:5])]
    out = topk.voronoi_top_k(rows, F.col("vec_id") % 20 == 0, k=5, pivots=len(vecs)).collect()
    assert sorted((x.query_id, x["rank"], x.vec_id, x.score) for x in out) == sorted(want)


def best_by_hand(vecs, every, k=5):
    whole = [(i, tuple(int(x * 256 // 1) for x in v)) for i, v in vecs if i is not None and v is not None]
    out = set()
    for q, v in {(i, v) for i, v in whole if i % every == 0}:
        ranked = sorted((-sum(a * b for a, b in zip(v, w, strict=True)), i) for i, w in whole if i != q and len(w) == len(v))
        out |= {(q, n + 1, i, -s) for n, (s, i) in enumerate(ranked[:k])}
    return out


@pytest.mark.parametrize("large", [1.0, 1e6])
def test_top_k_of_mixed_dimensions_and_sizes(spark, large, monkeypatch):
    """Every dimension for itself, few candidates, blocks and parts of few rows, and integers beyond exact doubles."""
    monkeypatch.setattr(topk, "GROUP_QUERIES", 3)
    monkeypatch.setattr(topk, "BLOCK_ROWS", 16)
    r = random.Random(9)
    vecs = [(i, [large * r.uniform(-1, 1) for _ in range(r.choice([3, 4]))]) for i in range(120)]
    vecs += [(200, [1.0] * 7), (201, []), (None, [1.0] * 3), (210, None), (5, [large] * 3), (5, [large] * 3), (220, [large, 0.0, large])]
    rows = spark.createDataFrame(vecs, "vec_id long, embedding array<double>").withColumn("score", F.lit("mine"))
    out = topk.voronoi_top_k(rows, F.col("vec_id") % 10 == 0).collect()
    want = best_by_hand(vecs, 10)
    got = [(x.query_id, x["rank"], x.vec_id, x.score) for x in out]
    assert set(got) == want and len(got) == len(want)


def test_top_k_of_nothing_and_of_too_long_vectors(spark):
    none = spark.createDataFrame([], "vec_id long, embedding array<double>")
    assert topk.voronoi_top_k(none, F.col("vec_id") % 10 == 0).count() == 0
    alone = spark.createDataFrame([(10, [1.0])], "vec_id long, embedding array<double>")
    assert topk.voronoi_top_k(alone, F.col("vec_id") % 10 == 0).count() == 0
    long = spark.createDataFrame([(10, [1e9, 1.0]), (11, [2.0, 1.0])], "vec_id long, embedding array<double>")
    with pytest.raises(Exception, match="too long for scores"):
        topk.voronoi_top_k(long, F.col("vec_id") % 10 == 0).collect()


def test_hot_seeds_and_windows_combine_before_the_shuffle(spark, monkeypatch):
    plans = []
    write = rlz.staged
    monkeypatch.setattr(rlz, "staged", lambda df, label: (plans.append(df._jdf.queryExecution().executedPlan().toString()), write(df, label))[1])
    hot = " ".join(f"w{i}" for i in range(20))
    rows = spark.createDataFrame([(i, hot) for i in range(30)] + [(None, hot)], "doc_id long, text string")
    got = rlz.substring_dedup(rows).collect()
    assert sorted((r.doc_id or 0, r.rlz_removed) for r in got) == [(0, 0), (0, 0)] + [(i, 20) for i in range(1, 30)]
    assert {tuple(f) for r in got if r.doc_id for f in r.rlz_factors} == {(0, 20, 0, 0)}
    assert not [p for p in plans if "Window" in p]
    assert sum("partial_min(doc_id" in p and "partial_max(doc_id" in p for p in plans) == 2  # seeds, windows


def thue_morse(a, b, n=10):
    x, y = [a], [b]
    for _ in range(n):
        x, y = x + y, y + x
    return x, y


@pytest.mark.parametrize("seed", range(4))
def test_strings_whose_sums_are_equal_by_accident(spark, seed):
    """A shared passage, then a sequence and its complement, of equal sums modulo a power of two."""
    r = random.Random(seed)
    passages = []
    for _ in range(6):  # each ends 1024 letters behind a seed, so that the search for a stretch's end probes that of the sequence
        base = "".join(r.choice("abcdefgh ") for _ in range(3000))
        _, at = suffixes.chosen(np.frombuffer(base.encode(), np.uint8), 400)
        passages.append(base[: int(at[(at > 800) & (at < 1500)][0]) + 1024])
    x, y = ("".join(t) for t in thue_morse("a", "b"))
    texts = [t for p in passages for t in (p + x, p + y, x + p + "z", y + p + "y")]
    rows = spark.createDataFrame(list(enumerate(texts)), "doc_id long, text string")
    want = list(cut_by_hand(texts, 400))
    for row in suffixes.cut_repeats(rows).collect():
        assert (row.sa_bytes, [tuple(s) for s in row.sa_spans], bytes(row.sa_kept)) == want[row.doc_id]


@pytest.mark.parametrize("seed", range(4))
def test_words_whose_sums_are_equal_by_accident(spark, seed):
    r = random.Random(seed)
    passages = []
    for _ in range(6):
        base = [r.choice("abcdefgh") + str(r.randint(0, 99)) for _ in range(1300)]
        grams = rlz.Words([np.frombuffer(" ".join(base).encode(), np.uint8)], 8)
        at = rlz.minimizers(grams.grams, grams.row, 6)
        passages.append(base[: int(at[(at > 50) & (at < 200)][0]) + 1024])
    x, y = thue_morse("a", "b")
    split = [t for p in passages for t in (p + x, p + y, x + p + ["z"], y + p + ["y"])]
    first = {}
    for i, w in enumerate(split):
        for j in range(len(w) - 12):
            first.setdefault(tuple(w[j : j + 13]), i)
    rows = spark.createDataFrame([(i, " ".join(w)) for i, w in enumerate(split)], "doc_id long, text string")
    for row in rlz.substring_dedup(rows).collect():
        w = split[row.doc_id]
        gone = {k for j in range(len(w) - 12) if first[tuple(w[j : j + 13])] < row.doc_id for k in range(j, j + 13)}
        assert row.rlz_removed == len(gone) and row.rlz_kept == " ".join(v for k, v in enumerate(w) if k not in gone)
