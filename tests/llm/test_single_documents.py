"""Token counts, packing, quality, mixing, fingerprints and archives on small tables."""

import hashlib
import random
import zlib
from collections import Counter

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers
import pytest
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from tessella.llm import mixing, packing, quality, rlz, syncmers, tokens, warc

PATH = public_tokenizers.path("byte_bpe_50k.json")
SCHEMA = "doc_id long, text string, source string"
ODD = ["", " ", "  a", "a  b", "a \n b", "\n're x", "don't we've they'll I're 'r 'l", "\n 've", "日本語 テキスト", "é😀😀 á", "x" * 3000, " " * 500 + "a"]
ODD += ["<|endoftext|>", "a<|endoftext|>b<|endoftext|>", "a <|endoftext|> b", "<|<|endoftext|>", "!!!'re", "''re", "a\r\n b  \t c   ", "\n\n'>", "12 345  6a7", "a\x00b\x0bc"]


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def odd_rows():
    return [(i, t, f"s{i % 3}") for i, t in enumerate(ODD)] + [(None, None, None), (3, "twice", "s0"), (3, "twice", "s0")]


def noise(seed, n):
    r = random.Random(seed)
    return ["".join(r.choice("ab '\n\t.rle<|>é😀1Z") for _ in range(r.randint(1, 30))) for _ in range(n)]


def test_prefix_counts_equal_the_library_at_every_prefix(library):
    table = tokens.PrefixCounter(PATH)
    for text in ODD + noise(1, 200):
        text = text[:400]
        want = [len(e.ids) for e in library.encode_batch([text[:i] for i in range(len(text) + 1)], add_special_tokens=False)]
        assert table.counts(text).tolist() == want, text


def test_prefix_counts_of_rare_white_space(library):
    """Characters that Python, the pattern or only one of them takes for white space."""
    table = tokens.PrefixCounter(PATH)
    r = random.Random(5)
    texts = ["\n\n\x1d\t\x1fé", "\x1c a", " \x1f", "\u3000\u2028x"] + ["".join(r.choice("\x1c\x1d\x1e\x1f\x85\u2028\u3000\xa0 \n\taé1'.") for _ in range(r.randint(1, 14))) for _ in range(400)]
    for text in texts:
        want = [len(e.ids) for e in library.encode_batch([text[:i] for i in range(len(text) + 1)], add_special_tokens=False)]
        assert table.counts(text).tolist() == want, text


def test_prefix_counts_that_drop_at_once(library):
    """Steps of the count beyond a signed byte."""
    table = tokens.PrefixCounter(PATH)
    for text in ["\n" * 900 + "a", "😀" * 300, "\u3000" * 200 + "é" * 200, " " * 2000, "=" * 999 + "\n\n" + "-" * 300]:
        got = table.counts(text)
        for i in [*range(0, len(text), 97), len(text) - 1, len(text)]:
            assert got[i] == len(library.encode(text[:i], add_special_tokens=False).ids)
    table._unit = lambda u: np.array([200] + [0] * (len(u) - 2) + [-199], np.int32)
    assert table.counts("zq wx").tolist() == [0, 200, 1, 201, 201, 2]


def test_prefix_counts_with_a_small_cache_are_the_same(library):
    table = tokens.PrefixCounter(PATH, cache=3)
    for text in noise(2, 60):
        assert int(table.counts(text)[-1]) == len(library.encode(text, add_special_tokens=False).ids)


def test_token_query(spark, library):
    out = tokens.prefix_counts(spark.createDataFrame(odd_rows(), SCHEMA), PATH, budget=4, keep=True).collect()
    assert len(out) == len(ODD) + 3
    for r in out:
        text = "twice" if r.doc_id == 3 and r.n_bytes == 5 else ODD[r.doc_id] if r.doc_id is not None else ""
        assert r.n_bytes == len(text.encode()) and r.n_tokens == len(library.encode(text, add_special_tokens=False).ids)
        assert r.over_limit == (r.n_tokens > 4) and len(r.counts) == len(text) + 1
        assert r.fits_chars == max(i for i, c in enumerate(r.counts) if c <= 4)
    assert tokens.prefix_counts(spark.createDataFrame([], SCHEMA), PATH).count() == 0


@pytest.mark.parametrize("open_windows", [1, 8])
def test_packing_covers_each_id_once(spark, library, open_windows):
    rows = odd_rows() + [(100 + i, " ".join(noise(i, 40 * (i % 7))), "x") for i in range(60)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    out = packing.pack(df, PATH, size=64, open_windows=open_windows, merge=2).toPandas()
    for doc_id, text, _ in rows:
        if doc_id in (None, 3):
            continue
        ids = np.array([*library.encode(text, add_special_tokens=False).ids, 0], "<u4")
        mine = out[out.doc_id == doc_id].sort_values("start")
        assert mine.length.sum() == len(ids) and (mine.doc_tokens == len(ids)).all()
        assert mine.start.tolist() == [0, *mine.length.cumsum()[:-1]]
        assert mine.ids_crc32.tolist() == [zlib.crc32(ids[s : s + n].tobytes()) for s, n in zip(mine.start, mine.length, strict=True)]
    for _, seq in out.sort_values("offset").groupby("sequence_id"):
        assert seq.length.sum() <= 64 and seq.offset.tolist() == [0, *seq.length.cumsum()[:-1]]
    assert len(out[out.doc_id == 3]) >= 3
    assert packing.pack(spark.createDataFrame([], SCHEMA), PATH).count() == 0


def test_packing_pads_little(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    out = packing.pack(df, PATH)
    used = out.groupBy("sequence_id").agg(F.sum("length").alias("n")).agg(F.sum("n"), F.count("*")).first()
    assert used[0] / (used[1] * 1024) > 0.99


def brute_quality(move, s):
    """Marginals of a short chain by listing all labellings."""
    from itertools import product

    total, on = 0.0, np.zeros(len(s))
    for y in product((0, 1), repeat=len(s)):
        w = np.exp(sum(a * b for a, b in zip(y, s, strict=True)) + sum(move[a, b] for a, b in zip(y, y[1:], strict=False)))
        total += w
        on += w * np.array(y)
    return on / total


def test_forward_backward_against_enumeration():
    r = np.random.default_rng(1)
    move, row = r.normal(size=(2, 2)), np.array([0, 0, 0, 0, 1, 2, 2])
    s = r.normal(size=7)
    f, b = quality.forward_backward(s, row, move)
    want = np.concatenate([brute_quality(move, s[row == k]) for k in range(3)])
    assert np.allclose(1 / (1 + np.exp(-(f + b))), want)


def test_quality_separates_held_out_documents(spark):
    d = "/root/testdata/sf0.01"
    docs, labels = spark.read.parquet(f"{d}/documents.parquet"), spark.read.parquet(f"{d}/labels.parquet")
    got = quality.op4_quality(spark, d).join(labels, "doc_id").where("held_out").toPandas()
    rank = got.score.rank()
    good, bad = rank[got.quality == 1], rank[got.quality == 0]
    assert (good.mean() - bad.mean()) / len(got) + 0.5 > 0.97
    assert ((got.score >= 0.3) == (got.quality == 1)).mean() > 0.95
    assert docs.count() == quality.op4_quality(spark, d).count()


def test_quality_of_odd_texts_and_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    df = spark.createDataFrame([(*r, 1.0) for r in odd_rows()], SCHEMA + ", score double")
    model = quality.fit_quality(df, none)
    out = quality.score_quality(df, model).toPandas()
    assert len(out) == len(df.collect()) and out.quality_score.between(0, 1).all() and "score" in out
    assert (out.quality_score[out.text.isna()] == 0).all()


@pytest.mark.parametrize("times", [1, 50, 400])
def test_mixing_takes_as_many_of_equal_rows_as_fit(spark, times):
    """Four documents in many equal rows each, beside sources that leave them a target of their own."""
    rows = [(i, f"a b c d e{i}", "t") for i in range(4)] * times + [(100 + i, " ".join(f"w{j}" for j in range(7)), "u") for i in range(times)] + [(None, "x y z", None)] * (3 * times)
    df = spark.createDataFrame(rows, SCHEMA).repartition(5)
    got = mixing.mix_sources(df).toPandas()
    assert len(got) == len(rows)
    for _, g in got.groupby("source", dropna=False):
        assert abs((g.mix_copies * g.mix_size).sum() - g.mix_target.iloc[0]) <= g.mix_size.max() / 2
    con = duckdb.connect()
    con.register("documents", pd.DataFrame(rows, columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"}))
    want = Counter((str(r[0]), r[1], r[4]) for r in con.sql(mixing.OP7_SQL).fetchall())
    assert Counter(("None" if pd.isna(r.doc_id) else str(int(r.doc_id)), r.mix_size, r.mix_copies * r.mix_size) for r in got.itertuples()) == want


def test_mixing_meets_targets(spark):
    r = random.Random(3)
    rows = [(i, " ".join(["w"] * r.randint(0, 40)), r.choice(["a", "b", "c", "d", None])) for i in range(800)]
    rows += [(5, "w w", "a"), (5, "w w", "a"), (None, "w", "b"), (801, None, "c"), (802, "", "e")]
    df = spark.createDataFrame(rows, SCHEMA).withColumn("size", F.lit("mine"))
    out = mixing.mix_sources(df, buckets=16)
    got = out.toPandas()
    assert got.mix_copies.between(0, 2).all() and len(got) == len(rows)
    per = got.assign(taken=got.mix_copies * got.mix_size).groupby("source", dropna=False).agg(taken=("taken", "sum"), target=("mix_target", "first"), size=("mix_source_size", "first"))
    assert (abs(per.taken - per.target) <= 45).all()
    assert abs(per.target.sum() - 1.5 * got.mix_size.sum()) < 1e-6 and (per.target <= 2 * per["size"]).all()
    again = mixing.mix_sources(df.repartition(7), buckets=16).toPandas()
    key = ["doc_id", "text", "mix_copies"]
    assert sorted(map(repr, got[key].values.tolist())) == sorted(map(repr, again[key].values.tolist()))
    assert mixing.repeat_copies(out, df.columns).count() == got.mix_copies.sum()
    assert mixing.mix_sources(df.limit(0)).count() == 0


def test_fingerprints_against_the_plain_definition(spark):
    r = random.Random(4)
    rows = [(i * 3 - 20, " ".join(noise(i, r.randint(0, 30))), "x") for i in range(40)] + [(None, None, None), (None, "zzz", None), (8, "", "x")]
    got = {(x.doc_id, x.n_chars): x for x in syncmers.fingerprints(spark.createDataFrame(rows, SCHEMA).repartition(5)).collect()}
    assert len(got) == len(rows)
    text = {i: t for i, t, _ in rows if i is not None}
    ids = sorted(text, reverse=True)
    for a, b in zip(ids, ids[1:], strict=False):
        half = len(text[a]) // 2
        edited = text[a][: len(text[a]) - half] + text[b][:half]
        x = got[a, len(text[a])]
        assert x.edited_sha256 == hashlib.sha256(edited.encode()).hexdigest()
        assert x.fingerprint == syncmers.fingerprint(text[a].encode()) and x.edited_fingerprint == syncmers.fingerprint(edited.encode())
        assert x.near_next == syncmers.likeness(x.fingerprint, got[b, len(text[b])].fingerprint) and 0 <= x.near_edited <= 1
    assert syncmers.fingerprints(spark.createDataFrame([], SCHEMA)).count() == 0
    assert syncmers.fingerprints(spark.createDataFrame([(1, "abcd", "x")], SCHEMA)).first().edited_sha256 == hashlib.sha256(b"abab").hexdigest()


def test_fingerprints_of_long_texts_grow():
    r = random.Random(8)
    everything = 1 << 40
    err = []
    for _ in range(6):
        shared = " ".join(str(r.randint(0, 10**6)) for _ in range(600))
        a, b = (f"{' '.join(str(r.randint(0, 10**6)) for _ in range(9400))} {shared}".encode() for _ in range(2))
        x, y = syncmers.fingerprint(a), syncmers.fingerprint(b)
        assert len(x) // 16 > len(set(syncmers.anchors(a)[0].tolist())) / 9
        whole = syncmers.likeness(*(syncmers.fingerprint(t, keep=everything) for t in (a, b)), keep=everything)
        assert 0.05 < whole < 0.07 and syncmers.likeness(x, y) > 0
        err.append(abs(syncmers.likeness(x, y) - whole))
    assert max(err) < 0.015
    short = b"a short text of fewer anchors than are kept at least, with all of them held"
    assert len(syncmers.fingerprint(short)) == 16 * len(set(syncmers.anchors(short)[0].tolist()))


def test_syncmers_by_definition():
    raw = " ".join(noise(9, 30)).encode()
    h, at = syncmers.anchors(raw, 12, 5)
    small = [hash_of(raw[i : i + 5]) for i in range(len(raw) - 4)]
    want = [i for i in range(len(raw) - 11) if min(small[i : i + 8]) in (small[i], small[i + 7])]
    assert at.tolist() == want
    old, syncmers.BLOCK = syncmers.BLOCK, 50
    try:
        h2, at2 = syncmers.anchors(raw, 12, 5)
    finally:
        syncmers.BLOCK = old
    assert at2.tolist() == want and (h == h2).all()


def hash_of(b):
    from tessella.llm.common import gram_hashes

    return int(gram_hashes(np.frombuffer(b, np.uint8), len(b))[0])


def test_likeness_of_half_edited_texts(spark):
    got = syncmers.op9_fingerprints(spark, "/root/testdata/sf0.001").toPandas()
    far = got[got.n_chars > 300]
    assert far.near_edited.between(0.2, 0.9).mean() > 0.9 and far.near_next.median() < 0.1


def test_archives_round_trip(spark, tmp_path):
    big = "<p>" + "word " * 50
    rows = [(4, "http://a", big), (2, "http://b", big), (9, None, big), (1, "http://c", "x"), (3, "u\r\nv", "x"), (5, "d", None), (6, "d", ""), (None, "n", big)]
    rows += [(20 + i, f"http://h/{i}", f"<html>{i} é " + "body " * i) for i in range(200)] + [(2, "http://b", big)]
    folder = f"file://{tmp_path}/w"
    df = spark.createDataFrame(rows, "page_id long, url string, html string").repartition(3)
    assert warc.write_archives(df, folder, archive_bytes=20_000) == len(rows)
    got = warc.read_archives(spark, folder).collect()
    want = sorted(repr((i, (h or "").encode())) for i, _, h in rows)
    by_page = {(r.page_id, r.payload_digest): r for r in got if r.record_type == "response"}
    full = [(r.page_id, bytes(r.payload if r.payload is not None else by_page[r.refers_to, r.payload_digest].payload)) for r in got]
    assert sorted(map(repr, full)) == want
    revisits = sorted((r.page_id is None, r.page_id, r.refers_to) for r in got if r.record_type == "revisit")
    assert [x[1:] for x in revisits] == [(4, 2), (9, 2), (None, 2)]
    assert all(r.payload_bytes == len(p) for r, (_, p) in zip(got, full, strict=True))


def test_archives_of_failed_attempts_do_not_count(spark, tmp_path):
    folder = f"file://{tmp_path}/again"
    df = spark.createDataFrame([(i, "u", f"page {i}") for i in range(20)], "page_id long, url string, html string").repartition(2)
    assert warc.write_archives(df, folder) == 20
    left = next((tmp_path / "again").glob("*.warc.zst"))
    left.with_name("part-000000-0000000000-0007.warc.zst").write_bytes(left.read_bytes())
    assert sorted(r.page_id for r in warc.read_archives(spark, folder).collect()) == list(range(20))


def test_added_names_are_refused(spark):
    df = spark.createDataFrame([(1, "a", "s", 2)], "doc_id long, text string, source string, clash int")
    model = quality.fit_quality(df, spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    for make, name in ((lambda d: quality.score_quality(d, model), "Quality_score"), (mixing.mix_sources, "mix_size"), (rlz.substring_dedup, "rlz_words")):
        with pytest.raises(ValueError, match=name.lower()):
            make(df.withColumnRenamed("clash", name))
    with pytest.raises(ValueError, match="whole number"):
        rlz.substring_dedup(df.withColumn("doc_id", F.lit("x")))


def test_broken_archives_are_refused(tmp_path):
    ok = warc.archive([warc.record(i, "u", b"payload %d" % i, hashlib.sha256(b"payload %d" % i).hexdigest(), None, str(i)) for i in range(80)])
    assert len(list(map(warc.parse, warc.frames(ok)))) == 80
    for bad in (ok[:-3], ok[4:], ok[:100], ok[:-10] + b"\0" * 10):
        with pytest.raises(warc.WarcError):
            list(map(warc.parse, warc.frames(bad)))
    raw = next(warc.frames(ok))
    for old, new in ((b"WARC/1.1", b"WORC/1.1"), (b"payload 0", b"payload 9"), (b"Content-Length: ", b"Content-Length: 9"), (b"WARC-Date", b"WARC-Type")):
        with pytest.raises(warc.WarcError):
            warc.parse(raw.replace(old, new))


def test_empty_pages(spark, tmp_path):
    df = spark.createDataFrame([], "page_id long, url string, html string")
    folder = f"file://{tmp_path}/none"
    assert warc.write_archives(df, folder) == 0
    assert warc.read_archives(spark, folder).count() == 0


def test_seeds_and_texts_leave_a_task_in_few_batches():
    import pyarrow as pa

    from tessella.llm import suffixes

    texts = [f"{i} " + "some words of a text " * 25 for i in range(50)]
    given = pa.RecordBatch.from_pydict({"key": list(range(50)), "tag": [0] * 50, "text": texts})
    seeds, packed = list(suffixes._seeds(400)(iter([given]))), list(suffixes._packed(iter([given])))
    assert len(seeds) == len(packed) == 1
    assert set(seeds[0].column("key").to_pylist()) == set(packed[0].column("key").to_pylist()) == set(range(50))
