"""The stages of the corpus pipeline against plain Python."""

import random
import zlib
from collections import Counter, defaultdict

import duckdb
import numpy as np
import pandas as pd
import public_tokenizers

import corpus_pipeline
from tessella.llm import mixing, quality

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def passage(name, n=40):
    return " ".join(f"{name}{i}" for i in range(n))


def documents(spark, rows):
    return spark.createDataFrame([(i, t, "en", "s", len(t or "")) for i, t in rows], SCHEMA).repartition(3)


def test_one_document_of_each_group_stays(spark):
    a, b, c = passage("a"), passage("b"), passage("c")
    rows = [(5, a), (3, a + " more"), (None, a), (None, b), (None, b), (None, b + " more"), (7, c), (7, c), (None, None), (None, ""), (8, ""), (None, "word"), (None, "Word")]
    got = corpus_pipeline.drop_near_duplicates(spark, documents(spark, rows), "").collect()
    want = [(3, a + " more"), (None, b), (7, c), (None, None), (None, ""), (8, ""), (None, "Word")]
    assert sorted(map(repr, [(r.doc_id, r.text) for r in got])) == sorted(map(repr, want))
    assert all(r.lang == "en" and r.source == "s" and r.n_chars == len(r.text or "") for r in got)
    assert corpus_pipeline.drop_near_duplicates(spark, documents(spark, rows).limit(0), "").count() == 0


def cut_by_hand(rows, window=13):
    """What is left of each text, or nothing, where 13 words in a row also start in a text of smaller id."""
    least = {}
    words = {k: (t or "").split() for k, (_, t) in enumerate(rows)}
    for k, (i, _) in enumerate(rows):
        for p in range(len(words[k]) - window + 1):
            key = tuple(words[k][p : p + window])
            least[key] = min(i, least.get(key, i))
    for k, (i, t) in enumerate(rows):
        gone = {q for p in range(len(words[k]) - window + 1) if least[tuple(words[k][p : p + window])] < i for q in range(p, p + window)}
        left = [w for q, w in enumerate(words[k]) if q not in gone]
        if not gone:
            yield i, t
        elif left:
            yield i, " ".join(left)


def test_passages_of_earlier_documents_go(spark):
    a, b, short = passage("a"), passage("b", 13), passage("c", 12)
    rows = [(1, f"x  {a}\ty"), (2, f"u {a} v"), (3, a), (4, f"{b} {b}"), (5, f"p {b} {short} q"), (6, short), (7, None), (8, ""), (9, " \n"), (9, b), (9, f"{b} z")]
    got = corpus_pipeline.cut_repeated_passages(spark, documents(spark, rows), "").collect()
    assert sorted(map(repr, [(r.doc_id, r.text) for r in got])) == sorted(map(repr, cut_by_hand(rows)))
    assert all(r.lang == "en" and r.source == "s" and r.n_chars == len(r.text or "") for r in got)
    assert corpus_pipeline.cut_repeated_passages(spark, documents(spark, rows).limit(0), "").count() == 0


def counted(rows):
    return Counter(map(repr, rows))


def test_the_classifier_keeps_what_it_scores_well(spark, tmp_path):
    good = "\n".join("The river was long and the people of the town went there often." for _ in range(6))
    bad = "\n".join("$$$ click >>> 0x99 ### ||| @@@ 12345" for _ in range(6))
    rows = [(i, good if i % 2 else bad) for i in range(40)] + [(None, good), (None, bad), (50, None), (51, ""), (52, " \n"), (1, good), (1, good), (53, good + "\n" + bad)]
    spark.createDataFrame([(i, i % 2, 0) for i in range(40)], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    docs = documents(spark, rows)
    got = corpus_pipeline.reject_low_quality(spark, docs, str(tmp_path))
    model = quality.fit_quality(docs, spark.read.parquet(f"{tmp_path}/labels.parquet"))
    want = []
    for i, t in rows:
        raw = np.frombuffer((t or "").encode(), np.uint8)
        if quality.scores(model, raw, np.array([0, len(raw)]))[0] >= 0.3:
            want.append((i, t))
    assert counted((r.doc_id, r.text) for r in got.collect()) == counted(want) and (1, good) in want and (0, bad) not in want
    assert got.columns == corpus_pipeline.COLUMNS and corpus_pipeline.reject_low_quality(spark, docs.limit(0), str(tmp_path)).count() == 0


def mixed_by_sql(rows):
    con = duckdb.connect()
    con.register("documents", pd.DataFrame([(i, t, s) for i, t, _, s, _ in rows], columns=["doc_id", "text", "source"]).astype({"doc_id": "Int64"}))
    for i, size, _, _, taken in con.sql(mixing.OP7_SQL).fetchall():
        yield (i, size), (taken // size if size else None)


def test_the_mix_repeats_rows_as_its_sql_says(spark):
    rows = [(i, " ".join(f"w{j}" for j in range(3 + i % 9)), "en", s, 1) for i, s in enumerate(["a", "b", "c", None] * 30)]
    rows += [(None, "x y", "en", "a", 1), (7, "twice is here", "en", "d", 1), (7, "twice is here", "en", "d", 1), (8, None, None, "e", None), (9, "", "en", None, 0)]
    df = spark.createDataFrame(rows, SCHEMA).repartition(3)
    got = Counter((r.doc_id, len((r.text or "").split())) for r in corpus_pipeline.mix_to_weights(spark, df, "").collect())
    want = Counter()
    for key, copies in mixed_by_sql(rows):
        if copies:
            want[key] += copies
    assert {k: n for k, n in got.items() if k[1]} == dict(want)
    assert corpus_pipeline.mix_to_weights(spark, df.limit(0), "").count() == 0


def packed_texts(rows, given):
    """Whether the pieces of all documents are those of their token ids, in sequences without gaps."""
    from tokenizers import Tokenizer

    library = Tokenizer.from_file(public_tokenizers.path("byte_bpe_50k.json"))
    ids = [[*library.encode(t or "", add_special_tokens=False).ids, 0] for t in given]
    pieces = Counter((r.doc_tokens, r.start, r.length, r.ids_crc32) for r in rows)
    sequences = defaultdict(list)
    for r in rows:
        sequences[r.sequence_id].append((r.offset, r.length))
    for parts in sequences.values():
        parts.sort()
        assert [o for o, _ in parts] == [sum(n for _, n in parts[:k]) for k in range(len(parts))] and sum(n for _, n in parts) <= 1024
    covered = Counter()
    for r in rows:
        covered[r.doc_tokens] += r.length
    assert covered == Counter({n: n * sum(len(x) == n for x in ids) for n in {len(x) for x in ids}})
    return pieces == Counter((len(x), s, min(1024, len(x) - s), zlib.crc32(np.array(x[s : s + 1024], "<u4").tobytes())) for x in ids for s in range(0, len(x), 1024))


def test_packing_covers_repeats_ties_and_long_texts(spark):
    long = " ".join(f"word{i}" for i in range(4000))
    given = [(i, t) for i, t in enumerate([long, long + " end", None, "", "tie one", "tie two"] + [f"a b c {i}" for i in range(300)])] + [(4, "tie one"), (None, "no id")]
    for parts in (1, 5):
        rows = corpus_pipeline.pack_sequences(spark, documents(spark, given).repartition(parts), "").collect()
        assert packed_texts(rows, [t for _, t in given])
    assert corpus_pipeline.pack_sequences(spark, documents(spark, given).limit(0), "").count() == 0


def test_the_whole_run_equals_its_stages_by_hand(spark, tmp_path):
    words = ["river", "town", "people", "house", "water", "road", "field", "stone"]
    r = random.Random(3)
    prose = ["\n".join(" ".join(["The", *r.choices(words, k=9), f"x{r.randrange(999)}."]) for _ in range(8)) for _ in range(30)]
    rows = [(i, t, "en", f"s{i % 3}", len(t)) for i, t in enumerate(prose)]
    rows += [(40, prose[3] + " more", "en", "s0", 1), (41, prose[5], "en", "s1", 1), (42, passage("p") + "\n" + prose[0][:30], "en", "s2", 1), (43, "one " + passage("p"), "en", "s2", 1)]
    rows += [(50 + i, "\n".join("$$$ ### @@@ 0x1 |||" for _ in range(6)), "en", "s1", 1) for i in range(10)]
    spark.createDataFrame(rows, SCHEMA).write.parquet(f"{tmp_path}/documents.parquet")
    spark.createDataFrame([(i, int(i < 50), 0) for i, *_ in rows], "doc_id long, quality int, toxic int").write.parquet(f"{tmp_path}/labels.parquet")
    left, source = {i: t for i, t, *_ in rows}, {i: s for i, _, _, s, _ in rows}
    model = quality.fit_quality(spark.read.parquet(f"{tmp_path}/documents.parquet"), spark.read.parquet(f"{tmp_path}/labels.parquet"))
    left = {i: t for i, t in left.items() if quality.scores(model, np.frombuffer(t.encode(), np.uint8), np.array([0, len(t.encode())]))[0] >= 0.3}
    shingles = {i: {tuple(w[k : k + 5]) for k in range(len(w) - 4)} for i, t in left.items() for w in [t.lower().split()]}
    root = {i: i for i in left}
    for _ in left:
        for a in left:
            for b in left:
                if 100 * len(shingles[a] & shingles[b]) >= 80 * len(shingles[a] | shingles[b]):
                    root[a] = root[b] = min(root[a], root[b])
    left = dict(cut_by_hand(sorted((i, t) for i, t in left.items() if root[i] == i)))
    assert len(left) >= 20 and 41 not in left and 50 not in left
    final = []
    for (i, _), copies in mixed_by_sql([(i, t, "en", source[i], 0) for i, t in left.items()]):
        final += [left[i]] * (copies or 0)
    assert packed_texts(corpus_pipeline.run(spark, str(tmp_path)).collect(), final)
