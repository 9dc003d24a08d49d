"""Dictionaries of many terms against a plain loop."""

import random

import pytest

from tessella.operators import linkage


def first_by_hand(text, terms):
    if text is None:
        return None
    hits = [(pos, value) for term, value, pos in terms if term is not None and term.lower() in text.lower()]
    return min(hits)[1] if hits else None


def test_many_terms_equal_a_loop(spark):
    r = random.Random(5)
    letters = "abcdé "
    terms = [("".join(r.choice(letters) for _ in range(r.randint(5, 12))), f"v{i % 997}", r.randrange(40_000)) for i in range(50_000)] + [(None, "never", 0), ("ABC", "upper", 50_000)]
    texts = ["".join(r.choice(letters.upper() if i % 3 == 0 else letters) for _ in range(r.randint(0, 60))) for i in range(150)] + [None, "", "xyz", "zabcz"]
    df = spark.createDataFrame([(i, t, "kept") for i, t in enumerate(texts)], "id long, text string, pos string").repartition(3)
    d = spark.createDataFrame(terms, "term string, value string, pos int")
    want = {i: first_by_hand(t, terms) for i, t in enumerate(texts)}
    for most in (linkage.TERM_BYTES, 1 << 19):
        found = linkage.first_match_join(df, "text", d, "hit", most_bytes=most)
        assert found.columns == ["id", "text", "pos", "hit"]
        assert {r.id: r.hit for r in found.collect()} == want
        assert "NestedLoop" not in found._jdf.queryExecution().executedPlan().toString()
    assert sum(v is not None for v in want.values()) > 20


@pytest.mark.parametrize(("terms", "want"), [([], [None, None, None]), ([("", "all", 3), ("b", "b", 1)], ["all", "b", None]), ([("b", "y", 1), ("B", "x", 1), ("b", "w", 2)], [None, "x", None])])
def test_empty_terms_ties_and_no_terms(spark, terms, want):
    df = spark.createDataFrame([(1, ""), (2, "abc"), (3, None)], "id int, text string")
    d = spark.createDataFrame(terms, "term string, value string, pos int")
    assert [r.hit for r in linkage.first_match_join(df, "text", d, "hit").orderBy("id").collect()] == want
    assert linkage.first_match_join(df.limit(0), "text", d, "hit").count() == 0
