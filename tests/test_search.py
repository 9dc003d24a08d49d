"""Search by grams against a scan."""

import random

import pytest

from tessella.operators import search


@pytest.fixture(scope="module")
def index(spark, tmp_path_factory):
    r = random.Random(2)
    path = str(tmp_path_factory.mktemp("index"))
    names = [(i, "".join(r.choice("abAB é") for _ in range(r.randint(0, 9)))) for i in range(900)] + [(900, None), (901, "aaaa"), (902, "Abcabc")]
    search.build_index(spark.createDataFrame(names, "id long, name string").repartition(3), "name", "id", path)
    return path, names


@pytest.mark.parametrize("text", ["", "a", "AB", "aba", "bÉa", "abab", "aaaa", "abcabc", "zzz", "%a_"])
def test_hits_equal_a_scan(spark, index, text):
    path, names = index
    want = [(i, n) for i, n in sorted(names) if n is not None and text.lower() in n.lower()]
    assert [tuple(r) for r in search.search(spark, path, text).collect()] == want[:50]
    assert search.search(spark, path, text, most=10**6).count() == len(want)


def test_all_names_are_read_for_short_texts_only(spark, index):
    long = search.search(spark, index[0], "abab")._jdf.queryExecution().executedPlan().toString()
    assert "postings" in long and "In(gram" in long
    assert "postings" not in search.search(spark, index[0], "ab")._jdf.queryExecution().executedPlan().toString()


def test_an_index_of_nothing(spark, tmp_path):
    search.build_index(spark.createDataFrame([], "id long, name string"), "name", "id", str(tmp_path))
    assert search.search(spark, str(tmp_path), "abc").count() == 0 and search.search(spark, str(tmp_path), "a").count() == 0
