"""Documents written by many tasks: valid, in order, and nothing left of a write that fails."""

import datetime as dt
import json
import os

import pytest
from pyspark.sql import functions as F

from tessella.operators import forms, hierarchy, rules
from tessella.sinks import exports, ordered
from tessella.sources import documents


def text_of(path):
    return b"".join(open(p, "rb").read() for p in ordered.document_files(str(path))).decode()


def test_a_large_document_is_valid_json(spark, tmp_path):
    n = 200_000
    rows = spark.range(n).select((F.col("id") % 3).cast("int").alias("section"), F.format_string("k%06d", "id").alias("key"), F.to_json(F.struct("id", F.lit("é\"").alias("t"), F.lit(2.0).alias("x"))).alias("value"))
    ordered.write_document(rows.repartition(7), str(tmp_path / "d"), exports._json_sections(("a", "b", "none", "c")[:3], '  "m": 1,\n'))
    data = json.loads(text_of(tmp_path / "d"))
    assert list(data) == ["m", "a", "b", "none"] and [len(data[k]) for k in ("a", "b", "none")] == [66667, 66667, 66666]
    assert list(data["b"]) == sorted(data["b"]) and data["a"]["k000003"] == {"id": 3, "t": "é\"", "x": 2}
    ordered.assemble(spark, str(tmp_path / "d"), str(tmp_path / "one.json"))
    assert json.loads((tmp_path / "one.json").read_text()) == data and sorted(os.listdir(tmp_path)) == ["d", "one.json"]


@pytest.mark.parametrize("given", [[], [1], [0, 2], [0, 0, 1, 2, 2]])
def test_empty_sections_and_no_rows(spark, tmp_path, given):
    rows = spark.createDataFrame([(s, f"k{i}", f'{{"v": {i}}}') for i, s in enumerate(given)], "section int, key string, value string")
    ordered.write_document(rows, str(tmp_path / "d"), exports._json_sections(("a", "b", "c"), ""))
    want = {n: {f"k{i}": {"v": i} for i, s in enumerate(given) if s == k} for k, n in enumerate("abc")}
    assert json.loads(text_of(tmp_path / "d")) == want
    sections = tuple(ordered.Section(f"{n}:\n", empty=f"{n}: {{}}\n") for n in "abc")
    ordered.write_document(rows, str(tmp_path / "y"), ordered.Layout(sections, form="yaml", indent=2))
    assert documents.load_yaml(text_of(tmp_path / "y")) == want


def test_a_failed_task_leaves_nothing(spark, tmp_path):
    path = tmp_path / "d"
    layout = exports._json_sections(("a",), "")
    good = spark.range(100).select(F.lit(0).alias("section"), F.col("id").alias("key"), F.lit("1").alias("value"))
    ordered.write_document(good.limit(1), str(path), layout)
    old = text_of(path)
    bad = good.withColumn("value", F.when(F.col("key") == 77, None).otherwise(F.col("value")))
    with pytest.raises(Exception, match="no value for"):
        ordered.write_document(bad, str(path), layout)
    assert text_of(path) == old and os.listdir(tmp_path) == ["d"]
    with pytest.raises(Exception, match="mode overwrite"):
        ordered.write_document(good, str(path), layout, mode="append")
    ordered.write_document(good, str(path), layout)
    assert len(json.loads(text_of(path))["a"]) == 100 and os.listdir(tmp_path) == ["d"]


def test_the_data_set_as_json_and_yaml(spark, tmp_path):
    genus, clade = documents.GENUS, documents.CLADE
    texts = [(f"genus: G{i}\nparent: {'Aaa' if i % 2 else 'Nope'}\nspecies:\n  - {{name: 'G{i} é', size: {{length_m: 2.0}}}}\n", f"/g/G{i}.yml") for i in range(30)]
    genera = documents.decode_documents(spark.createDataFrame(texts, "value string, _path string"), genus, "/g").cache()
    clades = documents.decode_documents(spark.createDataFrame([(f"clade: {c}\n", f"/c/{c}.yml") for c in ("Aaa", "Bbb")], "value string, _path string"), clade, "/c").cache()
    tree, built = {"Life": {"Aaa": None, "Bbb": {}}}, dt.datetime(2025, 3, 1, tzinfo=dt.UTC)
    want = exports.dataset(genera, clades, tree, built, "us")
    for form, load in (("json", json.loads), ("yaml", documents.load_yaml)):
        exports.write_dataset(genera, clades, tree, built, "us", str(tmp_path / form), form)
        got = load(text_of(tmp_path / form))
        assert got == json.loads(json.dumps(want)) and list(got["genera"]) == sorted(want["genera"])
    assert text_of(tmp_path / "json") == exports.to_json(want)
    exports.write_lookups({"diet": ["b", "a"], "countries": {"Z": "z", "A": "a"}}, hierarchy.edge_frame(spark, tree), str(tmp_path / "l"))
    assert text_of(tmp_path / "l") == exports.to_json({"diet": ["a", "b"], "countries": {"A": "a", "Z": "z"}, "stages": None, "clades": ["Aaa", "Bbb", "Life"]})
    ordered.assemble(spark, str(tmp_path / "l"), str(tmp_path / "lookups.json"))
    back = documents.read_json(spark, str(tmp_path / "lookups.json"), "diet array<string>, countries map<string,string>, clades array<string>, absent string").collect()
    assert [tuple(r) for r in back] == [(["a", "b"], {"A": "a", "Z": "z"}, ["Aaa", "Bbb", "Life"], None)]


def test_lists_below_a_header(spark, tmp_path):
    words = spark.createDataFrame([(w,) for w in ("zeta", "Alpha", "beta", "élan")], "word string")
    exports.write_word_list(words, str(tmp_path / "w"), ["made", "by hand"])
    assert text_of(tmp_path / "w") == "# made\n# by hand\nAlpha\nbeta\nélan\nzeta\n"
    refs = documents.decode_documents(spark.createDataFrame([("genus: A\nreferences:\n  - {id: r2, authors: X, year: 1900}\n  - {id: r1, title: T}\n", "/g/A.yml")], "value string, _path string"), documents.GENUS, "/g")
    none = documents.decode_documents(spark.createDataFrame([], "value string, _path string"), documents.CLADE, "/c")
    exports.write_bibliography(refs, none, str(tmp_path / "b"), ["Us"])
    assert text_of(tmp_path / "b") == "% Us\n\n@article{r2,\n  author = {X},\n  year = {1900}\n}\n@article{r1,\n  title = {T}\n}\n"


def test_reports_as_documents(spark, tmp_path):
    found = spark.createDataFrame([("a", "error", "f", "m"), ("b", "warning", "g", "n")], "check string, severity string, file string, message string")
    lines = []
    code = rules.report(found, ["a", "b", "c"], lines.append)
    assert exports.write_report(found, ["a", "b", "c"], str(tmp_path / "r")) == code == 1
    assert text_of(tmp_path / "r") == "".join(f"{line}\n" for line in lines)
    assert exports.write_report(found.where("check = 'b'"), ["b"], str(tmp_path / "r")) == 0


TEMPLATE = "body:\n  - id: diet\n    options:  # sync:schema:diets\n      - old\n"


def test_templates_are_checked_or_rewritten(spark, tmp_path):
    values, folder = {("schema", "diets"): ["b", "a"]}, tmp_path / "t"
    lines = []
    assert forms.sync_folder(spark, str(folder), values, write=lines.append) == 0
    (folder / "deep").mkdir(parents=True)
    for name in ("x.yml", "y y.yaml", "z.txt", "deep/w.yml"):
        (folder / name).write_text(TEMPLATE)
    new = TEMPLATE.replace("      - old\n", "      - a\n      - b\n")
    (folder / "done.yml").write_text(new)
    assert forms.sync_folder(spark, str(folder), values, check=True, write=lines.append) == 1
    assert (folder / "x.yml").read_text() == TEMPLATE and lines[1:] == ["Out of date:", "  - x.yml", "  - y y.yaml"]
    assert forms.sync_folder(spark, str(folder), values, write=lines.append) == 0
    assert {n: (folder / n).read_text() == new for n in ("x.yml", "y y.yaml", "z.txt", "deep/w.yml", "done.yml")} == {"x.yml": True, "y y.yaml": True, "z.txt": False, "deep/w.yml": False, "done.yml": True}
    assert sorted(os.listdir(folder)) == ["deep", "done.yml", "x.yml", "y y.yaml", "z.txt"]
    assert forms.sync_folder(spark, str(folder), values, check=True, write=lines.append) == 0
