"""Candidate values from captured answers, form fields and rules on streams, against plain expectations."""

import json

import pytest
from pyspark.sql import functions as F

from tessella.operators import forms, linkage, rules
from tessella.sources import candidates
from tessella.streaming.rules import watch

SCHEMA = {
    "periods": ["Jurassic", "Cretaceous"],
    "stages": {"Campanian": {}, "Albian": {}},
    "diet": ["herbivore", "carnivore"],
    "countries": {"NE": "Niger", "NG": "Nigeria", "US": "United States"},
}
CLADES = ["Theropoda", "Sauropoda"]


def values(df):
    return {r.header: r.value for r in df.collect()}


def test_taxa_give_candidates(spark):
    rows = [
        ("a", "A b", "Marsh, 1877", "carnivory", "Campanian", "", "theropoda", "Hell Creek", "US", "MT", "47.5", "-106.9"),
        ("b", None, None, "unknown", "", "Late Jurassic", "NO_FAMILY_SPECIFIED", "", "ZZ", None, "1", ""),
        ("c", None, None, "Herbivore", "Late Jurassic", "Albian", "Nothing", None, None, None, None, None),
    ]
    got = {}
    for r in candidates.from_taxa(spark.createDataFrame(rows, candidates.TAXON), SCHEMA, CLADES).collect():
        got.setdefault(r.subject, {})[r.header] = (r.value, r.display_value, r.source)
    first = {h: v[0] for h, v in got["a"].items()}
    assert first == {
        "Type species name": "A b", "Authors": "Marsh", "Year described": "1877", "Diet": "carnivore", "Stage": "Campanian", "Parent clade": "Theropoda",
        "Formation": "Hell Creek", "Country": "US", "Region": "MT", "Coordinates": "47.5, -106.9",
    }
    assert got["a"]["Country"] == ("US", "United States", "PBDB") and "b" not in got
    assert {h: v[0] for h, v in got["c"].items()} == {"Diet": "herbivore", "Period": "Jurassic", "Stage": "Albian"}


def test_articles_give_candidates(spark):
    page = "{{Speciesbox\n| genus = Allo\n| species = fragilis\n| temporal_range = Late [[Jurassic]]\n| authority = Marsh, O.C., 1877\n| location = Nigeria\n}}\n'''Allo''' was a predatory, bipedal animal.\n== Etymology ==\nFrom ''allos''.\n"
    html = '<span class="IPA nowrap" lang="en-fonipa"><a href="x">/<b>al</b>&nbsp;o/</a></span>'
    schema = "subject string, wikitext string, sections array<struct<line:string,level:string>>, html string, extract string"
    rows = [("a", page, [("Etymology", "2")], html, None), ("b", None, None, None, "Short (  ) line.\nmore")]
    fields = candidates.article_fields(spark.createDataFrame(rows, schema))
    got = values(candidates.from_articles(fields.where("subject = 'a'"), SCHEMA))
    assert got == {
        "Type species name": "Allo fragilis", "Period": "Jurassic", "Authors": "Marsh, O.C.", "Year described": "1877", "Country": "NE", "Diet": "carnivore",
        "Genus description": "Allo was a predatory, bipedal animal.", "Genus etymology": "From allos.", "Locomotion": "bipedal", "Pronunciation (IPA)": "/alo/",
    }
    assert values(candidates.from_articles(fields.where("subject = 'a'"), SCHEMA, compat=False))["Country"] == "NG"
    assert values(candidates.from_articles(fields.where("subject = 'b'"), SCHEMA)) == {"Genus description": "Short line."}


def test_entities_and_the_merge(spark):
    def claim(value):
        return [{"mainsnak": {"snaktype": "value", "datavalue": {"value": value}}}]

    given = {"P427": claim({"id": "Q1"}), "P186": claim({"id": "Q2"}), "P171": claim({"id": "Q3"}), "P2067": claim({"amount": "+2.5", "unit": "e/Q100995"})}
    entities = spark.createDataFrame([("a", "Q9", json.dumps(given)), ("b", None, None)], "subject string, qid string, claims string")
    labels = spark.createDataFrame([("Q1", "A b"), ("Q2", "herbivory"), ("Q3", "SAUROPODA")], "qid string, label string")
    fields = candidates.entity_fields(entities, labels)
    third = candidates.from_entities(fields, SCHEMA, CLADES)
    assert values(third) == {"Type species name": "A b", "Diet": "herbivore", "Estimated weight (kg)": "1", "Parent clade": "Sauropoda", "External identifiers": "wikidata: Q9"}
    other = spark.createDataFrame([("a", "Diet", "carnivore", None, "select", "PBDB"), ("a", "External identifiers", "pbdb: 1", None, "textarea", "PBDB"), ("a", "Parent clade", "", None, "search", "PBDB")], third.schema)
    got = {r.header: (r.value, r.source) for r in candidates.merged(other, third).collect()}
    assert got["Diet"] == ("carnivore", "PBDB") and got["External identifiers"] == ("wikidata: Q9", "Wikidata") and got["Parent clade"] == ("Sauropoda", "Wikidata")


def test_children_and_first_records(spark):
    children = spark.createDataFrame([("a", "genus", "x", 0), ("a", "species", "late", 3), ("a", "species", "early", 1)], "subject string, rank string, name string, pos int")
    assert candidates.type_species_of(children).collect() == [("a", "early")]
    assert candidates.first_record(children, "subject", "pos").first().name == "x"
    assert candidates.type_species_of(children.limit(0)).count() == 0


@pytest.mark.parametrize(("text", "compat", "want"), [("in Nigeria", True, "NE"), ("in Nigeria", False, "NG"), ("nowhere", True, None), (None, True, None), ("UNITED states", True, "US")])
def test_countries(spark, text, compat, want):
    df = spark.createDataFrame([(text,)], "t string")
    assert df.select(linkage.match_country(F.col("t"), SCHEMA["countries"], compat)).first()[0] == want


def test_two_keys_of_an_existing_name(spark):
    new = spark.createDataFrame([(" Allo ", "Fragilis"), ("Allo", "atrox"), (None, "fragilis")], "g string, s string")
    old = spark.createDataFrame([("allo", "fragilis")], "genus string, name string")
    assert [r.s for r in linkage.exists_name(new, {"g": "genus", "s": "name"}, old).collect()] == ["Fragilis"]
    got = {r.s: r.problem for r in forms.new_name(new.where("g IS NOT NULL"), "s", old, "edit", {"g": "genus"}).collect()}
    assert got == {"Fragilis": '"fragilis" already exists under Allo — use the edit flow instead', "atrox": None}
    assert forms.new_name(new, "s", old, "edit").where("problem LIKE '%in the dataset%'").count() == 2
    twice = spark.createDataFrame([("allo", "fragilis"), ("ALLO", "Fragilis")], "genus string, name string")
    assert [r.problem[:10] for r in forms.new_name(new.where("s = 'Fragilis'"), "s", twice, "edit").collect()] == ['"Fragilis"']


def test_required_before_format_and_hidden_fields(spark):
    df = spark.createDataFrame([("synonym", ""), ("synonym", "x"), ("valid", "x"), ("synonym", "1900"), (None, None)], "status string, v string")
    rule = forms.year(F.col("v"), F.lit(2000))
    got = [r[0] for r in df.select(forms.field_problem(F.col("v"), forms.visible(F.col("status"), equals="synonym"), True, rule)).collect()]
    assert got == ["This field is required", "Enter a valid year (1800–2000)", None, None, None]
    assert [r[0] for r in df.select(forms.visible(F.col("status"), unless="valid")).collect()] == [True, True, False, True, False]


def test_bodies_show_all_options(spark):
    rows = [("a", 1, "Diet", ["x"], ["w", "x"]), ("a", 0, "Name", ["n", "m"], None), ("a", 2, "None", [], None), ("a", 3, "Blank", [""], None)]
    fields = spark.createDataFrame(rows, "k string, pos int, header string, values array<string>, options array<string>")
    assert forms.body(fields, "k").collect() == [("a", "### Name\n\nn, m\n\n### Diet\n\n- [ ] w\n- [X] x")]


def test_rules_on_a_stream(spark, tmp_path):
    spark.createDataFrame([("a", -1), ("b", 2), ("c", None)], "k string, v int").write.parquet(f"{tmp_path}/in")
    stream = spark.readStream.schema("k string, v int").parquet(f"{tmp_path}/in")
    query = watch(stream, [rules.positive("size", "v", F.lit("must be positive"))], F.col("k"), "watched", f"{tmp_path}/state")
    query.processAllAvailable()
    query.stop()
    assert spark.table("watched").collect() == [("size", "error", "a", "must be positive")]
