"""Documents, the 23 checks, exports and form rules on a small data set made here."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tessella.operators import checks, hierarchy, rules
from tessella.sinks import exports
from tessella.sources import documents

SCHEMA = """
status: [valid, synonym]
diet: [herbivore, carnivore]
locomotion: [bipedal]
completeness: [partial]
integument: [scales]
integument_evidence: [direct]
paleoenvironments: [river, forest]
periods: [Late Cretaceous]
identifier_sources: [pbdb]
stages:
  Campanian: {period: Late Cretaceous, from_ma: 83.6, to_ma: 72}
  Albian: {period: Early Cretaceous, from_ma: 113, to_ma: 100.5}
countries: {CA: Canada, NO: Norway}
"""
TREE = "Life:\n  Aaa:\n    Bbb: {}\n    Ccc: {}\n  Ddd: {}\n"
GENUS = """
genus: Xus
parent: Bbb
description: A thing.
diet: herbivore
locomotion: bipedal
described_in: r1
authors: "Marsh, O.C.; Cope"
paleoenvironment: [river]
appearance: {integument: scales, evidence: direct, features: [a, b]}
identifiers: [{source: pbdb, id: 7}]
species:
  - name: Xus primus
    status: valid
    type_species: true
    completeness: partial
    described_in: r1
    authors: Osborn
    period: {name: Late Cretaceous, stage: Campanian, from_ma: 83.6, to_ma: 72.0}
    location: {country: NO, formation: Hell Creek, coordinates: [60, 10.5]}
    size: {length_m: 8.0, estimate: true}
    holotype: {specimen_id: X1, institution: M}
  - {name: Xus alter, status: synonym, synonym_of: Xus primus, period: {name: Late Cretaceous}}
references:
  - {id: r1, authors: "Marsh, O.C.", year: 1889, title: On it, journal: J, volume: 3}
"""
CLADE = "clade: {0}\nauthors: Fox\nreferences:\n  - {{id: r1, authors: A, year: 1900, title: T, book: B}}\n"


def build(spark, root, genus=GENUS, more=None, clades=("Aaa", "Bbb", "Ccc", "Ddd")):
    files = {"genera/X/Xus.yml": genus, **{f"clades/{c}.yml": CLADE.format(c) for c in clades}, **(more or {})}
    for name, text in files.items():
        (root / name).parent.mkdir(parents=True, exist_ok=True)
        (root / name).write_text(text)
    return checks.Taxonomy(
        documents.read_documents(spark, f"{root}/genera", documents.GENUS).cache(),
        documents.read_documents(spark, f"{root}/clades", documents.CLADE).cache(),
        hierarchy.edge_frame(spark, documents.load_yaml(TREE)),
        documents.load_yaml(SCHEMA),
    )


def found(t):
    return sorted((checks.CHECKS.index(r.check) + 1, r.severity, r.message) for r in checks.check_taxonomy(t).collect())


def test_clean_data_have_no_findings(spark, tmp_path):
    assert found(build(spark, tmp_path)) == []


# (what is replaced, by what, the checks that speak and the texts in their messages)
MUTATIONS = [
    ("diet: herbivore", "diet: fungivore", [(2, "invalid diet value 'fungivore' (must be one of: herbivore, carnivore)")]),
    ("status: valid", "status: unsure", [(2, "invalid status 'unsure'")]),
    ("parent: Bbb", "parent: Nowhere", [(3, "parent clade 'Nowhere' not found")]),
    ("genus: Xus", "genus: yus", [(6, "directory 'X' but genus 'yus' should be in 'Y'"), (6, "filename 'Xus'")]),
    ("description: A thing.", "description: ''", [(7, "missing required field 'description'")]),
    ("    period: {name: Late Cretaceous, stage: Campanian, from_ma: 83.6, to_ma: 72.0}\n", "", [(7, "species 'Xus primus': missing required field 'period'")]),
    ("type_species: true", "type_species: 'yes'", [(8, "no species marked as type_species")]),
    ("status: synonym,", "status: synonym, type_species: true,", [(8, "multiple species marked as type_species: Xus primus, Xus alter")]),
    ("stage: Campanian", "stage: Nope", [(9, "unknown stage 'Nope'")]),
    ("{name: Late Cretaceous, stage: Campanian", "{stage: Nope", []),
    ("stage: Campanian, from_ma: 83.6, to_ma: 72.0", "stage: Albian", [(9, "stage 'Albian' belongs to 'Early Cretaceous', not 'Late Cretaceous'")]),
    ("locomotion: bipedal\ndescribed_in: r1", "locomotion: bipedal\ndescribed_in: r9", [(10, "described_in 'r9' does not match")]),
    ("    described_in: r1", "    described_in: r9", [(10, "species 'Xus primus': described_in 'r9'")]),
    ("year: 1889", "year: 0", [(11, "reference 'r1': missing required field 'year'")]),
    ("journal: J,", "", [(11, "must have at least one of 'journal' or 'book'")]),
    ("references:\n", "references:\n  - {id: r1, authors: A, year: 1, title: T, book: B}\n  - {id: r1, authors: A, year: 1, title: T, book: B}\n", [(12, "duplicate reference id 'r1'")] * 2),
    ("country: NO, ", "", [(13, "missing 'country'")]),
    ("country: NO", "country: ZZ", [(14, "country 'ZZ' not in schema")]),
    ("[60, 10.5]", "[60]", [(15, "coordinates must be [lat, lon]")]),
    ("[60, 10.5]", "['x', -181]", [(15, "latitude x out of range"), (15, "longitude -181 out of range (-180 to 180)")]),
    ("from_ma: 83.6", "from_ma: 84", [(16, "from_ma 84 outside stage 'Campanian' range (83.6–72 Ma)")]),
    ("from_ma: 83.6, to_ma: 72.0", "from_ma: 75, to_ma: 80", [(16, "from_ma (75) must be >= to_ma (80)")]),
    ("synonym_of: Xus primus", "synonym_of: Nix", [(17, "synonym_of 'Nix' not found")]),
    (", synonym_of: Xus primus", "", [(17, "missing 'synonym_of'")]),
    ("status: synonym", "status: valid", [(17, "has 'synonym_of' but status is 'valid'")]),
    ("length_m: 8.0", "length_m: '8'", [(18, "size.length_m must be a positive number (got 8)")]),
    ("length_m: 8.0", "length_m: -1", [(18, "(got -1)")]),
    ("estimate: true", "estimate: 'true'", [(18, "size.estimate must be a boolean (got string)")]),
    ("locomotion: bipedal", "locomotion: hops", [(19, "invalid locomotion value 'hops'")]),
    ("completeness: partial", "completeness: all", [(19, "invalid completeness 'all'")]),
    ("{specimen_id: X1, institution: M}", "{material: bone}", [(20, "missing 'institution'"), (20, "missing 'specimen_id'")]),
    ("integument: scales", "integument: wool", [(21, "invalid integument 'wool'")]),
    ("evidence: direct", "evidence: none", [(21, "invalid integument evidence 'none'")]),
    ("[river]", "[river, null, sea]", [(22, "invalid paleoenvironment 'null'"), (22, "invalid paleoenvironment 'sea'")]),
    ("[river]", "sea", [(22, "invalid paleoenvironment 'sea'")]),
    ("[{source: pbdb, id: 7}]", "[{source: x, id: ' '}, {source: pbdb, id: 7}, {source: pbdb, id: 7}, {}, {}]",
     [(23, "duplicate identifier source/id pair: pbdb:7"), (23, "duplicate identifier source/id pair: undefined:undefined"), (23, "identifier with source '?' has empty"),
      (23, "identifier with source '?' has empty"), (23, "identifier with source 'x' has empty"), (23, "invalid identifier source 'x'")]),
]


@pytest.mark.parametrize(("old", "new", "want"), MUTATIONS, ids=range(len(MUTATIONS)))
def test_mutations(spark, tmp_path, old, new, want):
    assert old in GENUS
    got = found(build(spark, tmp_path, GENUS.replace(old, new, 1)))
    assert [c for c, _, _ in got] == [c for c, _ in want], got
    for (_, severity, message), (check, text) in zip(got, want, strict=True):
        assert text in message and severity == ("warning" if check == 14 else "error")


def test_files_and_tree(spark, tmp_path):
    t = build(spark, tmp_path, more={"genera/B/Bad.yml": "genus: 'open\n", "clades/Zzz.yml": CLADE.format("Zzz")}, clades=("Aaa", "Bbb", "Ccc"))
    got = found(t)
    assert [c for c, _, _ in got] == [1, 4, 5] and got[1][1] == "warning" and "'Ddd'" in got[1][2]
    lines = []
    code = rules.report(checks.check_taxonomy(t), checks.CHECKS, lines.append)
    text = "\n".join(lines)
    assert lines[:2] == ["✗ YAML syntax: 1 error", lines[1]] and lines[1].startswith("  B/Bad.yml: YAML parse error") and lines[2] == "✓ Schema compliance check passed"
    assert "⚠ Clade coverage: 1 warning" in lines and lines[-1] == "\nSummary: 2 errors, 1 warning"
    assert code == 1 and "Summary: 2 errors, 1 warning" in text and "✓ Tree consistency check passed" in text
    with pytest.raises(Exception, match="cannot load"):
        documents.read_documents(spark, f"{tmp_path}/genera", documents.GENUS, mode="FAILFAST").collect()
    assert documents.read_documents(spark, f"{tmp_path}/none", documents.GENUS).count() == 0


def test_exports(spark, tmp_path):
    t = build(spark, tmp_path)
    assert hierarchy.newick(t.edges).collect() == [("Life", "((Bbb,Ccc)Aaa,Ddd)Life;")]
    nexus = exports.nexus_file(t.edges, "x").first()[0]
    assert "NTAX=3;" in nexus and "TAXLABELS Bbb Ccc Ddd;" in nexus and exports.newick_file(t.edges, "h").first()[0] == "[h]\n((Bbb,Ccc)Aaa,Ddd)Life;\n"
    bib = [r[0] for r in exports.bibliography(t.genera, t.clades).collect()]
    assert bib == ["@article{r1,\n  author = {Marsh, O.C.},\n  year = {1889},\n  title = {On it},\n  journal = {J},\n  volume = {3}\n}\n"]
    words = [r[0] for r in exports.word_list(t.genera, t.clades, t.edges, documents.stages(spark, t.schema)).collect()]
    assert {"Marsh", "Cope", "Osborn", "Hell", "Creek", "Xus", "primus", "Campanian", "F", "o", "x"} <= set(words) and "Fox" not in words
    assert words.index("F") < words.index("Hell") < words.index("x")
    assert "Fox" in [r[0] for r in exports.word_list(t.genera, t.clades, t.edges, documents.stages(spark, t.schema), compat=False).collect()]
    lists = exports.lookup_lists(t.schema, t.edges)
    assert lists["diet"] == ["carnivore", "herbivore"] and list(lists["countries"]) == ["CA", "NO"] and lists["clades"] == ["Aaa", "Bbb", "Ccc", "Ddd", "Life"]
    data = exports.dataset(t.genera, t.clades, documents.load_yaml(TREE), dt.datetime(2025, 3, 1, tzinfo=dt.UTC), "us")
    assert data["_metadata"]["genus_count"] == 1 and data["_metadata"]["version"] == "2025.03" and data["_metadata"]["built_at"] == "2025-03-01T00:00:00.000Z"
    assert data["genera"]["Xus"]["taxonomy"] == ["Life", "Aaa", "Bbb"] and data["genera"]["Xus"]["species"][0]["name"] == "Xus primus"
    with pytest.raises(ValueError, match="dataset_lines"):
        exports.dataset(t.genera, t.clades, documents.load_yaml(TREE), dt.datetime(2025, 3, 1, tzinfo=dt.UTC), "us", most=1)
    lines = exports.dataset_lines(t.genera, t.clades, t.edges).collect()
    assert [(r.kind, r.key) for r in lines] == [("clade", c) for c in ("Aaa", "Bbb", "Ccc", "Ddd")] + [("genus", "Xus")]
    assert exports._plain(json.loads(lines[-1].value)) == data["genera"]["Xus"]
    assert documents.load_yaml(exports.to_yaml(data))["clades"].keys() == data["clades"].keys()


def test_lookups(spark, tmp_path):
    t = build(spark, tmp_path)
    assert [r[0] for r in documents.stages_of(documents.stages(spark, t.schema), "Late Cretaceous").collect()] == ["Campanian"]
    assert [r.value for r in documents.values_of(documents.vocabularies(spark, t.schema), "diet").collect()] == ["herbivore", "carnivore"]
    assert documents.values_of(documents.vocabularies(spark, t.schema), "nothing").count() == 0
    assert {r.code for r in documents.countries(spark, t.schema).collect()} == {"CA", "NO"}


def test_paths(spark):
    tree = {"L": {"A": {"B": None}, "B": {}, "C": {"D": {"E": {}}}}}
    e = hierarchy.edge_frame(spark, tree)
    p = {r.node: r.path for r in hierarchy.paths(e).collect()}
    assert p["B"] == ["L", "A", "B"] and p["E"] == ["L", "C", "D", "E"]
    assert all(path[-1] == n for n, path in p.items())
    deep: dict = {}
    at = deep
    for i in range(20):
        at[f"n{i}"] = at = {}
    assert hierarchy.newick(hierarchy.edge_frame(spark, deep)).first().newick == "(" * 19 + "".join(f"n{i})" for i in range(19, 0, -1)) + "n0;"
    assert hierarchy.with_path(spark.createDataFrame([("E",), ("zz",), (None,)], "k string"), "k", e).where(F.size("taxonomy") == 0).count() == 2
    assert hierarchy.newick(e.limit(0)).count() == 0
