"""Checks of changed files only against checks of all, after random edits."""

import random

from tessella.operators import checks, hierarchy, incremental
from tessella.sources import documents

SCHEMA = {"diet": ["herbivore"], "status": ["valid", "synonym"], "periods": ["P"], "stages": {}, "countries": {}}
TREE = {"Aaa": {"Bbb": {}, "Ccc": {}}}

def genus(i, r):
    synonym = f"  - {{name: G{i} b, status: synonym, synonym_of: G{r.randrange(12)} a, period: {{name: P}}}}\n" if r.random() < 0.6 else ""
    name = f"G{i} {'a' if r.random() < 0.8 else 'z'}"
    return f"genus: G{i}\nparent: {r.choice(['Aaa', 'Bbb', 'Zzz'])}\ndescription: d\ndiet: {r.choice(['herbivore', 'x'])}\nspecies:\n  - {{name: {name}, status: valid, type_species: true, period: {{name: P}}}}\n{synonym}"


def frames(spark, files):
    def texts(kind):
        return spark.createDataFrame([(t, f"/{kind}/{n}") for (k, n), t in sorted(files.items()) if k == kind], "value string, _path string")

    return texts("genera"), texts("clades")


def whole(spark, files, schema, edges):
    g, c = frames(spark, files)
    t = checks.Taxonomy(documents.decode_documents(g, documents.GENUS, "/genera"), documents.decode_documents(c, documents.CLADE, "/clades"), edges, schema)
    return sorted(tuple(r) for r in checks.check_taxonomy(t).collect())


def test_findings_after_edits_equal_those_of_a_full_run(spark):
    r = random.Random(11)
    edges = hierarchy.edge_frame(spark, TREE)
    files = {("genera", f"G/G{i}.yml"): genus(i, r) for i in range(12)} | {("clades", f"{c}.yml"): f"clade: {c}\n" for c in ("Aaa", "Bbb")}
    manifest = findings = None
    for step in range(4):
        if step:
            for k in r.sample(sorted(files), 2):
                if k[0] == "genera":
                    files[k] = r.choice([genus(int(k[1][3:-4]), r), "genus: 'open", files[k]])
            if step == 2:
                del files["genera", "G/G3.yml"]
                files["clades", "Ccc.yml"] = "clade: Ccc\n"
        schema = SCHEMA | ({"diet": ["herbivore", "x"]} if step == 3 else {})
        manifest, findings, again = incremental.check_changes(*frames(spark, files), edges, schema, manifest, findings, roots=("/genera", "/clades"))
        assert sorted(tuple(x) for x in findings.collect()) == whole(spark, files, schema, edges)
        n = again.count()
        assert n == len(files) if step in (0, 3) else n < len(files)


def test_users_of_a_name_that_goes_are_checked_again(spark):
    edges = hierarchy.edge_frame(spark, TREE)
    base = "genus: {0}\nparent: Aaa\ndescription: d\nspecies:\n  - {{name: {0} a, status: valid, type_species: true, period: {{name: P}}}}\n"
    files = {("genera", f"{n}/{n}.yml"): base.format(n) for n in "ABC"} | {("clades", "Aaa.yml"): "clade: Aaa\n"}
    files["genera", "B/B.yml"] += "  - {name: B b, status: synonym, synonym_of: A a, period: {name: P}}\n"
    m, f, _ = incremental.check_changes(*frames(spark, files), edges, SCHEMA, roots=("/genera", "/clades"))
    assert f.where("check LIKE 'Synonym%'").count() == 0
    files["genera", "A/A.yml"] = files["genera", "A/A.yml"].replace("A a", "A other")
    m, f, again = incremental.check_changes(*frames(spark, files), edges, SCHEMA, m, f, roots=("/genera", "/clades"))
    assert {r.file for r in again.collect()} == {"A/A.yml", "B/B.yml"}
    assert [r.file for r in f.where("check LIKE 'Synonym%'").collect()] == ["B/B.yml"]
    m, f2, again = incremental.check_changes(*frames(spark, files), edges, SCHEMA, m, f, roots=("/genera", "/clades"))
    assert again.count() == 0 and sorted(map(tuple, f2.collect())) == sorted(map(tuple, f.collect()))


def test_a_file_name_that_both_kinds_have(spark):
    edges = hierarchy.edge_frame(spark, TREE)
    files = {("genera", "Aaa.yml"): "genus: 'open", ("clades", "Aaa.yml"): "clade: 'open", ("clades", "Bbb.yml"): "clade: Bbb\n"}
    m, f, _ = incremental.check_changes(*frames(spark, files), edges, SCHEMA, roots=("/genera", "/clades"))
    for edit in ({("clades", "Aaa.yml"): "clade: Aaa\n"}, {("genera", "Aaa.yml"): None}):
        files = {k: v for k, v in (files | edit).items() if v}
        m, f, _ = incremental.check_changes(*frames(spark, files), edges, SCHEMA, m, f, roots=("/genera", "/clades"))
        assert sorted(tuple(x) for x in f.collect()) == whole(spark, files, SCHEMA, edges)
