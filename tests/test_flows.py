"""Forms as data against plain Python, and paths into records."""

import itertools

import pytest
from pyspark.sql import functions as F

from tessella.functions import paths
from tessella.operators import flows
from tessella.sources import documents

FLOW = {
    "label": "L",
    "steps": [
        {"name": "one", "fields": [
            {"header": "Name", "type": "text", "required": True, "validate": "newName"},
            {"header": "Kind", "type": "select", "required": True, "optionsKey": "kinds"},
            {"header": "Of", "type": "search", "required": True, "showWhen": {"field": "Kind", "value": "copy"}},
            {"header": "How", "type": "select", "showWhen": {"field": "Kind", "notEmpty": True, "notValue": "none"}, "required": True},
        ]},
        {"name": "two", "fields": [
            {"header": "Year", "type": "number", "validate": "year"},
            {"header": "Size", "type": "text", "required": True, "validate": "positiveNumber"},
            {"header": "Places", "type": "checkboxes", "required": True, "optionsKey": "places"},
            {"header": "Ids", "type": "textarea", "validate": "identifiers"},
            {"header": "Old", "type": "readonly"},
        ]},
    ],
}


def by_hand(values, checked, known):
    out = {}
    for f in itertools.chain.from_iterable(s["fields"] for s in FLOW["steps"]):
        when, v = f.get("showWhen"), values.get(f["header"])
        if when:
            other = values.get(when["field"]) or ""
            if not (other == when["value"] if "value" in when else other not in ("", when["notValue"])):
                continue
        if f["type"] == "checkboxes":
            v = ",".join(checked.get(f["header"], []))
        if f.get("required") and not v:
            out[f["header"]] = "This field is required"
        elif v:
            message = {
                "newName": f'"{v}" is taken' if v.lower() in known else None,
                "year": None if v.isdigit() and 1800 <= int(v) <= 2000 else "Enter a valid year (1800–2000)",
                "positiveNumber": None if v.replace(".", "").isdigit() and float(v) > 0 else "Must be a positive number",
                "identifiers": None if v == "a: 1" else f'"{v}" is missing a colon — expected format: source: id',
            }.get(f.get("validate"))
            if message:
                out[f["header"]] = message
    return out


def test_problems_equal_plain_python(spark):
    given = itertools.product(["", "New", "OLD"], [None, "copy", "none", "x"], ["", "1850", "1700"], ["0", "2.5", None], [[], ["p"]], ["", "a: 1", "bad"])
    rows = []
    for name, kind, year, size, places, ids in given:
        values = {"Name": name, "Kind": kind, "Year": year, "Size": size, "Ids": ids, "Of": "o" if year else None}
        rows.append(({k: v for k, v in values.items() if v is not None}, {"Places": places}))
    df = spark.createDataFrame(rows, f"values {flows.VALUES}, checked {flows.CHECKED}")
    taken = {"newName": lambda v: F.when(F.lower(v) == "old", F.concat(F.lit('"'), v, F.lit('" is taken')))}
    got = flows.problems(df, FLOW, flows.rules(["a"], F.lit(2000), **taken))
    for r in got.collect():
        assert r.problems == by_hand(r["values"], r.checked, {"old"})
    assert "Python" not in got._jdf.queryExecution().executedPlan().toString()
    second = flows.problems(df, FLOW, flows.rules([], F.lit(2000), **taken), step=1)
    assert set().union(*[r.problems for r in second.collect()]) == {"Year", "Size", "Places", "Ids"}
    with pytest.raises(ValueError, match="unknown rule"):
        flows.problems(df, FLOW, flows.rules([]))
    for bad, what in (({"type": "slider"}, "no known type"), ({"type": "text", "showWhen": {"field": "?", "value": "x"}}, "depends on")):
        with pytest.raises(ValueError, match=what):
            flows.fields_of({"steps": [{"name": "s", "fields": [{"header": "H", **bad}]}]})


def test_tables_of_fields_and_options(spark):
    t = flows.field_table(spark, {"f": FLOW})
    assert t.count() == 9 and t.where("header = 'How'").first()[-3:] == ("Kind", None, "none")
    lists = spark.createDataFrame([("kinds", 1, "b"), ("kinds", 0, "z")], "vocab string, pos int, value string")
    stages = spark.createDataFrame([("P", "s2"), ("P", "s1"), ("Q", "s3")], "period string, stage string")
    timed = {"steps": [{"name": "s", "fields": [{"header": "Stage", "type": "select", "optionsKey": "stages", "filteredByPeriod": True}]}]}
    got = {r.header: (r.options, r.by_period) for r in flows.options(spark, {"f": FLOW, "g": timed}, lists, stages).collect()}
    assert got == {"Kind": (["z", "b"], None), "Places": ([], None), "Stage": ([], {"P": ["s1", "s2"], "Q": ["s3"]})}
    assert {r.header: r.by_period for r in flows.options(spark, {"f": FLOW}, lists).collect()} == {"Kind": None, "Places": None}


DOC = """
genus: X
parent: P
pronunciation: {ipa: /x/}
paleoenvironment: [a, b]
appearance: {features: [f, g], integument: scales}
identifiers: [{source: s, id: 1}, {source: t}]
species:
  - {name: A, period: {from_ma: 83.0}, size: {length_m: 2.5}, location: {coordinates: [1, -2.5]}, authors: [M, N], type_species: true}
  - {name: B}
"""
UPDATE = {
    "isUpdate": True,
    "steps": [{"name": "s", "fields": [
        {"header": "Said", "type": "text", "currentKey": "pronunciation.ipa"},
        {"header": "Up", "type": "readonly", "currentKey": "parent"},
        {"header": "Places", "type": "checkboxes", "optionsKey": "places", "currentKey": "paleoenvironment"},
        {"header": "Seen", "type": "textarea", "currentKey": "appearance.features"},
        {"header": "Ids", "type": "textarea", "currentKey": "identifiers"},
        {"header": "Length", "type": "text", "currentKey": "species.size.length_m"},
        {"header": "Where", "type": "text", "currentKey": "species.location.coordinates"},
        {"header": "Why", "type": "textarea", "required": True},
    ]}],
}


@pytest.fixture(scope="module")
def records(spark):
    return documents.decode_documents(spark.createDataFrame([(DOC, "/g/X.yml"), ("genus: Y\n", "/g/Y.yml")], "value string, _path string"), documents.GENUS, "/g").cache()


def test_paths_are_checked_and_compiled(spark, records):
    s = records.schema
    want = {
        "parent": ("P", None), "appearance.features": ("f, g", None), "species.name": ("A, B", None), "species.authors": ("M, N", None), "species.size.length_m": ("2.5, ", None),
        "species.period.from_ma": ("83, ", None), "species.location.coordinates": ("1, -2.5", None), "species.type_species": ("true, ", None), "identifiers.source": ("s, t", None),
    }
    got = records.orderBy("genus").select(*[paths.value_at(s, p).alias(p.replace(".", "_")) for p in want]).collect()
    assert {p: tuple(r[p.replace(".", "_")] for r in got) for p in want} == want
    one = paths.chosen("species", "name", s, F.lit("A"))
    assert records.orderBy("genus").select(paths.value_at(s, "species.location.coordinates", roots={"species": one}).alias("x")).first().x == "1, -2.5"
    assert records.orderBy("genus").select(paths.value_at(s, "identifiers", sep="\n", item="{source}: {id}").alias("x")).first().x == "s: 1\nt: "
    for path, more, what in (("nothing", {}, "no 'nothing'"), ("appearance.shape", {}, "no 'shape'"), ("parent.x", {}, "no 'x'"), ("a..b", {}, "no path"), ("species", {}, "ends in a record"), ("parent", {"item": "{x}"}, "no list of records"), ("identifiers", {"item": "{y}"}, "no 'y'")):
        with pytest.raises(ValueError, match=what):
            paths.value_at(s, path, **more)


def test_current_values_and_bodies(spark, records):
    s = records.schema
    a = {"species": paths.chosen("species", "name", s, F.lit("A"))}
    whole = flows.with_current(records, UPDATE, s, chosen=a).orderBy("genus").collect()
    assert whole[0].current == {"Said": "/x/", "Up": "P", "Places": "a, b", "Seen": "f\ng", "Ids": "s: 1\nt: ", "Length": "2.5", "Where": "1, -2.5"} and whole[1].current == {}
    fewer = flows.with_current(records, UPDATE, s, chosen=a, without=flows.BODY_WITHOUT)
    assert set(flows.current_paths(UPDATE)) - set(flows.current_paths(UPDATE, flows.BODY_WITHOUT)) == {"Said"}
    values = F.create_map(*[F.lit(x) for kv in {"Said": "/x/", "Up": "no", "Seen": "f\ng", "Length": "3", "Why": "w", "Where": ""}.items() for x in kv])
    checked = F.create_map(F.lit("Places"), F.array(F.lit("b")))
    body = flows.bodies(fewer.withColumns({"values": values, "checked": checked}), UPDATE, {"places": ["a", "b"]}).where("genus = 'X'").first().body
    assert body == "### Said\n\n/x/\n\n### Places\n\n- [ ] a\n- [X] b\n\n### Length\n\n3\n\n### Why\n\nw"
