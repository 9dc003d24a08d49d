"""Folders as data sources: which files are read, what a broken one gives, and the candidates of captured answers."""

import json

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tessella.sources import candidates, documents, folders

GENUS = "genus: {0}\nparent: Aaa\nextra: {{a: 1}}\nspecies:\n  - {{name: {0} b, type_species: true}}\n"


@pytest.fixture(scope="module")
def captured(spark, tmp_path_factory):
    root = str(tmp_path_factory.mktemp("captured"))
    taxon = {"records": [{"taxon_name": "A", "taxon_attr": "Marsh, 1877", "diet": "carnivore", "early_interval": "Campanian", "family": "F"}, {"taxon_attr": "second"}]}
    children = {"records": [{"accepted_rank": "genus", "accepted_name": "g"}, {"accepted_rank": "species", "accepted_name": "A b"}, {"accepted_rank": "species", "accepted_name": "A c"}]}
    claims = {"P427": [{"mainsnak": {"snaktype": "value", "datavalue": {"type": "wikibase-entityid", "value": {"id": "Q2"}}}}], "P186": [{"mainsnak": {"snaktype": "value", "datavalue": {"type": "string", "value": {"id": "Q2"}}}}]}
    article = {"parse": {"wikitext": {"*": "{{Taxobox| type = ''A b''}}\nAaa is it."}, "sections": [{"line": "x", "level": "2", "index": "1"}], "text": {"*": "<p>"}}}
    rows = [
        ("taxa", "A/ü b", json.dumps(taxon)), ("children", "A/ü b", json.dumps(children)), ("occurrences", "A/ü b", json.dumps({"records": [{"cc": "US", "lat": 47.5, "lng": "-1"}]})),
        ("taxa", "none", '{"records": []}'), ("children", "none", json.dumps(children)), ("taxa", "broken", '{"records": ['), ("taxa", "list", "[1]"), ("taxa", "empty", None),
        ("search", "A/ü b", '{"search": [{"id": "Q1"}, {"id": "Q9"}]}'), ("entities", "Q1", json.dumps({"entities": {"Q1": {"claims": claims}}})),
        ("entities", "Q2", '{"entities": {"Q2": {"labels": {"en": {"value": "A b"}}}}}'), ("articles", "A/ü b", json.dumps(article)), ("extracts", "A/ü b", '{"query": {"pages": {"7": {"extract": "It is.\\nmore"}}}}'),
        ("articles", "none", '{"error": {"code": "missing"}}'),
    ]
    df = spark.createDataFrame(rows, "service string, subject string, body string").repartition(3)
    folders.save_answers(df, root)
    folders.save_answers(df, root)  # a task that runs again
    return root


def test_filters_choose_the_files(spark, captured):
    every = folders.answers(spark, captured)
    assert every.select("_file").distinct().count() == 12  # two answers have no records
    reader = folders.AnswersReader({"path": captured, "maxFiles": "1"}, T._parse_datatype_string(folders.ANSWER))
    from pyspark.sql.datasource import EqualTo, GreaterThan, In, StringStartsWith

    given = [EqualTo(("subject",), "A/ü b"), In(("service",), ("taxa", "children", "nothing")), GreaterThan(("pos",), 0)]
    assert list(reader.pushFilters(given)) == given and reader.pushed == given[:2]
    assert [[p.rsplit("/", 2)[1] for p in part.paths] for part in reader.partitions()] == [["children"], ["taxa"]]
    prefix = folders.AnswersReader({"path": captured}, T._parse_datatype_string(folders.ANSWER))
    list(prefix.pushFilters([StringStartsWith(("subject",), "Q")]))
    assert [len(p.paths) for p in prefix.partitions()] == [2]
    one = every.where("subject = 'A/ü b' AND service = 'taxa'")
    assert one.rdd.getNumPartitions() == 1 and folders.answers(spark, captured, maxFiles=1).where("service = 'taxa'").rdd.getNumPartitions() == 5
    assert [r.pos for r in one.orderBy("pos").collect()] == [0, 1]
    assert folders.answers(spark, captured, first=1).where("service = 'taxa' AND subject = 'A/ü b'").count() == 1
    assert folders.answers(spark, captured).where("service = 'nothing'").count() == 0
    assert folders.answers(spark, f"{captured}/absent").count() == 0


def test_broken_answers_are_rows(spark, captured):
    got = {r.subject: r for r in folders.answers(spark, captured).where("service = 'taxa' AND _error IS NOT NULL").collect()}
    assert set(got) == {"broken", "empty"} and all(r.record is None and r._error for r in got.values())


def test_answers_become_candidates(spark, captured):
    def answers(service):
        return folders.answers(spark, captured, service=service)

    taxa = candidates.taxa_of(answers).where("subject = 'A/ü b'").collect()
    assert sorted(r.subject for r in candidates.taxa_of(answers).collect()) == ["A/ü b"]
    assert [r.asDict() for r in taxa] == [
        {"subject": "A/ü b", "type_species": "A b", "authority": "Marsh, 1877", "diet": "carnivore", "early_interval": "Campanian", "late_interval": "", "family": "F",
         "formation": "", "country": "US", "region": "", "latitude": "47.5", "longitude": "-1"}
    ]
    assert [r.asDict() for r in candidates.entity_fields(*candidates.entities_of(answers)).collect()] == [{"subject": "A/ü b", "qid": "Q1", "type_species": "A b", "diet": None, "parent_taxon": None, "mass": None}]
    article = candidates.article_fields(candidates.articles_of(answers)).collect()
    assert [(r.subject, r.type_species, r.summary) for r in article] == [("A/ü b", "A b", "It is.")]


def test_document_folders_equal_the_text_reader(spark, tmp_path):
    for name in ("X/Xa.yml", "X/Xb.yaml", "Y/Ya.yml", "Y/deep/Yb.yml", "Y/note.txt"):
        (tmp_path / name).parent.mkdir(parents=True, exist_ok=True)
        (tmp_path / name).write_text("genus: 'open" if "Yb" in name else GENUS.format(name.split("/")[-1].split(".")[0]))
    folders.register(spark)
    schema = f"{documents.GENUS}, {documents.ADDED}"
    got = spark.read.format("document_folder").schema(schema).load(str(tmp_path))
    want = documents.read_documents(spark, str(tmp_path), documents.GENUS)
    key = [c for c in want.columns if c != "_error"]
    assert sorted(map(repr, got.select(key).collect())) == sorted(map(repr, want.select(key).collect()))
    assert [bool(r._error) for r in got.orderBy("_file").collect()] == [False, False, False, True]
    assert [r._file for r in got.where("_folder = 'X' AND _stem LIKE '%b'").collect()] == ["X/Xb.yaml"]
    flat = spark.read.format("document_folder").schema(schema).option("recursive", "false").load(str(tmp_path / "Y"))
    assert [(r._file, r._folder) for r in flat.collect()] == [("Ya.yml", "Y")]
    assert {r._file for r in documents.read_documents(spark, str(tmp_path / "Y"), documents.GENUS, recursive=False).collect()} == {"Ya.yml"}
    assert spark.read.format("document_folder").schema(schema).load(str(tmp_path / "none")).count() == 0
