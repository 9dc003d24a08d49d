"""Text forms of a data set: tree notations, bibliography, lookup lists, word list, the whole as JSON or YAML."""

from __future__ import annotations

import datetime as dt
import json
from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.semantics import present
from ..functions.text import surnames
from ..operators import hierarchy, rules
from ..operators.linkage import first_wins
from . import ordered
from .ordered import plain as _plain
from .ordered import yaml_text as to_yaml

# --- tree ---------------------------------------------------------------------


def newick_file(edges: DataFrame, header: str) -> DataFrame:
    """One row ``value``: the first root's tree below a bracketed header."""
    tree = hierarchy.newick(edges).limit(1)
    return tree.select(F.concat(F.lit(f"[{header}]\n"), "newick", F.lit("\n")).alias("value"))


def nexus_file(edges: DataFrame, header: str, name: str = "tree") -> DataFrame:
    """One row ``value``: the leaves of all roots as taxa, and the first root's tree."""
    labels = hierarchy.leaves(edges).agg(F.count("*").alias("n"), F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("order", "node"))), lambda x: x["node"]), " ").alias("taxa"))
    tree = hierarchy.newick(edges).limit(1).select("newick")
    form = f"#NEXUS\n[! {header} ]\n\nBEGIN TAXA;\n  DIMENSIONS NTAX=%s;\n  TAXLABELS %s;\nEND;\n\nBEGIN TREES;\n  TREE {name} = %s\nEND;\n"
    return labels.crossJoin(tree).select(F.format_string(form, F.col("n").cast("string"), "taxa", "newick").alias("value"))  # one row each


# --- bibliography -------------------------------------------------------------

# Fields of an entry, in order, and their names there.
ENTRY = (("authors", "author"), ("year", "year"), ("title", "title"), ("journal", "journal"), ("book", "booktitle"), ("volume", "volume"), ("issue", "number"), ("pages", "pages"), ("doi", "doi"))


def distinct_references(genera: DataFrame, clades: DataFrame) -> DataFrame:
    """One row an id, the first by source (genera, then clades), file and place. Ids differ by case."""
    parts = [d.select(F.lit(i).alias("src"), "_file", F.posexplode("references").alias("pos", "r")).select("src", "_file", "pos", "r.*") for i, d in enumerate((genera, clades))]
    every = parts[0].unionByName(parts[1]).where(present(F.col("id")))
    return first_wins(every.withColumns({"s": F.col("src"), "f": F.col("_file"), "p": F.col("pos")}), ["id"], ["src", "_file", "pos"])


def bibtex_entry():
    """A reference's entry; absent fields are left out."""
    fields = [F.when(present(F.col(c), "number" if c == "year" else "string"), F.concat(F.lit(f"  {n} = {{"), F.col(c).cast("string"), F.lit("}"))) for c, n in ENTRY]
    kind = F.when(present(F.col("book")), F.lit("incollection")).otherwise(F.lit("article"))
    return F.concat(F.lit("@"), kind, F.lit("{"), "id", F.lit(",\n"), F.concat_ws(",\n", *fields), F.lit("\n}\n"))


def bibliography(genera: DataFrame, clades: DataFrame) -> DataFrame:
    """``value``, an entry a row, in order of first occurrence."""
    return distinct_references(genera, clades).orderBy("src", "_file", "pos").select(bibtex_entry().alias("value"))


def write_bibliography(genera: DataFrame, clades: DataFrame, path: str, header: Sequence[str] = ()) -> None:
    """The bibliography as one document, behind lines of comment."""
    top = "".join(f"% {line}\n" for line in header) + ("\n" if header else "")
    rows = distinct_references(genera, clades).select("src", "_file", "pos", bibtex_entry().alias("value"))
    write_lines(rows, path, ("src", "_file", "pos"), top)


# --- words --------------------------------------------------------------------

# Terms that the word list always holds.
TERMS = (
    "Aves",
    "Dinosauria",
    "Saurischia",
    "Ornithischia",
    "Theropoda",
    "Sauropoda",
    "clade",
    "genus",
    "species",
    "holotype",
    "syntype",
    "paratype",
    "neotype",
    "lectotype",
    "taxon",
    "taxa",
    "phylogeny",
    "phylogenetic",
    "monophyletic",
    "paraphyletic",
    "polyphyletic",
    "apomorphy",
    "synapomorphy",
    "plesiomorphy",
    "autapomorphy",
    "acetabulum",
    "femur",
    "tibia",
    "fibula",
    "humerus",
    "ulna",
    "radius",
    "vertebra",
    "vertebrae",
    "sacral",
    "cervical",
    "dorsal",
    "caudal",
    "cranial",
    "dentary",
    "maxilla",
    "premaxilla",
    "nasal",
    "jugal",
    "quadrate",
    "squamosal",
    "parietal",
    "frontal",
    "lacrimal",
    "pneumatic",
    "pneumatized",
    "serrated",
    "laterally",
    "compressed",
    "bipedal",
    "quadrupedal",
    "herbivore",
    "carnivore",
    "omnivore",
    "insectivore",
    "piscivore",
    "integument",
    "osteoderms",
    "Cretaceous",
    "Jurassic",
    "Triassic",
    "Paleogene",
    "Mesozoic",
    "Maastrichtian",
    "Campanian",
    "Cenomanian",
    "Turonian",
    "Albian",
    "Aptian",
    "Barremian",
    "Tithonian",
    "Kimmeridgian",
    "Oxfordian",
)


def word_list(genera: DataFrame, clades: DataFrame, edges: DataFrame, stages: DataFrame, compat: bool = True) -> DataFrame:
    """``word``: distinct words of all sources, in the order of the language's collation.

    Compatible mode takes a clade's authors letter by letter, as published lists have them.
    """
    spark = edges.sparkSession

    def words(df: DataFrame, array) -> DataFrame:
        return df.select(F.explode(array).alias("word"))

    species = genera.select(F.explode("species").alias("s"))
    authors = [genera.select("authors"), species.select(F.explode("s.authors").alias("authors"))]
    authors += [d.select(F.explode("references.authors").alias("authors")) for d in (genera, clades)]
    if not compat:
        authors.append(clades.select("authors"))
    parts = [
        spark.createDataFrame([(t,) for t in TERMS], "word string"),
        edges.select(F.col("node").alias("word")),
        stages.select(F.col("stage").alias("word")),
        genera.select(F.col("genus").alias("word")),
        words(species, F.split(F.col("s.name"), r"(?U)\s+")),
        words(species, F.split(F.col("s.location.formation"), r"(?U)\s+")),
        *[words(a, surnames(F.col("authors"))) for a in authors],
    ]
    if compat:
        letters = words(clades.select(F.split("authors", "").alias("a")), F.col("a"))
        parts.append(letters.select(F.when(F.col("word") != ",", F.element_at(surnames(F.col("word")), 1)).otherwise(F.lit("")).alias("word")))
    return distinct_words(parts)


def distinct_words(parts: Sequence[DataFrame]) -> DataFrame:
    """``word``: the distinct words of some tables' one column, in the order of the language's collation."""
    every = parts[0].toDF("word")
    for p in parts[1:]:
        every = every.union(p)
    return every.where(present(F.col("word"))).distinct().orderBy(F.collate("word", "UNICODE"), "word")


def write_word_list(words: DataFrame, path: str, header: Sequence[str] = ()) -> None:
    """A word list (``word``) as one document in the language's order, behind lines of comment."""
    rows = words.select("word", F.collate("word", "UNICODE").alias("at"), F.concat("word", F.lit("\n")).alias("value"))
    write_lines(rows, path, ("at", "word"), "".join(f"# {line}\n" for line in header))


# --- lookup lists and the whole -----------------------------------------------

# The lists of the lookup file, in order.
LISTS = ("status", "diet", "locomotion", "completeness", "integument", "integument_evidence", "paleoenvironments", "periods", "identifier_sources")


def lookup_lists(schema: dict, edges: DataFrame | None = None) -> dict:
    """Sorted lists, countries by code and stages as they are: a schema's size. With ``edges`` the tree's
    names too, for a tree as small as a schema; ``write_lookups`` writes those of any tree."""
    out: dict = {k: sorted(schema[k]) for k in LISTS if isinstance(schema.get(k), list)}
    out["countries"] = dict(sorted((schema.get("countries") or {}).items()))
    out["stages"] = schema.get("stages")
    if edges is not None:
        out["clades"] = sorted(r.node for r in hierarchy.places(edges).select("node").toLocalIterator())
    return out


def metadata(genera: DataFrame, clades: DataFrame, built: dt.datetime, attribution: str) -> DataFrame:
    """One row of literals, counts of keys, and the build's clock, which is given."""
    g = genera.agg(F.count_distinct("genus").alias("genus_count"))
    c = clades.agg(F.count_distinct("clade").alias("clade_count"))
    stamp = built.astimezone(dt.UTC).strftime("%Y-%m-%dT%H:%M:%S.") + f"{built.microsecond // 1000:03d}Z"
    return g.crossJoin(c).select(  # one row each
        F.lit(attribution).alias("attribution"), F.lit(stamp).alias("built_at"), "clade_count", "genus_count",
        F.lit("CC-BY-4.0").alias("license"), F.lit("1.0.0").alias("schema_version"), F.lit(built.strftime("%Y.%m")).alias("version"),
    )


def _placed(genera: DataFrame, clades: DataFrame, edges: DataFrame) -> tuple[DataFrame, DataFrame]:
    from ..sources.documents import keyed_last

    return hierarchy.with_path(keyed_last(genera, "genus"), "parent", edges), hierarchy.with_path(keyed_last(clades, "clade"), "clade", edges)


def _lines(df: DataFrame, key: str) -> DataFrame:
    return df.select(F.col(key).alias("key"), F.to_json(F.struct(*[c for c in df.columns if not c.startswith("_")])).alias("value"))


def dataset_lines(genera: DataFrame, clades: DataFrame, edges: DataFrame) -> DataFrame:
    """``kind, key, value``: each record with its path as a line of JSON, in order of kind and key.

    The form for data of any size: the executors write it (``write_text``), nothing passes the driver.
    """
    g, c = _placed(genera, clades, edges)
    both = _lines(c, "clade").withColumn("kind", F.lit("clade")).unionByName(_lines(g, "genus").withColumn("kind", F.lit("genus")))
    return both.select("kind", "key", "value").orderBy("kind", "key")


def _records(df: DataFrame, key: str, most: int) -> dict:
    rows = _lines(df, key).orderBy("key").limit(most + 1).collect()
    if len(rows) > most:
        raise ValueError(f"more than {most} records for one document: use dataset_lines")
    return {r.key: _plain(json.loads(r.value)) for r in rows}


def dataset(genera: DataFrame, clades: DataFrame, tree: dict, built: dt.datetime, attribution: str, most: int = 100_000) -> dict:
    """Metadata, tree, and records with their paths (``taxonomy``) by name: one document for people.

    It is made in the driver, so more than ``most`` records of a kind are refused, not cut;
    ``dataset_lines`` has no such bound."""
    g, c = _placed(genera, clades, hierarchy.edge_frame(genera.sparkSession, tree))
    return {"_metadata": metadata(g, c, built, attribution).first().asDict(), "tree": tree, "clades": _records(c, "clade", most), "genera": _records(g, "genus", most)}


def to_json(data: dict) -> str:
    return json.dumps(data, indent=2, ensure_ascii=False) + "\n"


# --- whole documents ------------------------------------------------------------


def _json_sections(names: Sequence[str], header: str, item: bool = False) -> ordered.Layout:
    """A document of JSON whose members after the header are objects (or lists) by these names."""
    begin, end = ("[", "]") if item else ("{", "}")
    sections = tuple(ordered.Section(f'  "{n}": {begin}\n', f"\n  {end}", ",\n", f'  "{n}": {begin}{end}') for n in names)
    return ordered.Layout(sections, "{\n" + header, "\n}\n", ",\n", "item" if item else "json")


def _members(data: dict) -> str:
    """The lines of some members of a document of JSON, with a comma after each."""
    text = json.dumps(data, indent=2, ensure_ascii=False)
    return text[2:-2] + ",\n" if data else ""


def _dataset_rows(genera: DataFrame, clades: DataFrame, edges: DataFrame) -> DataFrame:
    g, c = _placed(genera, clades, edges)
    section = F.when(F.col("kind") == "clade", 0).otherwise(1).alias("section")
    both = _lines(c, "clade").withColumn("kind", F.lit("clade")).unionByName(_lines(g, "genus").withColumn("kind", F.lit("genus")))
    return both.select(section, "key", "value")


def write_dataset(genera: DataFrame, clades: DataFrame, tree: dict, built: dt.datetime, attribution: str, path: str, form: str = "json") -> None:
    """The whole data set as one document, JSON or YAML: metadata, tree, and all records by name with
    their paths. Records are written by the tasks that have them; the driver gives the header alone,
    whose tree it is given."""
    edges = hierarchy.edge_frame(genera.sparkSession, tree)
    header = {"_metadata": metadata(genera, clades, built, attribution).first().asDict(), "tree": tree}
    if form == "json":
        layout = _json_sections(("clades", "genera"), _members(header))
    else:
        sections = tuple(ordered.Section(f"{n}:\n", empty=f"{n}: {{}}\n") for n in ("clades", "genera"))
        layout = ordered.Layout(sections, to_yaml(header), form="yaml", indent=2)
    ordered.write_document(_dataset_rows(genera, clades, edges), path, layout)


def write_lookups(schema: dict, edges: DataFrame, path: str) -> None:
    """The lookup file as one document: the schema's lists, then the tree's names in order, a list of any length."""
    names = hierarchy.places(edges).select(F.lit(0).alias("section"), F.col("node").alias("key"), F.to_json(F.struct("node")).alias("j"))
    rows = names.select("section", "key", F.expr("substr(j, 9, length(j) - 9)").alias("value"))
    ordered.write_document(rows, path, _json_sections(("clades",), _members(lookup_lists(schema)), item=True))


def write_lines(rows: DataFrame, path: str, order: Sequence[str], header: str = "") -> None:
    """``value`` of each row below a header, in order: bibliographies, word lists and reports of any length."""
    lines = rows.select(F.lit(0).alias("section"), F.lit("").alias("key"), "value", *[c for c in order if c != "value"])
    ordered.write_document(lines, path, ordered.Layout(header=header), order)


def write_report(findings: DataFrame, checks: Sequence[str], path: str) -> int:
    """The report of ``rules.report_lines`` as one document, and the exit code: 1 if there is an error."""
    lines = rules.report_lines(findings, checks).select("pos", F.concat("line", F.lit("\n")).alias("value"))
    write_lines(lines, path, ("pos", "value"))
    return int(not findings.where(F.col("severity") == rules.ERROR).isEmpty())


def write_text(df: DataFrame, path: str) -> None:
    """A text file a partition; bulk output stays distributed."""
    df.select("value").write.mode("overwrite").text(path)
