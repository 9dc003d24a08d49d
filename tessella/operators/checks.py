"""The 23 checks of a taxonomy of documents, as rules on its tables."""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.semantics import number_text, present, trim_all
from . import rules
from .rules import ERROR, WARNING, RowRule

# Names of the checks, in order, and the clades that need no file.
CHECKS = (
    "YAML syntax",
    "Schema compliance",
    "Tree consistency",
    "Clade coverage",
    "No orphan clades",
    "Naming conventions",
    "Required fields",
    "Type species",
    "Stage-period agreement",
    "Reference integrity",
    "Reference completeness",
    "Unique reference IDs",
    "Location completeness",
    "Country validation",
    "Coordinate validity",
    "Period consistency",
    "Synonym integrity",
    "Size validity",
    "Locomotion/completeness compliance",
    "Holotype consistency",
    "Appearance compliance",
    "Paleoenvironment compliance",
    "Identifier compliance",
)
SCAFFOLD = (
    "Life",
    "Animalia",
    "Arthropoda",
    "Trilobita",
    "Mollusca",
    "Cephalopoda",
    "Ammonoidea",
    "Chordata",
    "Vertebrata",
    "Actinopterygii",
    "Sarcopterygii",
    "Tetrapoda",
    "Synapsida",
    "Reptilia",
    "Lepidosauria",
    "Ichthyosauria",
    "Sauropterygia",
    "Plesiosauria",
    "Archosauria",
    "Pterosauria",
    "Crocodylomorpha",
    "Plantae",
)


@dataclass(frozen=True)
class Taxonomy:
    """Tables of one data set: documents, the tree's edges, and the schema's lists."""

    genera: DataFrame
    clades: DataFrame
    edges: DataFrame
    schema: dict


def _list(values) -> str:
    return ", ".join(map(str, values))


def _fmt(text: str, *cols: Column) -> Column:
    return F.format_string(text.replace("%", "%%").replace("{}", "%s"), *cols)


def _not_number(c: Column) -> Column:
    return c["kind"] != "number"


def _number(c: Column) -> Column:
    return F.when(c["kind"] == "number", c["text"].try_cast("double"))


def _species_rules(schema: dict) -> list[RowRule]:
    s = F.col("s")
    name = F.coalesce(s["name"], F.lit("?"))

    def rule(check: int, broken: Column, text: str, *cols: Column, severity: str = ERROR) -> RowRule:
        return RowRule(CHECKS[check - 1], F.coalesce(broken, F.lit(False)) & s.isNotNull(), _fmt("species '{}': " + text, name, *cols), severity)

    def vocabulary(check: int, c: Column, key: str, what: str) -> RowRule:
        allowed = list(map(str, schema.get(key) or []))
        return rule(check, present(c) & ~c.isin(allowed), f"invalid {what} '{{}}' (must be one of: {_list(allowed)})", c)

    out = [vocabulary(2, s["status"], "status", "status")]
    for field, missing in (("name", ~present(s["name"])), ("status", ~present(s["status"])), ("period", s["period"].isNull())):
        out.append(rule(7, missing, f"missing required field '{field}'"))
    period, stages = s["period"], schema.get("stages") or {}
    stage = F.try_element_at(F.create_map(*[x for k, v in stages.items() for x in (F.lit(k), F.struct(F.lit(v["period"]).alias("period"), F.lit(float(v["from_ma"])).alias("from"), F.lit(float(v["to_ma"])).alias("to")))]), period["stage"]) if stages else F.lit(None).cast("struct<period:string,from:double,to:double>")
    both = present(period["stage"]) & present(period["name"])
    out.append(rule(9, both & stage.isNull(), "unknown stage '{}'", period["stage"]))
    out.append(rule(9, both & (stage["period"] != period["name"]), "stage '{}' belongs to '{}', not '{}'", period["stage"], stage["period"], period["name"]))
    place = s["location"]
    out.append(rule(13, place.isNotNull() & ~present(place["country"]), "location present but missing 'country'"))
    codes = list((schema.get("countries") or {}).keys())
    out.append(rule(14, present(place["country"]) & ~place["country"].isin(codes), "country '{}' not in schema countries list", place["country"], severity=WARNING))
    at = place["coordinates"]
    whole = at["is_list"] & (F.size(at["items"]) >= 2)
    out.append(rule(15, at.isNotNull() & ~whole, "coordinates must be [lat, lon]"))
    for i, (what, most) in enumerate((("latitude", 90), ("longitude", 180))):
        x = F.get(at["items"], F.lit(i))
        shown = F.when(x.isNull(), F.lit("null")).otherwise(x["text"])
        out.append(rule(15, whole & (x.isNull() | _not_number(x) | ~_number(x).between(-most, most)), f"{what} {{}} out of range (-{most} to {most})", shown))
    for field in ("from_ma", "to_ma"):
        x = period[field]
        n = _number(x)
        out.append(
            rule(16, stage.isNotNull() & x.isNotNull() & (_not_number(x) | (n > stage["from"]) | (n < stage["to"])),
                 f"{field} {{}} outside stage '{{}}' range ({{}}–{{}} Ma)", x["text"], period["stage"], number_text(stage["from"]), number_text(stage["to"]))
        )
    out.append(rule(16, stage.isNotNull() & (_number(period["from_ma"]) < _number(period["to_ma"])), "from_ma ({}) must be >= to_ma ({})", period["from_ma"]["text"], period["to_ma"]["text"]))
    synonym = s["status"].eqNullSafe("synonym")
    out.append(rule(17, synonym & ~present(s["synonym_of"]), "status is 'synonym' but missing 'synonym_of'"))
    out.append(rule(17, ~synonym & present(s["synonym_of"]), "has 'synonym_of' but status is '{}', not 'synonym'", F.coalesce(s["status"], F.lit("undefined"))))
    for field in ("length_m", "weight_kg", "hip_height_m", "skull_length_m"):
        x = s["size"][field]
        out.append(rule(18, x.isNotNull() & (_not_number(x) | (_number(x) <= 0)), f"size.{field} must be a positive number (got {{}})", x["text"]))
    guess = s["size"]["estimate"]
    out.append(rule(18, guess.isNotNull() & (guess["kind"] != "boolean"), "size.estimate must be a boolean (got {})", guess["kind"]))
    out.append(vocabulary(19, s["completeness"], "completeness", "completeness"))
    for field in ("specimen_id", "institution"):
        out.append(rule(20, s["holotype"].isNotNull() & ~present(s["holotype"][field]), f"holotype present but missing '{field}'"))
    return out


def _genus_rules(schema: dict) -> list[RowRule]:
    def rule(check: int, broken: Column, text: str, *cols: Column) -> RowRule:
        return RowRule(CHECKS[check - 1], broken, _fmt(text, *cols))

    def vocabulary(check: int, c: Column, key: str, what: str) -> RowRule:
        allowed = list(map(str, schema.get(key) or []))
        return rule(check, present(c) & ~c.isin(allowed), f"invalid {what} '{{}}' (must be one of: {_list(allowed)})", c)

    genus, species = F.col("genus"), F.col("species")
    initial = F.upper(F.left(genus, F.lit(1)))
    typed = F.filter(species, lambda s: s["type_species"]["kind"].eqNullSafe("boolean") & s["type_species"]["text"].eqNullSafe("true"))
    out = [
        vocabulary(2, F.col("diet"), "diet", "diet value"),
        rule(6, present(genus) & (genus != F.col("_stem")), "filename '{}' does not match genus field '{}'", F.col("_stem"), genus),
        rule(6, present(genus) & (F.col("_folder") != initial), "file is in directory '{}' but genus '{}' should be in '{}'", F.col("_folder"), genus, initial),
        *[rule(7, ~present(F.col(f)), f"missing required field '{f}'") for f in ("genus", "parent", "description")],
        rule(7, species.isNull() | (F.size(species) == 0), "must have at least one species"),
        rule(8, species.isNotNull() & (F.size(typed) == 0), "no species marked as type_species"),
        rule(8, F.size(typed) > 1, "multiple species marked as type_species: {}", F.array_join(F.transform(typed, lambda s: s["name"]), ", ", "")),
        rule(10, present(F.col("described_in")) & ~F.coalesce(F.array_contains(F.col("references.id"), F.col("described_in")), F.lit(False)), "described_in '{}' does not match any reference id", F.col("described_in")),
        vocabulary(19, F.col("locomotion"), "locomotion", "locomotion value"),
        vocabulary(21, F.col("appearance.integument"), "integument", "integument"),
        vocabulary(21, F.col("appearance.evidence"), "integument_evidence", "integument evidence"),
    ]
    return out


def _reference_rules() -> list[RowRule]:
    r = F.col("r")
    name = F.coalesce(r["id"], F.lit("?"))
    check = CHECKS[10]
    kinds = {"id": "string", "authors": "string", "year": "number", "title": "string"}
    out = [RowRule(check, r.isNotNull() & ~present(r[f], k), _fmt(f"reference '{{}}': missing required field '{f}'", name)) for f, k in kinds.items()]
    none = ~present(r["journal"]) & ~present(r["book"])
    return [*out, RowRule(check, r.isNotNull() & none, _fmt("reference '{}': must have at least one of 'journal' or 'book'", name))]


def check_taxonomy(t: Taxonomy, *, names: DataFrame | None = None, stems: DataFrame | None = None) -> DataFrame:
    """``check, severity, file, message`` of all 23 checks.

    Where ``t`` has some of the documents only, ``names`` are the species names (``value``) and ``stems``
    the clade files (``value``) of all of them.

    Checks that look at one record are folded into one pass over genera, one over their species,
    and one over references; lists of the schema are part of those plans. Only lookups in other
    records (tree, species names) and duplicates are joins or aggregates of their own.
    """
    file = F.col("_file")
    good, clades = t.genera.where("_error IS NULL"), t.clades.where("_error IS NULL")
    tree = t.edges.select(F.col("node").alias("value")).distinct()
    out = []
    broken = t.genera.select("_file", "_error").unionByName(t.clades.select("_file", "_error")).where("_error IS NOT NULL")
    out.append(rules.row_findings(broken, [RowRule(CHECKS[0], F.lit(True), _fmt("YAML parse error: {}", F.col("_error")))], file))
    out.append(rules.row_findings(good, _genus_rules(t.schema), file))
    species = good.select("_file", "references", F.explode("species").alias("s"))
    own = _fmt("species '{}': described_in '{}' does not match any reference id", F.coalesce(F.col("s.name"), F.lit("?")), F.col("s.described_in"))
    lost = present(F.col("s.described_in")) & ~F.coalesce(F.array_contains(F.col("references.id"), F.col("s.described_in")), F.lit(False))
    out.append(rules.row_findings(species, [*_species_rules(t.schema), RowRule(CHECKS[9], lost, own)], file))
    out.append(rules.vocabulary_findings(good, "parent", tree, CHECKS[2], file, _fmt("parent clade '{}' not found in tree.yml", F.col("parent"))))
    spark = t.genera.sparkSession
    scaffold = spark.createDataFrame([(c,) for c in SCAFFOLD], "value string")
    stems = t.clades.select(F.col("_stem").alias("value")) if stems is None else stems
    bare = rules.uncovered(tree, "value", scaffold, stems)
    out.append(rules._finding(bare, CHECKS[3], WARNING, F.lit("(global)"), _fmt("clade '{}' in tree.yml has no corresponding file in clades/", F.col("value"))))
    out.append(rules.vocabulary_findings(t.clades, "_stem", tree, CHECKS[4], file, _fmt("clade file exists but '{}' is not in tree.yml", F.col("_stem"))))
    refs = good.select("_file", F.posexplode("references").alias("pos", "r")).unionByName(clades.select("_file", F.posexplode("references").alias("pos", "r")))
    out.append(rules.row_findings(refs, _reference_rules(), file))
    named = refs.where(present(F.col("r.id"))).select("_file", "pos", F.col("r.id").alias("id"))
    out.append(rules.uniqueness_findings(named, ["_file", "id"], ["pos"], CHECKS[11], file, _fmt("duplicate reference id '{}'", F.col("id"))))
    if names is None:
        names = species.select(F.col("s.name").alias("value")).where(present(F.col("value"))).distinct()
    synonyms = species.where("s.status = 'synonym'").select("_file", F.coalesce("s.name", F.lit("?")).alias("name"), F.col("s.synonym_of").alias("of"))
    out.append(rules.vocabulary_findings(synonyms, "of", names, CHECKS[16], file, _fmt("species '{}': synonym_of '{}' not found in any genus file", F.col("name"), F.col("of"))))
    allowed = list(map(str, t.schema.get("paleoenvironments") or []))
    places = good.select("_file", "paleoenvironment_is_list", F.explode("paleoenvironment").alias("e"))
    odd = F.when(F.col("paleoenvironment_is_list"), F.col("e").isNull() | ~F.col("e").isin(allowed)).otherwise(present(F.col("e")) & ~F.col("e").isin(allowed))
    text = _fmt(f"invalid paleoenvironment '{{}}' (must be one of: {_list(allowed)})", F.coalesce("e", F.lit("null")))
    out.append(rules.row_findings(places, [RowRule(CHECKS[21], odd, text)], file))
    ids = good.select("_file", F.posexplode("identifiers").alias("pos", "i")).where("i IS NOT NULL")
    source, given = F.col("i.source"), F.col("i.id")
    known = list(map(str, t.schema.get("identifier_sources") or []))
    out.append(
        rules.row_findings(
            ids,
            [
                RowRule(CHECKS[22], present(source) & ~source.isin(known), _fmt(f"invalid identifier source '{{}}' (must be one of: {_list(known)})", source)),
                RowRule(CHECKS[22], given.isNull() | (trim_all(given) == ""), _fmt("identifier with source '{}' has empty or missing 'id'", F.coalesce(source, F.lit("?")))),
            ],
            file,
        )
    )
    pairs = ids.withColumn("pair", F.concat_ws(":", F.coalesce(source, F.lit("undefined")), F.coalesce(given, F.lit("undefined"))))
    out.append(rules.uniqueness_findings(pairs, ["_file", "pair"], ["pos"], CHECKS[22], file, _fmt("duplicate identifier source/id pair: {}", F.col("pair"))))
    return rules.gather(*out)
