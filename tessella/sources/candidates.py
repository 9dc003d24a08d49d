"""Candidate values for a record from captured answers of three services."""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions import text as T
from ..functions import variants as V
from ..functions.semantics import present
from ..operators import linkage

# Headers whose last candidate always counts.
ALWAYS = {"header": ["External identifiers"]}
TAXON = "subject string, type_species string, authority string, diet string, early_interval string, late_interval string, family string, formation string, country string, region string, latitude string, longitude string"


def _candidates(df: DataFrame, source: str, values: Sequence[tuple[str, Column, str]], display: dict[str, Column] | None = None) -> DataFrame:
    none = F.lit(None).cast("string")
    rows = [F.struct(F.lit(h).alias("header"), v.cast("string").alias("value"), (display or {}).get(h, none).alias("display_value"), F.lit(kind).alias("field_type")) for h, v, kind in values]
    out = df.select("subject", F.explode(F.array(*rows)).alias("x")).select("subject", "x.*", F.lit(source).alias("source"))
    return out.where(present(F.col("value")))


def _interval(period: Column, schema: dict) -> tuple[Column, Column]:
    periods = [(p, p) for p in sorted(schema.get("periods") or [])]
    return linkage.first_match(period, periods), linkage.first_match(period, [(s, s) for s in (schema.get("stages") or {})])


def _clade(c: Column, clades: Sequence[str]) -> Column:
    names = F.create_map(*[F.lit(x) for n in reversed(list(clades)) for x in (n.lower(), n)]) if clades else F.lit(None).cast("map<string,string>")
    return F.try_element_at(names, F.lower(c))


def from_taxa(df: DataFrame, schema: dict, clades: Sequence[str]) -> DataFrame:
    """Of a fossil database's records (columns of ``TAXON``)."""
    period, stage = _interval(F.concat_ws(" ", "early_interval", F.nullif("late_interval", F.lit(""))), schema)
    known, countries = present(F.col("early_interval")), schema.get("countries") or {}
    family = F.when(F.col("family") != "NO_FAMILY_SPECIFIED", _clade(F.col("family"), clades))
    at = F.when(present(F.col("latitude")) & present(F.col("longitude")), F.concat("latitude", F.lit(", "), "longitude"))
    country = F.when(F.col("country").isin(list(countries)), F.col("country"))
    return _candidates(
        df,
        "PBDB",
        [
            ("Type species name", F.col("type_species"), "text"),
            ("Authors", T.authority_authors(F.col("authority")), "text"),
            ("Year described", T.authority_year(F.col("authority")), "text"),
            ("Diet", linkage.match_diet(F.col("diet"), sorted(schema.get("diet") or [])), "select"),
            ("Period", F.when(known, period), "select"),
            ("Stage", F.when(known, stage), "select"),
            ("Parent clade", family, "search"),
            ("Formation", F.col("formation"), "text"),
            ("Country", country, "search"),
            ("Region", F.col("region"), "text"),
            ("Coordinates", at, "text"),
        ],
        {"Country": linkage.display_name(country, countries)} if countries else None,
    )


def article_fields(df: DataFrame) -> DataFrame:
    """``subject, type_species, ..`` of ``subject, wikitext, sections, html, extract``."""
    box = df.withColumn("box", T.infobox("wikitext"))

    def field(*names: str) -> Column:
        return T.strip_markup(F.coalesce(*[F.try_element_at("box", F.lit(n)) for n in names], F.lit("")))

    kind = field("type_species", "type")
    both = F.concat(field("genus"), F.lit(" "), field("species"))
    summary = T.first_paragraph(F.col("extract"))
    return box.select(
        "subject",
        F.when(present(kind), kind).when(present(field("genus")) & present(field("species")), both).alias("type_species"),
        field("temporal_range", "fossil_range", "range").alias("temporal_range"),
        field("authority", "parent_authority").alias("authority"),
        field("formation").alias("formation"),
        field("country", "location", "fossil_site").alias("country"),
        F.when(present(summary), summary).otherwise(T.first_body("wikitext")).alias("summary"),
        T.etymology(F.col("wikitext"), F.col("sections")).alias("etymology"),
        T.ipa(F.coalesce("html", F.lit(""))).alias("ipa"),
    )


def from_articles(df: DataFrame, schema: dict, compat: bool = True) -> DataFrame:
    """Of encyclopedia articles, by their fields."""
    period, stage = _interval(F.col("temporal_range"), schema)
    countries = schema.get("countries") or {}
    country = linkage.match_country(F.col("country"), countries, compat)
    return _candidates(
        df,
        "Wikipedia",
        [
            ("Type species name", F.col("type_species"), "text"),
            ("Period", period, "select"),
            ("Stage", stage, "select"),
            ("Authors", T.authority_authors(F.col("authority")), "text"),
            ("Year described", T.authority_year(F.col("authority")), "text"),
            ("Formation", F.col("formation"), "text"),
            ("Country", country, "search"),
            ("Genus description", F.col("summary"), "textarea"),
            ("Genus etymology", F.col("etymology"), "text"),
            ("Diet", T.infer_diet(F.col("summary")), "select"),
            ("Locomotion", T.infer_locomotion(F.col("summary")), "select"),
            ("Pronunciation (IPA)", F.col("ipa"), "text"),
        ],
        {"Country": linkage.display_name(country, countries)} if countries else None,
    )


def entity_fields(entities: DataFrame, labels: DataFrame) -> DataFrame:
    """``subject, qid, type_species, diet, parent_taxon, mass`` of ``subject, qid, claims`` (a VARIANT,
    or JSON), with claims that name another entity resolved to its label (``labels``: ``qid, label``).

    Claims that can't be decoded, or have another shape, give nulls.
    """
    # Properties of an entity.
    targets = {"type_species": "P427", "diet": "P186", "parent_taxon": "P171"}
    claims = F.col("claims") if entities.schema["claims"].dataType.typeName() == "variant" else F.try_parse_json("claims")
    first = {p: V.at(claims, f"$.{p}[0].mainsnak") for p in (*targets.values(), "P2067")}

    def value(p: str, path: str, kind: str | None = None) -> Column:
        snak = first[p]
        known = V.at(snak, "$.snaktype", "string") == "value"
        if kind:
            known &= F.coalesce(V.at(snak, "$.datavalue.type", "string"), F.lit(kind)) == kind
        return F.when(known, V.at(snak, f"$.datavalue.value.{path}", "string"))

    out = entities.select("subject", "qid", *[value(p, "id", "wikibase-entityid").alias(n) for n, p in targets.items()], T.mass_text(value("P2067", "amount"), value("P2067", "unit")).alias("mass"))
    for name in targets:
        names = labels.select(F.col("qid").alias(name), F.col("label").alias("_label"))
        out = out.join(names, name, "left").withColumn(name, F.col("_label")).drop("_label")
    return out.select("subject", "qid", *targets, "mass")


def from_entities(df: DataFrame, schema: dict, clades: Sequence[str]) -> DataFrame:
    return _candidates(
        df,
        "Wikidata",
        [
            ("Type species name", F.col("type_species"), "text"),
            ("Diet", linkage.match_diet(F.col("diet"), sorted(schema.get("diet") or [])), "select"),
            ("Estimated weight (kg)", F.col("mass"), "text"),
            ("Parent clade", _clade(F.col("parent_taxon"), clades), "search"),
            ("External identifiers", F.when(present(F.col("qid")), F.concat(F.lit("wikidata: "), "qid")), "textarea"),
        ],
    )


def merged(*sources: DataFrame) -> DataFrame:
    """``subject, header, value, ..``: each header from the first source that has it; identifiers from the last."""
    return linkage.priority_merge(sources, ["subject", "header"], ALWAYS)


def first_record(df: DataFrame, key: str, order: str) -> DataFrame:
    return linkage.first_wins(df, [key], [order])


def type_species_of(children: DataFrame) -> DataFrame:
    """``subject, name``: of a taxon's children (``subject, rank, name, pos``) the first species."""
    return children.where("rank = 'species'").groupBy("subject").agg(F.min_by("name", "pos").alias("name"))


# --- captured answers -----------------------------------------------------------


#: Gives the captured answers of a service (``folders.answers`` with its name), loaded for each call.
Answers = Callable[[str], DataFrame]


def _records(answers: Answers, service: str) -> DataFrame:
    """``subject, pos, v`` of a service's records."""
    return answers(service).where(F.col("record").isNotNull()).select("subject", "pos", F.parse_json("record").alias("v"))


def taxa_of(answers: Answers) -> DataFrame:
    """The columns of ``TAXON`` from captured answers: each subject's first taxon,
    the first species among its children, and its first occurrence. Subjects without a taxon have no row."""
    # Names of a record's fields.
    taxon = {"authority": "taxon_attr", "diet": "diet", "early_interval": "early_interval", "late_interval": "late_interval", "family": "family"}
    place = {"formation": "formation", "country": "cc", "region": "state", "latitude": "lat", "longitude": "lng"}

    def fields(names: dict[str, str]) -> list[Column]:
        return [F.coalesce(V.shown(V.at(F.col("v"), f"$.{old}")), F.lit("")).alias(new) for new, old in names.items()]

    found = _records(answers, "taxa").where("pos = 0").select("subject", *fields(taxon))
    children = _records(answers, "children").select("subject", V.at(F.col("v"), "$.accepted_rank", "string").alias("rank"), V.at(F.col("v"), "$.accepted_name", "string").alias("name"), "pos")
    species = type_species_of(children).withColumnRenamed("name", "type_species")
    at = _records(answers, "occurrences").where("pos = 0").select("subject", *fields(place))
    out = found.join(species, "subject", "left").join(at, "subject", "left")
    return out.select("subject", "type_species", *taxon, *place)


def entities_of(answers: Answers) -> tuple[DataFrame, DataFrame]:
    """``subject, qid, claims`` of each subject's first hit of the search, and ``qid, label``: what
    ``entity_fields`` takes."""
    hits = _records(answers, "search").where("pos = 0").select("subject", V.at(F.col("v"), "$.id", "string").alias("qid"))
    entities = _records(answers, "entities").withColumnRenamed("subject", "qid")
    claims = hits.join(entities, "qid").select("subject", "qid", V.at(F.col("v"), "$.claims").alias("claims"))
    labels = entities.select("qid", V.at(F.col("v"), "$.labels.en.value", "string").alias("label")).where("label IS NOT NULL")
    return claims, labels


def articles_of(answers: Answers) -> DataFrame:
    """``subject, wikitext, sections, html, extract``, what ``article_fields`` takes. An answer that
    reports an error gives no row."""
    v = F.col("v")
    page = _records(answers, "articles").where(V.at(v, "$.error").isNull())
    page = page.select(
        "subject",
        F.coalesce(V.at(v, "$.parse.wikitext['*']", "string"), F.lit("")).alias("wikitext"),
        V.at(v, "$.parse.sections", "array<struct<line:string,level:string>>").alias("sections"),
        F.coalesce(V.at(v, "$.parse.text['*']", "string"), F.lit("")).alias("html"),
    )
    first = F.get(F.map_values(V.members(V.at(v, "$.query.pages"))), F.lit(0))
    extracts = _records(answers, "extracts").select("subject", V.at(first, "$.extract", "string").alias("extract"))
    return page.join(extracts, "subject", "left")
