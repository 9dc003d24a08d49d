"""A taxonomy of documents made from the plain tables, and the SQL for what the checks and exports say of it.

A supplier becomes a genus file, a region, most nations and each kind of part a clade file; world,
regions and nations are the tree. Nineteen genus files of twenty have one fault, by the key; sizes and
coordinates come from the balance, so they are right or wrong as the balance is.
"""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions import paths
from ..operators import checks, forms
from ..scratch import written
from ..sinks import exports
from ..sources import documents

SCHEMA = """
status: [valid, synonym]
diet: [herbivore, carnivore]
locomotion: [bipedal]
completeness: [partial]
integument: [scales]
integument_evidence: [direct]
paleoenvironments: [river, forest]
identifier_sources: [pbdb]
stages:
  Campanian: {period: Late Cretaceous, from_ma: 83.6, to_ma: 72}
countries: {NO: Norway}
"""

GENUS = """
genus: S{k}
parent: {nation}
description: Supplier {k}
diet: herbivore
locomotion: bipedal
described_in: r{r}
paleoenvironment: [river]
appearance: {integument: scales, evidence: direct}
identifiers: [{source: pbdb, id: {k}}]
species:
  - name: S{k} primus
    status: valid
    type_species: true
    completeness: partial
    period: {name: Late Cretaceous, stage: Campanian, from_ma: 83.6, to_ma: 72.0}
    location: {country: NO, coordinates: [{lat}, {lon}]}
    size: {length_m: {length}}
    holotype: {specimen_id: X1, institution: M}
  - {name: S{k} alter, status: synonym, synonym_of: S{k} primus, period: {name: Late Cretaceous}}
references:
  - {id: r{r}, authors: Author {k}, year: 1889, title: On S{k}, journal: J}
"""
CLADE = "clade: {k}\nreferences:\n  - {id: c, authors: A, year: 1900, title: On {k}, book: B}\n"

#: Faults by the key's remainder of 20: what is replaced by what.
FAULTS = (
    ("references:", "references: 'open"),
    ("diet: herbivore", "diet: fungivore"),
    ("parent: ", "parent: No "),
    ("genus: S", "genus: T"),
    ("description: Supplier", "description: '' #"),
    ("type_species: true", "type_species: 'yes'"),
    ("stage: Campanian", "stage: Nope"),
    ("described_in: r", "described_in: q"),
    ("journal: J", "volume: 3"),
    ("references:\n", "references:\n  - {id: z, authors: A, year: 1, title: T, book: B}\n  - {id: z, authors: A, year: 1, title: T, book: B}\n"),
    ("country: NO, ", ""),
    ("country: NO", "country: ZZ"),
    ("from_ma: 83.6", "from_ma: 84"),
    ("synonym_of: S", "synonym_of: X"),
    ("locomotion: bipedal", "locomotion: hops"),
    ("specimen_id: X1, ", ""),
    ("integument: scales", "integument: wool"),
    ("[river]", "[river, sea]"),
    ("source: pbdb", "source: x"),
)


def _filled(template: str, **values: Column | str):
    text = F.lit(template)
    for name, value in values.items():
        text = F.replace(text, F.lit(f"{{{name}}}"), F.col(value).cast("string") if isinstance(value, str) else value.cast("string"))
    return text


def taxonomy(spark: SparkSession, d: str, edges: DataFrame) -> checks.Taxonomy:
    supplier, nation, region, part = (spark.read.parquet(f"{d}/{t}.parquet") for t in ("supplier", "nation", "region", "part"))
    s = supplier.join(nation, F.col("s_nationkey") == F.col("n_nationkey"))
    b = F.col("s_acctbal").cast("double")
    text = _filled(GENUS, k="s_suppkey", r=F.col("s_suppkey") % 30, nation="n_name", lat=b / 100, lon=b / 50, length=b)
    fault = F.col("s_suppkey") % (len(FAULTS) + 1)
    broken = F.when(fault == 0, F.replace(text, F.lit(FAULTS[0][0]), F.lit(FAULTS[0][1])))
    for i, (old, new) in enumerate(FAULTS[1:], 1):
        broken = broken.when(fault == i, F.replace(text, F.lit(old), F.lit(new)))
    genera = s.select(broken.otherwise(text).alias("value"), F.format_string("/genera/S/S%s.yml", F.col("s_suppkey").cast("string")).alias("_path"))
    names = region.select(F.col("r_name").alias("k")).union(nation.where("n_nationkey % 7 <> 6").select("n_name")).union(part.select("p_type").distinct())
    clades = names.select(_filled(CLADE, k="k").alias("value"), F.concat(F.lit("/clades/"), "k", F.lit(".yml")).alias("_path"))
    return checks.Taxonomy(
        documents.decode_documents(genera, documents.GENUS, "/genera"), documents.decode_documents(clades, documents.CLADE, "/clades"), edges, documents.load_yaml(SCHEMA)
    )


def findings(spark: SparkSession, d: str, edges: DataFrame) -> DataFrame:
    """All findings; what a parser says of a broken text isn't fixed, so it is left out.

    The checks read the documents a dozen times, so decoded ones are tables of their own, until the driver ends.
    """
    t = taxonomy(spark, d, edges)
    kept = replace(t, genera=written(t.genera, "genera"), clades=written(t.clades, "clades"))
    return checks.check_taxonomy(kept).withColumn("message", F.regexp_replace("message", r"(?s)^(YAML parse error).*", "$1"))


_ROWS = """WITH s AS (SELECT s_suppkey AS k, s_suppkey % 20 AS f, n_name AS nation, s_acctbal::DOUBLE AS b, s_acctbal::DOUBLE / 100 AS lat, s_acctbal::DOUBLE / 50 AS lon,
  'S' || s_suppkey || '.yml' AS path FROM supplier JOIN nation ON s_nationkey = n_nationkey),
g AS (SELECT *, 'S/' || path AS file, 'species ''S' || k || ' primus'': ' AS p, 'species ''S' || k || ' alter'': ' AS a FROM s WHERE f <> 0)
"""

FINDINGS_SQL = _ROWS + """, tree AS (SELECT 'World' AS name UNION ALL SELECT r_name FROM region UNION ALL SELECT n_name FROM nation),
clade AS (SELECT r_name AS name FROM region UNION ALL SELECT n_name FROM nation WHERE n_nationkey % 7 <> 6 UNION ALL SELECT DISTINCT p_type FROM part)
SELECT 'YAML syntax' AS "check", 'error' AS severity, 'S/' || path AS file, 'YAML parse error' AS message FROM s WHERE f = 0
UNION ALL SELECT 'Schema compliance', 'error', file, 'invalid diet value ''fungivore'' (must be one of: herbivore, carnivore)' FROM g WHERE f = 1
UNION ALL SELECT 'Tree consistency', 'error', file, 'parent clade ''No ' || nation || ''' not found in tree.yml' FROM g WHERE f = 2
UNION ALL SELECT 'Clade coverage', 'warning', '(global)', 'clade ''' || name || ''' in tree.yml has no corresponding file in clades/' FROM tree WHERE name NOT IN (SELECT name FROM clade)
UNION ALL SELECT 'No orphan clades', 'error', name || '.yml', 'clade file exists but ''' || name || ''' is not in tree.yml' FROM clade WHERE name NOT IN (SELECT name FROM tree)
UNION ALL SELECT 'Naming conventions', 'error', file, unnest(['filename ''S' || k || ''' does not match genus field ''T' || k || '''', 'file is in directory ''S'' but genus ''T' || k || ''' should be in ''T''']) FROM g WHERE f = 3
UNION ALL SELECT 'Required fields', 'error', file, 'missing required field ''description''' FROM g WHERE f = 4
UNION ALL SELECT 'Type species', 'error', file, 'no species marked as type_species' FROM g WHERE f = 5
UNION ALL SELECT 'Stage-period agreement', 'error', file, p || 'unknown stage ''Nope''' FROM g WHERE f = 6
UNION ALL SELECT 'Reference integrity', 'error', file, 'described_in ''q' || k % 30 || ''' does not match any reference id' FROM g WHERE f = 7
UNION ALL SELECT 'Reference completeness', 'error', file, 'reference ''r' || k % 30 || ''': must have at least one of ''journal'' or ''book''' FROM g WHERE f = 8
UNION ALL SELECT 'Unique reference IDs', 'error', file, 'duplicate reference id ''z''' FROM g WHERE f = 9
UNION ALL SELECT 'Location completeness', 'error', file, p || 'location present but missing ''country''' FROM g WHERE f = 10
UNION ALL SELECT 'Country validation', 'warning', file, p || 'country ''ZZ'' not in schema countries list' FROM g WHERE f = 11
UNION ALL SELECT 'Coordinate validity', 'error', file, p || 'latitude ' || CASE WHEN lat = floor(lat) THEN lat::BIGINT::VARCHAR ELSE lat::VARCHAR END || ' out of range (-90 to 90)' FROM g WHERE NOT lat BETWEEN -90 AND 90
UNION ALL SELECT 'Coordinate validity', 'error', file, p || 'longitude ' || CASE WHEN lon = floor(lon) THEN lon::BIGINT::VARCHAR ELSE lon::VARCHAR END || ' out of range (-180 to 180)' FROM g WHERE NOT lon BETWEEN -180 AND 180
UNION ALL SELECT 'Period consistency', 'error', file, p || 'from_ma 84 outside stage ''Campanian'' range (83.6–72 Ma)' FROM g WHERE f = 12
UNION ALL SELECT 'Synonym integrity', 'error', file, a || 'synonym_of ''X' || k || ' primus'' not found in any genus file' FROM g WHERE f = 13
UNION ALL SELECT 'Size validity', 'error', file, p || 'size.length_m must be a positive number (got ' || CASE WHEN b = floor(b) THEN b::BIGINT::VARCHAR ELSE b::VARCHAR END || ')' FROM g WHERE b <= 0
UNION ALL SELECT 'Locomotion/completeness compliance', 'error', file, 'invalid locomotion value ''hops'' (must be one of: bipedal)' FROM g WHERE f = 14
UNION ALL SELECT 'Holotype consistency', 'error', file, p || 'holotype present but missing ''specimen_id''' FROM g WHERE f = 15
UNION ALL SELECT 'Appearance compliance', 'error', file, 'invalid integument ''wool'' (must be one of: scales)' FROM g WHERE f = 16
UNION ALL SELECT 'Paleoenvironment compliance', 'error', file, 'invalid paleoenvironment ''sea'' (must be one of: river, forest)' FROM g WHERE f = 17
UNION ALL SELECT 'Identifier compliance', 'error', file, 'invalid identifier source ''x'' (must be one of: pbdb)' FROM g WHERE f = 18"""


def references(spark: SparkSession, d: str, edges: DataFrame) -> DataFrame:
    """The bibliography: each id once, from the first file that has it."""
    t = taxonomy(spark, d, edges)
    return exports.bibliography(t.genera.where("_error IS NULL"), t.clades.where("_error IS NULL"))


REFERENCES_SQL = _ROWS + r""", r AS (SELECT 'r' || k % 30 AS id, file, '@article{r' || k % 30 || e',\n  author = {Author ' || k || e'},\n  year = {1889},\n  title = {On S' || k
  || CASE WHEN f = 8 THEN e'},\n  volume = {3' ELSE e'},\n  journal = {J' END || e'}\n}\n' AS value FROM g)
SELECT first(value ORDER BY file) AS value FROM r GROUP BY id
UNION ALL SELECT e'@incollection{z,\n  author = {A},\n  year = {1},\n  title = {T},\n  booktitle = {B}\n}\n' FROM g WHERE f = 9 HAVING count(*) > 0
UNION ALL SELECT e'@incollection{c,\n  author = {A},\n  year = {1900},\n  title = {On ' || min(name) || e'},\n  booktitle = {B}\n}\n'
FROM (SELECT r_name AS name FROM region UNION ALL SELECT n_name FROM nation WHERE n_nationkey % 7 <> 6 UNION ALL SELECT p_type FROM part) HAVING count(*) > 0"""


def prefilled(spark: SparkSession, d: str, edges: DataFrame) -> DataFrame:
    """The values that a form for a genus begins with."""
    return forms.current_values(taxonomy(spark, d, edges).genera.where("_error IS NULL"))


PREFILLED_SQL = _ROWS + """SELECT genus, header, value FROM (SELECT f, CASE WHEN f = 3 THEN 'T' ELSE 'S' END || k AS genus, unnest(['Parent clade', 'Genus description', 'Diet', 'Locomotion', 'Integument', 'Integument evidence', 'Paleoenvironment', 'External identifiers']) AS header,
unnest([CASE WHEN f = 2 THEN 'No ' ELSE '' END || nation, 'Supplier ' || k, CASE WHEN f = 1 THEN 'fungivore' ELSE 'herbivore' END, CASE WHEN f = 14 THEN 'hops' ELSE 'bipedal' END,
CASE WHEN f = 16 THEN 'wool' ELSE 'scales' END, 'direct', CASE WHEN f = 17 THEN 'river, sea' ELSE 'river' END, CASE WHEN f = 18 THEN 'x: ' ELSE 'pbdb: ' END || k]) AS value FROM g)
WHERE NOT (f = 4 AND header = 'Genus description')"""


def values(spark: SparkSession, d: str, edges: DataFrame) -> DataFrame:
    """Values at some paths into each genus document: fields, and lists of fields joined."""
    good = taxonomy(spark, d, edges).genera.where("_error IS NULL")
    found = paths.path_set({"Parent": "parent", "Names": "species.name", "References": "references.id", "Environment": ("paleoenvironment", "; "), "Identifiers": ("identifiers", "\n", "{source}: {id}")})
    pairs = F.array(*[F.struct(F.lit(h).alias("header"), read(good.schema, None).alias("value")) for h, read in found.items()])
    return good.select("_file", F.explode(pairs).alias("x")).select(F.col("_file").alias("file"), "x.header", "x.value")


VALUES_SQL = _ROWS + """SELECT file, unnest(['Parent', 'Names', 'References', 'Environment', 'Identifiers']) AS header, unnest([CASE WHEN f = 2 THEN 'No ' ELSE '' END || nation, 'S' || k || ' primus, S' || k || ' alter',
CASE WHEN f = 9 THEN 'z, z, ' ELSE '' END || 'r' || k % 30, CASE WHEN f = 17 THEN 'river; sea' ELSE 'river' END, CASE WHEN f = 18 THEN 'x: ' ELSE 'pbdb: ' END || k]) AS value FROM g"""
