"""Captured answers made from the suppliers, read as a source, and the SQL for the candidates they give."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..scratch import fresh_path
from ..sources import candidates, folders

SCHEMA = {"periods": ["Jurassic"], "stages": {"Campanian": {}}, "diet": ["herbivore", "carnivore"], "countries": {"US": "United States"}}


def captured_folder(spark: SparkSession, d: str) -> str:
    """Answers of three services about each supplier: some empty, some cut short, some never given."""
    s = spark.read.parquet(f"{d}/supplier.parquet").select(F.col("s_suppkey").alias("k"), F.concat(F.lit("S "), F.col("s_suppkey").cast("string")).alias("subject"))
    k = F.col("k").cast("string")
    taxon = F.format_string(
        '{"records":[{"taxon_attr":"Clerk, %s","diet":"%s","early_interval":"%s","family":"%s"},{"diet":"herbivory"}]}',
        (F.col("k") % 100 + 1850).cast("string"), F.when(F.col("k") % 3 == 0, "carnivory").otherwise("x"), F.when(F.col("k") % 2 == 0, "Late Jurassic").otherwise(""), F.when(F.col("k") % 3 > 0, "theropoda").otherwise("NO_FAMILY_SPECIFIED"),
    )
    taxa = s.select(F.lit("taxa").alias("service"), "subject", F.when(F.col("k") % 10 == 9, F.left(taxon, F.lit(20))).when(F.col("k") % 10 == 8, '{"records":[]}').otherwise(taxon).alias("body"))
    children = s.where("k % 4 <> 0").select(F.lit("children"), "subject", F.concat(F.lit('{"records":[{"accepted_rank":"genus","accepted_name":"g"},{"accepted_rank":"species","accepted_name":"'), k, F.lit(' a"},{"accepted_rank":"species","accepted_name":"b"}]}')))
    places = s.select(F.lit("occurrences"), "subject", F.concat(F.lit('{"records":[{"formation":"F'), (F.col("k") % 5).cast("string"), F.lit('","cc":"US","lat":'), (F.col("k") % 80 / 2).cast("string"), F.lit(',"lng":"-1"}]}')))
    folder = fresh_path(spark, "answers")
    folders.save_answers(taxa.union(children).union(places), folder)
    return folder


def found(spark: SparkSession, d: str) -> DataFrame:
    """``subject, header, value`` of the candidates, and a row for each answer that can't be decoded."""
    folder = captured_folder(spark, d)
    given = candidates.from_taxa(candidates.taxa_of(lambda service: folders.answers(spark, folder, service=service)), SCHEMA, ["Theropoda"])
    broken = folders.answers(spark, folder).where("_error IS NOT NULL").select("subject", F.lit("broken").alias("header"), F.col("service").alias("value"))
    return given.select("subject", "header", "value").unionByName(broken)


FOUND_SQL = """WITH s AS (SELECT s_suppkey AS k, 'S ' || s_suppkey AS subject, s_suppkey % 80 / 2.0::DOUBLE AS lat FROM supplier), g AS (SELECT * FROM s WHERE k % 10 NOT IN (8, 9))
SELECT subject, 'broken' AS header, 'taxa' AS value FROM s WHERE k % 10 = 9
UNION ALL SELECT subject, 'Authors', 'Clerk' FROM g
UNION ALL SELECT subject, 'Year described', (k % 100 + 1850)::VARCHAR FROM g
UNION ALL SELECT subject, 'Diet', 'carnivore' FROM g WHERE k % 3 = 0
UNION ALL SELECT subject, 'Period', 'Jurassic' FROM g WHERE k % 2 = 0
UNION ALL SELECT subject, 'Parent clade', 'Theropoda' FROM g WHERE k % 3 > 0
UNION ALL SELECT subject, 'Type species name', k || ' a' FROM g WHERE k % 4 <> 0
UNION ALL SELECT subject, 'Formation', 'F' || k % 5 FROM g
UNION ALL SELECT subject, 'Country', 'US' FROM g
UNION ALL SELECT subject, 'Coordinates', CASE WHEN lat = floor(lat) THEN lat::BIGINT::VARCHAR ELSE lat::VARCHAR END || ', -1' FROM g"""
