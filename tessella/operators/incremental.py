"""The 23 checks for changed files only, from a manifest of what each file was and what others use of it."""

from __future__ import annotations

import hashlib
import json

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.semantics import present, relative_path
from ..scratch import drop, written
from ..sources import documents
from . import checks

MANIFEST = "kind string, file string, digest string, stem string, names array<string>, uses array<string>"
GLOBAL = "(global)"  # fixed value: the file of findings about no file


def _digests(texts: DataFrame, kind: str, root: str) -> DataFrame:
    """``kind, file, digest, value, _path``."""
    return texts.select(F.lit(kind).alias("kind"), relative_path(F.col("_path"), root).alias("file"), F.sha2(F.col("value"), 256).alias("digest"), "value", "_path")


def _context(edges: DataFrame, schema: dict) -> str:
    """A digest of the tree and the schema, which every file may depend on."""
    tree = edges.select(F.xxhash64("parent", "node").alias("h")).agg(F.sum(F.col("h").cast("decimal(38,0)")).alias("s"), F.count("*").alias("n")).first()
    return hashlib.sha256(f"{tree.s}|{tree.n}|{json.dumps(schema, sort_keys=True, default=str)}".encode()).hexdigest()


def _described(genera: DataFrame, clades: DataFrame) -> DataFrame:
    """``kind, file, stem, names, uses`` of decoded documents: species names, and those that synonyms name."""
    none = F.array().cast("array<string>")

    def named(keep, of: str):
        return F.coalesce(F.array_distinct(F.filter(F.transform(F.filter(F.col("species"), keep), lambda s: s[of]), lambda x: present(x))), none)

    g = genera.select(
        F.lit("genus").alias("kind"), F.col("_file").alias("file"), F.col("_stem").alias("stem"), named(lambda s: s.isNotNull(), "name").alias("names"), named(lambda s: s["status"] == "synonym", "synonym_of").alias("uses")
    )
    return g.unionByName(clades.select(F.lit("clade").alias("kind"), F.col("_file").alias("file"), F.col("_stem").alias("stem"), none.alias("names"), none.alias("uses")))


def _names(manifest: DataFrame) -> DataFrame:
    return manifest.select(F.explode("names").alias("value")).distinct()


def check_changes(
    genera: DataFrame, clades: DataFrame, edges: DataFrame, schema: dict, manifest: DataFrame | None = None, findings: DataFrame | None = None, *, roots: tuple[str, str] = ("", "")
) -> tuple[DataFrame, DataFrame, DataFrame]:
    """The manifest and findings of a data set's texts (``value, _path``), from those of the last run, and
    ``kind, file``, what was decoded and checked again.

    A file is checked again if its text is new or another, or if it calls a species a synonym of a name
    that came or went with other files. All findings of other files, but the global ones, are
    as they were. Without a last run, or if the tree or the schema have changed, all files are. Texts
    are hashed in the scan; only those checked again are decoded.
    """
    spark = genera.sparkSession
    context = _context(edges, schema)
    texts = written(_digests(genera, "genus", roots[0]).unionByName(_digests(clades, "clade", roots[1])), "texts")
    if manifest is None or manifest.where((F.col("kind") == "context") & (F.col("digest") == context)).isEmpty():
        manifest, findings = spark.createDataFrame([], MANIFEST), None
    old = manifest.where("kind <> 'context'")
    keys = ["kind", "file"]
    same = texts.select(*keys, "digest").join(old.select(*keys, "digest"), [*keys, "digest"], "left_semi").select(*keys)
    changed = texts.join(same, keys, "left_anti")

    def decoded(df: DataFrame) -> tuple[DataFrame, DataFrame]:
        parts = (("genus", documents.GENUS, roots[0]), ("clade", documents.CLADE, roots[1]))
        return tuple(documents.decode_documents(df.where(F.col("kind") == kind).select("value", "_path"), schema_, root) for kind, schema_, root in parts)

    new = _described(*decoded(changed)).join(changed.select(*keys, "digest"), keys)
    now = written(old.join(same, keys, "left_semi").unionByName(new.select(*old.columns)), "manifest")
    before, after = _names(old), _names(now)
    moved = before.join(after, "value", "left_anti").unionByName(after.join(before, "value", "left_anti"))
    users = now.select(*keys, F.explode("uses").alias("value")).join(moved, "value", "left_semi").select(*keys)
    removed = old.select(*keys).join(now, keys, "left_anti").select("file")
    touched = changed.select("file").unionByName(users.select("file")).unionByName(removed).distinct()
    again = written(now.join(touched, "file", "left_semi").select(*keys), "again")  # findings name a file, not its kind
    some = checks.Taxonomy(*decoded(texts.join(again, keys, "left_semi")), edges, schema)
    stems = now.where("kind = 'clade'").select(F.col("stem").alias("value"))
    found = checks.check_taxonomy(some, names=after, stems=stems)
    if findings is not None:
        rest = findings.where(F.col("file") != GLOBAL).join(touched, "file", "left_anti")
        found = found.unionByName(rest)
    found = written(found, "findings")
    drop(texts)
    state = written(now.unionByName(spark.createDataFrame([("context", "", context, None, [], [])], MANIFEST)), "manifest")
    drop(now)
    return state, found, again
