"""Folders of YAML or JSON documents as typed DataFrames, with broken files as rows and kinds kept."""

from __future__ import annotations

import json
import re
from collections.abc import Iterator
from functools import cache

import pandas as pd
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.semantics import file_stem, parent_folder, relative_path

_SCALAR = "struct<text:string,kind:string>"
REFERENCE = "struct<id:string,authors:string,year:int,title:string,journal:string,book:string,publisher:string,volume:string,issue:string,pages:string,doi:string,isbn:string,url:string,notes:string>"
SPECIES = (
    "struct<name:string,status:string,type_species:struct<text:string,kind:string>,completeness:string,etymology:string,"
    "holotype:struct<specimen_id:string,institution:string,material:string>,"
    f"period:struct<name:string,stage:string,from_ma:{_SCALAR},to_ma:{_SCALAR}>,"
    f"location:struct<country:string,region:string,locality:string,formation:string,coordinates:struct<is_list:boolean,items:array<{_SCALAR}>>>,"
    f"size:struct<length_m:{_SCALAR},weight_kg:{_SCALAR},hip_height_m:{_SCALAR},skull_length_m:{_SCALAR},estimate:{_SCALAR}>,"
    "described:int,authors:array<string>,description:string,synonym_of:string,described_in:string>"
)
GENUS = (
    "genus string, parent string, etymology string, pronunciation struct<ipa:string,phonetic:string>, description string, diet string, locomotion string, "
    "paleoenvironment array<string>, paleoenvironment_is_list boolean, appearance struct<integument:string,evidence:string,features:array<string>>, "
    f"diagnostic_features array<string>, identifiers array<struct<source:string,id:string>>, species array<{SPECIES}>, references array<{REFERENCE}>, "
    "described int, authors string, described_in string"
)
CLADE = f"clade string, description string, described int, authors string, diagnostic_features array<string>, references array<{REFERENCE}>"


@cache
def _loader() -> type:
    """A loader, made once a process, under the rules in which only true and false are booleans: NO and ON stay text."""
    import yaml

    base = getattr(yaml, "CSafeLoader", yaml.SafeLoader)
    loader = type("Loader", (base,), {})
    left_out = ("tag:yaml.org,2002:bool", "tag:yaml.org,2002:timestamp")
    loader.yaml_implicit_resolvers = {k: [(tag, rx) for tag, rx in v if tag not in left_out] for k, v in base.yaml_implicit_resolvers.items()}
    loader.add_implicit_resolver(left_out[0], re.compile(r"^(?:true|True|TRUE|false|False|FALSE)$"), list("tTfF"))
    return loader


def load_yaml(text: str):
    """A document; what looks like a date stays text."""
    import yaml

    return yaml.load(text, _loader())


def _text(x) -> str | None:
    if x is None:
        return None
    if isinstance(x, bool):
        return "true" if x else "false"
    if isinstance(x, float) and x.is_integer():
        return str(int(x))
    if isinstance(x, list):
        return ",".join(_text(y) or "" for y in x)
    return "[object Object]" if isinstance(x, dict) else str(x)


def _kind(x) -> str:
    if isinstance(x, bool):
        return "boolean"
    if isinstance(x, int | float):
        return "number"
    return "string" if isinstance(x, str) else "object"


def _fit(x, t: T.DataType):
    """A decoded value in the shape of a type; what doesn't fit is null, and scalars keep their kind where asked."""
    if isinstance(t, T.StructType):
        if t.names == ["text", "kind"]:
            return None if x is None else {"text": _text(x), "kind": _kind(x)}
        if t.names == ["is_list", "items"]:
            return None if not x and x != [] else {"is_list": isinstance(x, list), "items": [_fit(y, t["items"].dataType.elementType) for y in x] if isinstance(x, list) else []}
        return {f.name: _fit(x.get(f.name), f.dataType) for f in t.fields} if isinstance(x, dict) else None
    if isinstance(t, T.ArrayType):
        if isinstance(x, list):
            return [_fit(y, t.elementType) for y in x]
        return [_text(x)] if isinstance(x, str) and x and isinstance(t.elementType, T.StringType) else None
    if isinstance(t, T.BooleanType):
        return x if isinstance(x, bool) else None
    if isinstance(t, T.IntegerType):
        return x if isinstance(x, int) and not isinstance(x, bool) else int(x) if isinstance(x, str) and x.lstrip("-").isdigit() else None
    return _text(x)


def decoded(text: str, schema: T.StructType) -> tuple[dict | None, str | None, str | None]:
    """A document in the shape of the schema, its other fields as JSON, and the error if there is one."""
    flag = "paleoenvironment_is_list"
    try:
        doc = load_yaml(text)
        fitted = _fit(doc, schema) if isinstance(doc, dict) else None
        if fitted is not None and flag in fitted:
            fitted[flag] = isinstance(doc.get("paleoenvironment"), list)
        extra = {k: v for k, v in doc.items() if k not in schema.names} if isinstance(doc, dict) else {}
        return fitted, json.dumps(extra, default=str), None
    except Exception as e:  # a file that can't be decoded is a row of its own
        return None, None, str(e)


def _decoder(schema: T.StructType):
    def run(frames: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
        for frame in frames:
            rows = [(None if x is None else json.dumps(x), y, z) for x, y, z in (decoded(text, schema) for text in frame["value"])]
            out = pd.DataFrame(rows, columns=["_json", "_extra", "_error"])
            yield pd.concat([frame[["_path"]].reset_index(drop=True), out], axis=1)

    return run


ADDED = "_extra string, _file string, _stem string, _folder string, _error string"


def decode_documents(texts: DataFrame, schema: str, root: str = "", *, mode: str = "PERMISSIVE") -> DataFrame:
    """A row for each document of ``texts`` (``value``, ``_path``): the schema's columns, ``_extra``
    (other fields as JSON), ``_file`` (the path below ``root``), ``_stem``, ``_folder`` and ``_error``.

    In mode PERMISSIVE a text that can't be decoded has ``_error`` and nulls; FAILFAST raises.
    Each text is decoded once, where it is read. The order of documents is that of ``_file``.
    """
    t = T._parse_datatype_string(schema)
    decoded = texts.select("value", "_path").mapInPandas(_decoder(t), "_path string, _json string, _extra string, _error string")
    if mode == "FAILFAST":
        decoded = decoded.withColumn("_json", F.when(F.col("_error").isNotNull(), F.raise_error(F.concat(F.lit("cannot load "), "_path", F.lit(": "), "_error"))).otherwise(F.col("_json")))
    out = decoded.withColumn("_doc", F.from_json("_json", t)).withColumn("_file", relative_path(F.col("_path"), root))
    return out.select("_doc.*", "_extra", "_file", file_stem(F.col("_file")).alias("_stem"), parent_folder(F.col("_path")).alias("_folder"), "_error")


def read_documents(spark: SparkSession, folder: str, schema: str, *, mode: str = "PERMISSIVE", recursive: bool = True) -> DataFrame:
    """``decode_documents`` of each .yml or .yaml file below ``folder``; a missing folder gives no rows."""
    path = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(folder)
    if not path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(path):
        return spark.createDataFrame([], T.StructType([*T._parse_datatype_string(schema).fields, *T._parse_datatype_string(ADDED).fields]))
    files = spark.read.text(folder, wholetext=True, recursiveFileLookup=recursive, pathGlobFilter="*.{yml,yaml}")
    return decode_documents(files.select("value", F.col("_metadata.file_path").alias("_path")), schema, folder.removeprefix("file://"), mode=mode)


def keyed_last(df: DataFrame, key: str) -> DataFrame:
    """One document a key, of the last file: a later one replaces an earlier."""
    from ..operators.linkage import last_wins

    return last_wins(df.where(F.col("_error").isNull() & F.col(key).isNotNull()), [key], "_file")


# --- schema lists -------------------------------------------------------------


def vocabularies(spark: SparkSession, schema: dict) -> DataFrame:
    """``vocab, pos, value`` of the lists in a schema document."""
    rows = [(k, i, str(v)) for k, vs in schema.items() if isinstance(vs, list) for i, v in enumerate(vs)]
    return spark.createDataFrame(rows, "vocab string, pos int, value string")


def stages(spark: SparkSession, schema: dict) -> DataFrame:
    rows = [(k, v.get("period"), float(v["from_ma"]), float(v["to_ma"]), i) for i, (k, v) in enumerate((schema.get("stages") or {}).items())]
    return spark.createDataFrame(rows, "stage string, period string, from_ma double, to_ma double, pos int")


def countries(spark: SparkSession, schema: dict) -> DataFrame:
    return spark.createDataFrame([(k, v, i) for i, (k, v) in enumerate((schema.get("countries") or {}).items())], "code string, name string, pos int")


def stages_of(stage_frame: DataFrame, period: str) -> DataFrame:
    """The stages of a period, by name."""
    return stage_frame.where(F.col("period") == period).select("stage").orderBy("stage")


def values_of(vocab: DataFrame, name: str) -> DataFrame:
    return vocab.where(F.col("vocab") == name).select("pos", "value").orderBy("pos")


def read_json(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """A document of JSON over several lines. Who looks things up in it often may ``cache`` it, and release it."""
    return spark.read.schema(schema).option("multiLine", True).json(path)


def search_names(df: DataFrame, column: str, text: str, order: str, most: int = 50) -> DataFrame:
    """The first ``most`` rows by ``order`` whose column holds the text, upper or lower case."""
    return df.where(F.contains(F.lower(F.col(column)), F.lit(text.lower()))).orderBy(order).limit(most)
