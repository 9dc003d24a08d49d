"""Forms as data: flows of steps and fields, compiled to one projection over their values."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions import paths
from ..functions.semantics import present
from . import forms

FIELD = "flow string, step int, step_name string, pos int, header string, type string, required boolean, options_key string, current_key string, validate string, shown_by string, shown_value string, hidden_value string"
TYPES = ("text", "number", "textarea", "select", "search", "checkboxes", "readonly")
VALUES = "map<string,string>"  # what a form's fields hold, by header
CHECKED = "map<string,array<string>>"  # and its checkboxes

Rule = Callable[[Column], Column]


def fields_of(flow: Mapping) -> list[dict]:
    """The fields of a flow in order. A type, or a field to depend on, that isn't known is an error."""
    out = [{"step": i, "step_name": s["name"], "pos": k, **f} for i, s in enumerate(flow["steps"]) for k, f in enumerate(s["fields"])]
    known = {f["header"] for f in out}
    for f in out:
        if f["type"] not in TYPES:
            raise ValueError(f"{f['header']!r} is of no known type: {f['type']!r}")
        if f.get("showWhen") and f["showWhen"]["field"] not in known:
            raise ValueError(f"{f['header']!r} depends on {f['showWhen']['field']!r}, which the flow doesn't have")
    return out


def field_table(spark: SparkSession, flows: Mapping[str, Mapping]) -> DataFrame:
    """All fields of some flows, a row each."""
    rows = []
    for name, flow in flows.items():
        for f in fields_of(flow):
            when = f.get("showWhen") or {}
            rows.append((name, f["step"], f["step_name"], f["pos"], f["header"], f["type"], bool(f.get("required")), f.get("optionsKey"), f.get("currentKey"), f.get("validate"), when.get("field"), when.get("value"), when.get("notValue")))
    return spark.createDataFrame(rows, FIELD)


def options(spark: SparkSession, flows: Mapping[str, Mapping], lists: DataFrame, stages: DataFrame | None = None) -> DataFrame:
    """``flow, header, options, by_period``: the values of each field's list (``vocab, pos, value``), an empty
    list where there is none. Fields filtered by period have a list for each period (of ``stages``,
    ``period, stage``) besides that of all."""
    rows = [(name, f["header"], f["optionsKey"], bool(f.get("filteredByPeriod"))) for name, flow in flows.items() for f in fields_of(flow) if f.get("optionsKey")]
    wanted = spark.createDataFrame(rows, "flow string, header string, vocab string, filtered boolean")
    held = lists.groupBy("vocab").agg(F.transform(F.array_sort(F.collect_list(F.struct("pos", "value"))), lambda x: x["value"]).alias("options"))
    out = wanted.join(held, "vocab", "left").withColumn("options", F.coalesce("options", F.array().cast("array<string>")))
    none = F.lit(None).cast("map<string,array<string>>")
    if stages is None:
        return out.select("flow", "header", "options", none.alias("by_period"))
    per = stages.groupBy("period").agg(F.array_sort(F.collect_list("stage")).alias("s"))
    by = per.agg(F.map_from_entries(F.collect_list(F.struct("period", "s"))).alias("by"))  # a schema's periods
    return out.crossJoin(by).select("flow", "header", "options", F.when(F.col("filtered"), F.col("by")).alias("by_period"))  # one row


def _value(header: str) -> Column:
    return F.try_element_at("values", F.lit(header))


def shown(field: Mapping) -> Column:
    """Whether a field shows, by the value of the one it depends on; an absent value is an empty text."""
    when = field.get("showWhen")
    if not when:
        return F.lit(True)
    other = F.coalesce(_value(when["field"]), F.lit(""))
    if when.get("value"):
        return other == when["value"]
    if when.get("notEmpty"):
        return (other != "") & (F.lit(when.get("notValue") is None) | (other != F.lit(when.get("notValue") or "")))
    return F.lit(True)


def rules(known_sources: Sequence[str], this_year: Column | None = None, **more: Rule) -> dict[str, Rule]:
    """The rules that fields name, and ``more``, as for names that exist already (by a joined column)."""
    own: dict[str, Rule] = {
        "coordinates": forms.coordinates,
        "positiveNumber": forms.positive_number,
        "year": lambda v: forms.year(v, this_year),
        "identifiers": lambda v: forms.identifiers(v, known_sources),
    }
    return own | more


def problems(df: DataFrame, flow: Mapping, checks: Mapping[str, Rule], step: int | None = None) -> DataFrame:
    """``df`` (``values``, ``checked``: maps by header) with ``problems``, a map of a message for each field
    that has one: hidden fields have none, and a required value that is missing comes before its format.

    A flow becomes one projection in the scan's own stage. A rule that a field names and ``checks``
    doesn't have is an error. ``step``: of that step's fields alone.
    """
    pairs = []
    for f in fields_of(flow):
        if step is not None and f["step"] != step:
            continue
        name = f.get("validate")
        if name and name not in checks:
            raise ValueError(f"{f['header']!r} names an unknown rule: {name!r}")
        v = _value(f["header"])
        rule = checks[name](v) if name else None
        if f["type"] == "checkboxes":
            some = F.coalesce(F.size(F.try_element_at("checked", F.lit(f["header"]))) > 0, F.lit(False))
            message = F.when(shown(f) & ~some & F.lit(bool(f.get("required"))), F.lit("This field is required"))
        else:
            message = forms.field_problem(v, shown(f), bool(f.get("required")), rule)
        pairs.append(F.struct(F.lit(f["header"]).alias("key"), message.alias("value")))
    none = F.lit(None).cast("array<struct<key:string,value:string>>")
    found = F.filter(F.array(*pairs) if pairs else F.coalesce(none, F.array().cast("array<struct<key:string,value:string>>")), lambda x: x["value"].isNotNull())
    return df.withColumn("problems", F.map_from_entries(found))


# Of a current list, what stands between its items, and the form of an item.
JOINED = {"appearance.features": ("\n", None), "diagnostic_features": ("\n", None), "identifiers": ("\n", "{source}: {id}")}


def current_paths(flow: Mapping, without: Sequence[str] = ()) -> dict[str, paths.Reader]:
    """Readers by header for the fields that begin with a record's value (``currentKey``), but for the keys in ``without``."""
    keys = {f["header"]: f["currentKey"] for f in fields_of(flow) if f.get("currentKey") and not f["currentKey"].startswith("_") and f["currentKey"] not in without}
    return paths.path_set({h: (k, *JOINED.get(k, (", ", None))) for h, k in keys.items()})


def with_current(df: DataFrame, flow: Mapping, record: T.StructType, *, chosen: Mapping[str, tuple[Column, T.DataType]] | None = None, without: Sequence[str] = (), name: str = "current") -> DataFrame:
    """``df``, which has a record's columns, with its values as the flow's fields show them: a map of those present."""
    pairs = [F.struct(F.lit(h).alias("key"), read(record, chosen).alias("value")) for h, read in current_paths(flow, without).items()]
    held = F.array(*pairs) if pairs else F.array().cast("array<struct<key:string,value:string>>")
    return df.withColumn(name, F.map_from_entries(F.filter(held, lambda x: present(x["value"]))))


# Paths that a form's body doesn't look up, so that these fields always count as changed.
BODY_WITHOUT = ("pronunciation.ipa", "pronunciation.phonetic")


def bodies(df: DataFrame, flow: Mapping, lists: Mapping[str, Sequence[str]]) -> DataFrame:
    """``df`` (``values``, ``checked`` and, in flows that update, ``current``) with ``body``: the given fields as
    sections in order; of an update, without those that are as they were. Checkboxes show all options."""
    parts = []
    for f in fields_of(flow):
        if f["type"] == "readonly":
            continue
        h = f["header"]
        if f["type"] == "checkboxes":
            marked = F.coalesce(F.try_element_at("checked", F.lit(h)), F.array().cast("array<string>"))
            given, text = F.size(marked) > 0, F.array_join(marked, ", ")
            lines = [F.concat(F.when(F.array_contains(marked, o), "- [X] ").otherwise("- [ ] "), F.lit(o)) for o in lists.get(f.get("optionsKey"), ())]
            shown_text = F.concat_ws("\n", *lines)
        else:
            text = shown_text = _value(h)
            given = present(text)
        if flow.get("isUpdate") and f.get("currentKey"):
            given &= text != F.coalesce(F.try_element_at("current", F.lit(h)), F.lit(""))
        parts.append(F.when(given, F.concat(F.lit(f"### {h}\n\n"), shown_text)))
    return df.withColumn("body", F.concat_ws("\n\n", *parts))
