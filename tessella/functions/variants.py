"""Values of any kind: what a VARIANT holds, and how loosely typed records show it."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from .semantics import number_text


def at(v: Column, path: str, kind: str = "variant") -> Column:
    """What stands at a path, null where it is absent or of another kind."""
    return F.try_variant_get(v, path, kind)


def kind(v: Column) -> Column:
    """string, number, boolean, list, object or null, as the value is; null where there is none."""
    name = F.schema_of_variant(v)
    return (
        F.when(F.startswith(name, F.lit("ARRAY")), "list")
        .when(F.startswith(name, F.lit("OBJECT")), "object")
        .when(name == "STRING", "string")
        .when(name == "BOOLEAN", "boolean")
        .when(name == "VOID", "null")
        .when(name.isNotNull(), "number")
    )


def shown(v: Column) -> Column:
    """A value as text: numbers without a trailing .0, lists with commas, objects by a fixed text; null has none."""
    own = kind(v)
    items = F.try_variant_get(v, "$", "array<string>")
    return (
        F.when(own == "number", number_text(F.try_variant_get(v, "$", "double")))
        .when(own == "list", F.array_join(items, ",", ""))
        .when(own == "object", "[object Object]")  # fixed value
        .when(own != "null", F.try_variant_get(v, "$", "string"))
    )


def members(v: Column) -> Column:
    """An object's values by name; null for anything else."""
    return F.try_variant_get(v, "$", "map<string,variant>")
