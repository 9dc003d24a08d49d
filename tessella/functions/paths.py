"""Dotted paths into nested records, checked against their schema and compiled to columns."""

from __future__ import annotations

import re
from collections.abc import Callable, Mapping

from pyspark.sql import Column
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .semantics import number_text

_NAME = re.compile(r"[A-Za-z_]\w*")


def steps(path: str) -> list[str]:
    """The names of a path ``a.b.c``."""
    names = path.split(".")
    if not all(_NAME.fullmatch(n) for n in names):
        raise ValueError(f"{path!r} is no path of names with dots")
    return names


def _kind(t: T.DataType) -> str:
    if isinstance(t, T.StructType):
        return {("text", "kind"): "scalar", ("is_list", "items"): "listed"}.get(tuple(t.names), "struct")
    return "list" if isinstance(t, T.ArrayType) else "value"


def _shown(c: Column, t: T.DataType, path: str) -> Column:
    """One value as text."""
    if _kind(t) == "scalar":  # a value of any kind is kept with its text
        return c["text"]
    if isinstance(t, T.DoubleType | T.FloatType | T.DecimalType):
        return number_text(c)
    if isinstance(t, T.StructType | T.MapType):
        raise ValueError(f"{path!r} ends in a record: name one of its fields")
    return c.cast("string")


def _follow(c: Column, t: T.DataType, names: list[str], path: str) -> tuple[Column, T.DataType, bool]:
    """The column that names lead to from c, of type t, its type, and whether it is a list of such."""
    for i, name in enumerate(names):
        if _kind(t) == "list":
            inner, rest, found = t.elementType, names[i:], []

            def element(x: Column) -> Column:
                below, *about = _follow(x, inner, rest, path)
                found[:] = about
                return below

            lists = F.transform(c, element)
            kind, many = found
            return (F.flatten(F.filter(lists, lambda x: x.isNotNull())) if many else lists), kind, True
        if _kind(t) != "struct" or name not in t.names:
            raise ValueError(f"{path!r}: there is no {name!r}" + (f" (but {', '.join(t.names)})" if _kind(t) == "struct" else ""))
        c, t = c[name], t[name].dataType
    if _kind(t) == "listed":
        return c["items"], t["items"].dataType.elementType, True
    return (c, t.elementType, True) if _kind(t) == "list" else (c, t, False)


def value_at(schema: T.StructType, path: str, *, sep: str = ", ", item: str | None = None, roots: Mapping[str, tuple[Column, T.DataType]] | None = None) -> Column:
    """What a record has at ``path``, as text: null where a step is null, lists joined by ``sep``.

    A path may lead through lists of records, whose values are joined. ``item`` is a form for records in a
    list, as ``{source}: {id}``. ``roots`` names columns that stand for a first step, as one chosen
    element of a list does for ``species``. A name that the schema doesn't have is an error.
    """
    names = steps(path)
    if roots and names[0] in roots:
        c, t, many = _follow(*roots[names[0]], names[1:], path)
    else:
        if names[0] not in schema.names:
            raise ValueError(f"{path!r}: there is no {names[0]!r} (but {', '.join(schema.names)})")
        c, t, many = _follow(F.col(f"`{names[0]}`"), schema[names[0]].dataType, names[1:], path)
    if item is not None:
        if not many or _kind(t) != "struct":
            raise ValueError(f"{path!r} is no list of records for {item!r}")
        parts = re.split(r"\{([^{}]*)\}", item)

        def formed(x: Column) -> Column:
            fields = [F.coalesce(_shown(*_follow(x, t, steps(p), path)[:2], path), F.lit("")) if k % 2 else F.lit(p) for k, p in enumerate(parts)]
            return F.concat(*fields)

        return F.array_join(F.transform(c, formed), sep)
    return F.array_join(F.transform(c, lambda x: _shown(x, t, path)), sep, "") if many else _shown(c, t, path)


def chosen(records: str, name: str, schema: T.StructType, wanted: Column) -> tuple[Column, T.DataType]:
    """For ``roots``: the first record of a list whose ``name`` is the wanted one."""
    inner = schema[records].dataType.elementType
    return F.get(F.filter(F.col(records), lambda x: x[name] == wanted), F.lit(0)), inner


Reader = Callable[[T.StructType, Mapping | None], Column]


def path_set(paths: Mapping[str, str | tuple[str, str] | tuple[str, str, str]]) -> dict[str, Reader]:
    """Readers by header of ``path``, ``(path, sep)`` or ``(path, sep, item)``; a set with fewer is a ``dict`` without these."""

    def reader(p) -> Reader:
        path, sep, item = (p, ", ", None) if isinstance(p, str) else (*p, None)[:3]
        steps(path)
        return lambda schema, roots=None: value_at(schema, path, sep=sep, item=item, roots=roots)

    return {h: reader(p) for h, p in paths.items()}
