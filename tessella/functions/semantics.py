"""Presence, numbers and strings as loosely typed records treat them."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

SPACE = r"(?U)[\s﻿]"


def present(c: Column, kind: str = "string") -> Column:
    """Neither null nor the kind's empty value: "", 0, NaN or false. Arrays, maps and structs are present when not null."""
    if kind == "string":
        return c.isNotNull() & (c != "")
    if kind == "number":
        return c.isNotNull() & (c != 0) & ~F.isnan(c.cast("double"))
    if kind == "boolean":
        return F.coalesce(c, F.lit(False))
    return c.isNotNull()


def trim_all(c: Column) -> Column:
    """Without leading and trailing white space of any kind (Spark's trim takes blanks only)."""
    return F.regexp_replace(c, rf"^{SPACE}+|{SPACE}+$", "")


def number_text(c: Column) -> Column:
    """A number as text without a trailing .0."""
    d = c.cast("double")
    whole = (d == F.floor(d)) & (F.abs(d) < 1e15)
    return F.when(whole, d.cast("bigint").cast("string")).otherwise(d.cast("string"))


def round_half_up(c: Column) -> Column:
    return F.floor(c + F.lit(0.5))


def to_number(text: Column) -> Column:
    """Text as a number: blank is 0, anything else that isn't a number is null."""
    t = trim_all(text)
    return F.when(t == "", F.lit(0.0)).otherwise(t.try_cast("double"))


def leading_number(text: Column) -> Column:
    """The number a text begins with, or null."""
    return F.nullif(F.regexp_extract(text, r"^\s*([+-]?(?:\d+\.?\d*|\.\d+)(?:[eE][+-]?\d+)?)", 1), F.lit("")).try_cast("double")


def url_component(c: Column) -> Column:
    """Percent-encoded text: all but letters, digits and -_.!~*'()."""
    out = F.url_encode(c)
    # What the encoder writes, and what the component has.
    for old, new in (("+", "%20"), ("%21", "!"), ("%27", "'"), ("%28", "("), ("%29", ")"), ("%7E", "~")):
        out = F.replace(out, F.lit(old), F.lit(new))
    return out


def relative_path(path: Column, root: str) -> Column:
    """A file's path below ``root``."""
    bare = F.regexp_replace(path, r"^[a-z]+:(?://)?(?=/)", "")
    return F.when(F.startswith(bare, F.lit(root.rstrip("/") + "/")), F.substring(bare, len(root.rstrip("/")) + 2, 1 << 30)).otherwise(bare)


def file_stem(path: Column) -> Column:
    """A file's name without its .yml or .yaml."""
    return F.regexp_replace(F.regexp_extract(path, r"([^/]*)$", 1), r"\.ya?ml$", "")


def parent_folder(path: Column) -> Column:
    return F.regexp_extract(path, r"([^/]*)/[^/]*$", 1)


def preview(c: Column, most: int = 200) -> Column:
    """The first ``most`` characters, with an ellipsis if there are more."""
    return F.when(F.char_length(c) > most, F.concat(F.left(c, F.lit(most)), F.lit("…"))).otherwise(c)


def version_text(ts: Column) -> Column:
    """Year and month of a build, as 2025.03."""
    return F.date_format(ts, "yyyy.MM")
