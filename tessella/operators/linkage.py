"""Matching text to vocabularies, merging candidates by priority, duplicates and differences."""

from __future__ import annotations

import uuid
from collections.abc import Iterator, Sequence

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.semantics import present
from ..scratch import written


def first_match(text: Column, terms: Sequence[tuple[str, str]]) -> Column:
    """The value of the first (term, value) whose term the text holds, upper or lower case; else null.

    For the short dictionaries of a schema: one expression in the scan's own stage, no join.
    """
    low = F.lower(text)
    pairs = F.array(*[F.struct(F.lit(t.lower()).alias("t"), F.lit(v).alias("v")) for t, v in terms])
    return F.get(F.filter(pairs, lambda p: F.contains(low, p["t"])), F.lit(0))["v"] if terms else F.lit(None).cast("string")


TERM_BYTES = 64 << 20  # of terms and values that one automaton holds

_automata: dict[str, tuple] = {}  # the last automaton of this worker, which serves all its tasks


def _automaton(name: str, entries: list[tuple]) -> tuple:
    """An automaton over ``term, pos, value``, what an empty term gives, and the least place of all."""
    if name not in _automata:
        import ahocorasick

        tree, empty = ahocorasick.Automaton(), None
        for term, pos, value in entries:
            if term:
                tree.add_word(term, (pos, value))
            else:
                empty = (pos, value)
        if len(tree):
            tree.make_automaton()
        _automata.clear()
        _automata[name] = tree, empty, min(e[1] for e in entries)
    return _automata[name]


def _found(tree, text: str, empty: tuple | None, least: int) -> tuple | None:
    best = empty
    if len(tree):
        for _, hit in tree.iter(text):
            if best is None or hit < best:
                best = hit
                if best[0] == least and (empty is None or best <= empty):
                    break
    return best


def _matched(name: str, shared):
    """Rows whose last three columns are the lowered text and the ``pos, value`` found so far."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            tree, empty, least = _automaton(name, shared.value)
            at = batch.num_columns - 3
            pos, value = [], []
            for text, p, v in zip(*(batch.column(at + k).to_pylist() for k in range(3)), strict=True):
                hit = None if text is None else _found(tree, text, empty, least)
                if hit is not None and (p is None or hit < (p, v)):
                    p, v = hit
                pos.append(p)
                value.append(v)
            yield pa.RecordBatch.from_arrays([*batch.columns[: at + 1], pa.array(pos, pa.int64()), pa.array(value, pa.string())], schema=batch.schema)

    return run


def first_match_join(df: DataFrame, text: str, terms: DataFrame, name: str, *, most_bytes: int = TERM_BYTES) -> DataFrame:
    """``df`` with ``name``: the value of the first term (of ``term, value, pos``, by ``pos``, then value)
    that the text holds, upper or lower case; null where it holds none, or is null.

    The terms become an automaton that reads each text once, whatever their number, in batches of
    the scan's own stage; no text is paired with a term. Terms of over ``most_bytes`` in all are
    dealt to several automata, so what is broadcast is bounded, and texts pass them in turn. An empty
    term is in every text; null terms are in none; of equal terms the first counts.
    """
    spark = df.sparkSession
    low = terms.where("term IS NOT NULL").groupBy(F.lower("term").alias("term")).agg(F.min(F.struct(F.col("pos").cast("long").alias("pos"), F.col("value").cast("string").alias("value"))).alias("m"))
    low = low.select("term", "m.pos", "m.value")
    size = low.agg(F.sum(F.octet_length("term") + F.coalesce(F.octet_length("value"), F.lit(0)) + 16)).first()[0]
    out = df.withColumns({"_low": F.lower(F.col(text)), "_pos": F.lit(None).cast("long"), name: F.lit(None).cast("string")})
    shards = -(-(size or 0) // most_bytes)
    for k in range(shards):
        entries = [tuple(r) for r in low.where(F.pmod(F.xxhash64("term"), F.lit(shards)) == k).collect()]
        if entries:
            shared = spark.sparkContext.broadcast(entries)
            out = out.mapInArrow(_matched(uuid.uuid4().hex, shared), out.schema)
            out = written(out, "matches") if k + 1 < shards else out  # one automaton at a time in a worker
    return out.drop("_low", "_pos")


def match_name(df: DataFrame, column: str, names: DataFrame, name: str = "matched") -> DataFrame:
    """The name (of ``names.value``, first by ``pos``) equal to the column but for case; else null."""
    by = names.groupBy(F.lower("value").alias("_low")).agg(F.min_by("value", "pos").alias(name))
    return df.join(by, F.lower(F.col(column)) == F.col("_low"), "left").drop("_low")


def exists_name(df: DataFrame, keys: dict[str, str], existing: DataFrame) -> DataFrame:
    """Rows whose keys (column: existing column) occur in ``existing``, but for case and outer blanks."""
    cond = [F.lower(F.trim(df[a])) == F.lower(existing[b]) for a, b in keys.items()]
    return df.join(existing, cond, "left_semi")


# Nouns for diets in a source's words.
DIET_NOUNS = {"carnivory": "carnivore", "herbivory": "herbivore", "omnivory": "omnivore", "insectivory": "insectivore", "piscivory": "piscivore"}


def match_diet(text: Column, diets: Sequence[str]) -> Column:
    nouns = F.create_map(*[F.lit(x) for kv in DIET_NOUNS.items() for x in kv])
    return F.coalesce(first_match(text, [(d, d) for d in diets]), F.try_element_at(nouns, F.lower(text)))


def match_country(text: Column, countries: dict[str, str], compat: bool = True) -> Column:
    """A country's code from text. Compatible mode takes the first name, by code, that the text
    holds ("Nigeria" gives NE); otherwise the longest."""
    order = sorted(countries.items(), key=None if compat else lambda kv: (-len(kv[1]), kv[0]))
    return first_match(text, [(name, code) for code, name in order])


def display_name(code: Column, countries: dict[str, str]) -> Column:
    names = F.create_map(*[F.lit(x) for kv in countries.items() for x in kv])
    return F.coalesce(F.try_element_at(names, code), code)


def code_of(name: Column, countries: dict[str, str]) -> Column:
    codes = F.create_map(*[F.lit(x) for k, v in countries.items() for x in (v, k)])
    return F.coalesce(F.try_element_at(codes, name), name)


def first_wins(df: DataFrame, keys: Sequence[str], order: Sequence) -> DataFrame:
    """One row a key, the first in ``order``: an aggregate with map-side combining, no window.

    ``order`` should be total within a key; then the result doesn't depend on the partitions.
    """
    rest = [c for c in df.columns if c not in keys]
    ordered = df.groupBy(*keys).agg(F.min(F.struct(*[F.col(o) if isinstance(o, str) else o for o in order], F.struct(*rest).alias("_rest"))).alias("_first"))
    return ordered.select(*keys, "_first._rest.*").select(*df.columns)


def last_wins(df: DataFrame, keys: Sequence[str], pos: str) -> DataFrame:
    """One row a key, that of the largest ``pos``: a later record replaces an earlier one."""
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(F.col(pos).desc()))
    return df.withColumn("_r", rank).where("_r = 1").drop("_r")


def priority_merge(candidates: Sequence[DataFrame], keys: Sequence[str], always: dict[str, Sequence[str]] | None = None) -> DataFrame:
    """Candidates ``keys.., value, ..`` of several sources: for each key the first source's that has one.

    ``always``: for a column, values of which the last source's candidate replaces the others'.
    """
    tagged = [c.where(present(F.col("value"))).withColumn("_p", F.lit(i)) for i, c in enumerate(candidates)]
    every = tagged[0]
    for t in tagged[1:]:
        every = every.unionByName(t, allowMissingColumns=True)
    order = F.col("_p")
    for column, values in (always or {}).items():
        order = F.when(F.col(column).isin(list(values)), -F.col("_p")).otherwise(order)
    return first_wins(every.withColumn("_o", order), keys, ["_o"]).drop("_p", "_o")


def changed(old: DataFrame, new: DataFrame, keys: Sequence[str], columns: Sequence[str]) -> DataFrame:
    """``keys.., header, old, new`` of values that differ as text; null differs from "" and from any value."""
    def long(df: DataFrame, name: str) -> DataFrame:
        pairs = F.explode(F.array(*[F.struct(F.lit(c).alias("header"), F.col(c).cast("string").alias(name)) for c in columns]))
        return df.select(*keys, pairs.alias("_x")).select(*keys, "_x.*")

    both = long(new, "new").join(long(old, "old"), [*keys, "header"], "left")
    return both.where(~F.col("new").eqNullSafe(F.col("old"))).select(*keys, "header", "old", "new")
