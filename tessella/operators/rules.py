"""Declarative integrity rules that compile to few plans, and the findings they give."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..functions.semantics import present

FINDING = "check string, severity string, file string, message string"
ERROR, WARNING = "error", "warning"


@dataclass(frozen=True)
class RowRule:
    """A row breaks the rule where ``broken`` is true."""

    check: str
    broken: Column
    message: Column
    severity: str = ERROR


def required(check: str, fields: dict[str, str], message) -> list[RowRule]:
    """A rule for each field (name: kind) that has to be present; ``message`` makes its text from the name."""
    return [RowRule(check, ~present(F.col(f), kind), message(f)) for f, kind in fields.items()]


def in_list(check: str, column: str, allowed: Sequence[str], message: Column, severity: str = ERROR) -> RowRule:
    """A present value has to be one of a short list; the list is part of the plan, no join."""
    c = F.col(column)
    return RowRule(check, present(c) & ~c.isin(list(allowed)), message, severity)


def positive(check: str, column: str, message: Column) -> RowRule:
    return RowRule(check, F.col(column).isNotNull() & (F.col(column) <= 0), message)


def row_findings(df: DataFrame, rules: Sequence[RowRule], file: Column) -> DataFrame:
    """All broken rules of all rows in one pass: an array of the rules' results, filtered and unfolded."""
    if not rules:
        return df.sparkSession.createDataFrame([], FINDING)
    each = [
        F.struct(F.lit(r.check).alias("check"), F.lit(r.severity).alias("severity"), F.coalesce(r.broken, F.lit(False)).alias("broken"), r.message.alias("message"))
        for r in rules
    ]
    unfolded = df.select(file.cast("string").alias("file"), F.explode(F.filter(F.array(*each), lambda x: x["broken"])).alias("r"))
    return unfolded.select("r.check", "r.severity", "file", "r.message")


def _finding(df: DataFrame, check: str, severity: str, file: Column, message: Column) -> DataFrame:
    return df.select(F.lit(check).alias("check"), F.lit(severity).alias("severity"), file.cast("string").alias("file"), message.alias("message"))


def uncovered(df: DataFrame, key: str, *covered: DataFrame) -> DataFrame:
    """Rows whose key none of the tables (``value``) has."""
    for c in covered:
        df = df.join(c.select(F.col("value").alias(key)), key, "left_anti")
    return df


def vocabulary_findings(df: DataFrame, column: str, vocab: DataFrame, check: str, file: Column, message: Column, severity: str = ERROR) -> DataFrame:
    """Present values that ``vocab.value`` doesn't have; a missing value is no finding."""
    bad = df.where(present(F.col(column))).join(vocab.select(F.col("value").alias(column)), column, "left_anti")
    return _finding(bad, check, severity, file, message)


def foreign_key_findings(df: DataFrame, keys: dict[str, str], target: DataFrame, check: str, file: Column, message: Column, severity: str = ERROR) -> DataFrame:
    """Rows whose present keys (column: target column) have no row in ``target``."""
    here = df
    for c in keys:
        here = here.where(F.col(c).isNotNull())
    there = target.select(*[F.col(t).alias(c) for c, t in keys.items()])
    return _finding(here.join(there, list(keys), "left_anti"), check, severity, file, message)


def uniqueness_findings(df: DataFrame, keys: Sequence[str], order: Sequence, check: str, file: Column, message: Column, severity: str = ERROR) -> DataFrame:
    """The second and every later row of a key, in ``order``; keys are compared null-safely.

    Keys that occur once leave in a partial aggregate; only the others are ranked.
    """
    many = df.groupBy(*keys).agg(F.count("*").alias("_n")).where("_n > 1")
    many = many.select(*[F.col(k).alias(f"_k{i}") for i, k in enumerate(keys)])
    on = [F.col(k).eqNullSafe(F.col(f"_k{i}")) for i, k in enumerate(keys)]
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return _finding(df.join(many, on, "left_semi").withColumn("_r", rank).where("_r > 1"), check, severity, file, message)


def cardinality_findings(df: DataFrame, keys: Sequence[str], counted: Column, check: str, file: Column, none: Column, many: Column, severity: str = ERROR) -> DataFrame:
    """Groups in which not exactly one row is ``counted``; ``many`` may use ``n``."""
    n = df.groupBy(*keys).agg(F.count_if(counted).alias("n")).where("n <> 1")
    return _finding(n, check, severity, file, F.when(F.col("n") == 0, none).otherwise(many))


def range_findings(df: DataFrame, lookup: DataFrame, on: dict[str, str], outside: Column, check: str, file: Column, message: Column, severity: str = ERROR) -> DataFrame:
    """Rows whose looked-up row (column: lookup column) makes ``outside`` true; rows without one pass."""
    cond = [df[a] == lookup[b] for a, b in on.items()]
    return _finding(df.join(lookup, cond).where(outside), check, severity, file, message)


def gather(*findings: DataFrame) -> DataFrame:
    out = findings[0]
    for f in findings[1:]:
        out = out.unionByName(f)
    return out


def summary(findings: DataFrame, checks: Sequence[str]) -> DataFrame:
    """``pos, check, errors, warnings`` for each check, those without findings included."""
    spark = findings.sparkSession
    every = spark.createDataFrame(list(enumerate(checks)), "pos int, check string")
    n = findings.groupBy("check").agg(F.count_if(F.col("severity") == ERROR).alias("errors"), F.count_if(F.col("severity") == WARNING).alias("warnings"))
    zero = F.lit(0).cast("bigint")
    return every.join(n, "check", "left").select("pos", "check", F.coalesce("errors", zero).alias("errors"), F.coalesce("warnings", zero).alias("warnings")).orderBy("pos")


def totals(findings: DataFrame) -> DataFrame:
    return findings.agg(F.count_if(F.col("severity") == ERROR).alias("errors"), F.count_if(F.col("severity") == WARNING).alias("warnings"))


def report_lines(findings: DataFrame, checks: Sequence[str]) -> DataFrame:
    """``pos, line``: the report's lines in order; those of one ``pos`` in the order of their text.

    A check with errors shows them alone, without its warnings; one without findings has passed.
    ``pos`` counts checks by two, a heading before its findings, and the sums come last.
    """
    counts = summary(findings, checks)
    kind = F.when(F.col("errors") > 0, ERROR).when(F.col("warnings") > 0, WARNING)
    n = F.when(F.col("errors") > 0, F.col("errors")).otherwise(F.col("warnings"))

    def counted(n: Column, what: Column | str) -> Column:
        return F.concat(n.cast("string"), F.lit(" "), F.lit(what) if isinstance(what, str) else what, F.when(n != 1, "s").otherwise(""))

    passed = F.concat(F.lit("✓ "), "check", F.lit(" check passed"))
    heading = F.concat(F.when(F.col("errors") > 0, "✗ ").otherwise("⚠ "), "check", F.lit(": "), counted(n, kind))
    heads = counts.select((F.col("pos") * 2).alias("pos"), F.when(n == 0, passed).otherwise(heading).alias("line"))
    shown = findings.join(F.broadcast(counts.select("check", "pos", kind.alias("severity"))), ["check", "severity"])  # a row a check
    body = shown.select((F.col("pos") * 2 + 1).alias("pos"), F.concat(F.lit("  "), "file", F.lit(": "), "message").alias("line"))
    errors, warnings = (F.coalesce(F.sum(c), F.lit(0)) for c in ("errors", "warnings"))
    last = counts.agg(F.lit(2 * len(checks)).alias("pos"), F.concat(F.lit("\nSummary: "), counted(errors, "error"), F.lit(", "), counted(warnings, "warning")).alias("line"))
    return heads.unionByName(body).unionByName(last)


def report(findings: DataFrame, checks: Sequence[str], write=print) -> int:
    """Writes the report line by line, a partition at a time, and returns the exit code: 1 if there is an error."""
    for r in report_lines(findings, checks).orderBy("pos", "line").toLocalIterator():
        write(r.line)
    return int(not findings.where(F.col("severity") == ERROR).isEmpty())
