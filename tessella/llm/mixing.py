"""Mixing sources to target weights by Pareto order sampling, in DataFrame functions only."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import discard, refuse_names, staged

WEIGHTS = (5, 2, 1)
SHARE = 1.5
MOST = 2.0
BUCKETS = 4096


def n_words(text: Column) -> Column:
    """Number of ``[^\\x20\\x09-\\x0D]+`` in a text; null has none."""
    return F.coalesce(F.regexp_count(text, F.lit(r"[^\x20\x09-\x0D]+")), F.lit(0)).cast("long")


def source_targets(sizes: DataFrame, weights: tuple = WEIGHTS, share: float = SHARE, most: float = MOST) -> DataFrame:
    """``source, source_size, target`` from ``source, size``.

    Sources in code point order, null last, weigh ``weights`` in turn. ``share`` times the whole
    size is shared out by weight; a target stops at ``most`` times its source's size and what is
    over goes to the others, by weight, until none is above. Sorted by cap per weight, the capped
    sources are a prefix, so one pass of running sums finds the common level of the rest.
    """
    per = sizes.groupBy("source").agg(F.sum("size").alias("source_size"))
    order = Window.partitionBy(F.lit(0)).orderBy(F.col("source").asc_nulls_last())
    cycle = F.array(*[F.lit(float(w)) for w in weights])
    per = per.withColumn("_w", F.element_at(cycle, ((F.row_number().over(order) - 1) % len(weights) + 1).cast("int")))
    per = per.withColumn("_cap", most * F.col("source_size"))
    one = Window.partitionBy(F.lit(0))
    before = one.orderBy(F.col("_cap") / F.col("_w"), F.col("source").asc_nulls_last()).rowsBetween(Window.unboundedPreceding, -1)
    level = (share * F.sum("source_size").over(one) - F.coalesce(F.sum("_cap").over(before), F.lit(0.0))) / (
        F.sum("_w").over(one) - F.coalesce(F.sum("_w").over(before), F.lit(0.0))
    )  # the weights left are never 0: each row's own is among them
    per = per.withColumn("_level", level)
    free = F.min(F.when(F.col("_cap") > F.col("_w") * F.col("_level"), F.struct(F.col("_cap") / F.col("_w"), "source", "_level"))).over(one)
    return per.withColumn("_at", free["_level"]).select(
        "source", "source_size", F.coalesce(F.least("_cap", F.col("_w") * F.col("_at")), F.col("_cap")).alias("target")
    )


def mix_sources(
    docs: DataFrame,
    *,
    id_col: str = "doc_id",
    text_col: str = "text",
    source_col: str = "source",
    seed: str = "mix",
    weights: tuple = WEIGHTS,
    share: float = SHARE,
    most: float = MOST,
    buckets: int = BUCKETS,
) -> DataFrame:
    """``docs`` with ``mix_size, mix_source_size, mix_target, mix_copies``.

    Each document of a source is due target / size copies: the whole copies are certain, and the
    fraction p is the chance of one more. The chance is settled by Pareto order sampling: with U
    from a hash of the id, documents are ranked by (U / (1 - U)) / (p / (1 - p)) and taken in that
    order until their words come nearest the source's remaining target, so the size in words is
    fixed and reruns agree.

    The running sum never sorts a source in one task: words are summed per (source, bucket of the
    rank) first, and only the bucket that holds the cut is ordered, 1 / ``buckets`` of a source.

    Null ids rank like the text "null"; null texts have size 0; a null source is a source of its
    own. Rows equal in id and text rank alike; where the cut falls among them, as many as fit are
    taken, whichever these are. Empty tables give
    empty results; other columns pass through, and the added columns carry the prefix ``mix_``: one of
    an added name raises ``ValueError``.
    """
    refuse_names(docs.columns, "mix_size", "mix_source_size", "mix_target", "mix_copies")
    spark_src = F.col(f"`{source_col}`")
    keyed = docs.select(
        spark_src.alias("source"),
        n_words(F.col(f"`{text_col}`")).alias("size"),
        _uniform(id_col, seed).alias("u"),
        _tie(id_col, text_col).alias("tie"),
    )
    small = staged(keyed, "mix-sizes")
    targets = staged(source_targets(small, weights, share, most), "mix-targets")
    due = targets.withColumn("rate", F.when(F.col("source_size") > 0, F.col("target") / F.col("source_size")).otherwise(F.lit(1.0)))
    due = due.withColumn("base", F.floor("rate")).withColumn("p", F.col("rate") - F.col("base"))
    due = due.withColumn("need", F.col("target") - F.col("base") * F.col("source_size"))

    ranked = (
        small.alias("d")
        .join(due.where("p > 0").alias("t"), F.col("d.source").eqNullSafe(F.col("t.source")))
        .select("t.source", "size", "u", "tie", "p", "need")
        .withColumn("q", _rank(F.col("u"), F.col("p")))
        .withColumn("bucket", F.floor(F.col("q") / (1 + F.col("q")) * buckets))
    )
    sums = ranked.groupBy("source", "bucket", "need").agg(F.sum("size").alias("words"))
    up_to = Window.partitionBy("source").orderBy("bucket").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    cut_bucket = (
        sums.withColumn("upto", F.sum("words").over(up_to))
        .where(F.col("upto") >= F.col("need"))
        .groupBy(F.col("source").alias("c_source"))
        .agg(F.min(F.struct("bucket", (F.col("upto") - F.col("words")).alias("below"))).alias("c"))
        .select("c_source", F.col("c.bucket").alias("c_bucket"), F.col("c.below").alias("below"))
    )
    edge = ranked.join(cut_bucket, F.col("source").eqNullSafe(F.col("c_source")) & (F.col("bucket") == F.col("c_bucket")))
    equal = edge.groupBy("source", "need", "below", "q", "tie", "size").agg(F.count("*").alias("rows"))
    earlier = Window.partitionBy("source").orderBy("q", "tie").rowsBetween(Window.unboundedPreceding, -1)
    equal = equal.withColumn("start", F.col("below") + F.coalesce(F.sum(F.col("rows") * F.col("size")).over(earlier), F.lit(0)))

    def fits(k: Column) -> Column:
        return (F.col("start") + k * F.col("size") - F.col("size") / 2 <= F.col("need")) & (k <= F.col("rows"))

    guess = F.least(F.greatest(F.floor((F.col("need") - F.col("start")) / F.col("size") + 0.5), F.lit(0)), F.col("rows"))
    k = F.when(F.col("size") == 0, F.when(F.col("start") <= F.col("need"), F.col("rows")).otherwise(0)).otherwise(
        F.when(fits(guess + 1), guess + 1).when((guess == 0) | fits(guess), guess).otherwise(guess - 1)
    )
    last = (
        equal.withColumn("k", k)
        .where("k > 0")
        .groupBy("source")
        .agg(F.max(F.struct("q", "tie", "k", "rows")).alias("last"))
        .select(F.col("source").alias("l_source"), F.col("last.q").alias("last_q"), F.col("last.tie").alias("last_tie"), F.col("last.k").alias("last_k"), F.col("last.rows").alias("last_rows"))
    )
    plan = (
        due.join(cut_bucket, F.col("source").eqNullSafe(F.col("c_source")), "left")
        .join(last, F.col("source").eqNullSafe(F.col("l_source")), "left")
        .select(
            F.col("source").alias("_m_source"),
            F.col("source_size").alias("mix_source_size"),
            F.col("target").alias("mix_target"),
            F.col("base").alias("_m_base"),
            F.col("p").alias("_m_p"),
            F.col("c_bucket").alias("_m_bucket"),
            F.col("last_q").alias("_m_q"),
            F.col("last_tie").alias("_m_tie"),
            F.col("last_k").alias("_m_k"),
            F.col("last_rows").alias("_m_rows"),
        )
    )
    plan = staged(plan, "mix-plan")
    discard(small, targets)
    q = _rank(_uniform(id_col, seed), F.col("_m_p"))
    bucket = F.floor(q / (1 + q) * buckets)
    tie = _tie(id_col, text_col)
    within = F.col("_m_q").isNotNull() & ((q < F.col("_m_q")) | ((q == F.col("_m_q")) & (tie <= F.col("_m_tie"))))
    extra = F.when(
        (F.col("_m_p") > 0) & (F.col("_m_bucket").isNull() | (bucket < F.col("_m_bucket")) | ((bucket == F.col("_m_bucket")) & within)), 1
    ).otherwise(0)
    due_docs = docs.join(plan, spark_src.eqNullSafe(F.col("_m_source")))

    def out(df: DataFrame, more: Column) -> DataFrame:
        return df.select(
            *[F.col(f"`{c}`") for c in docs.columns],
            n_words(F.col(f"`{text_col}`")).alias("mix_size"),
            "mix_source_size",
            "mix_target",
            (F.col("_m_base") + more).cast("int").alias("mix_copies"),
        )

    if plan.where("_m_k < _m_rows").isEmpty():
        return out(due_docs, extra)
    at_cut = F.coalesce((F.col("_m_k") < F.col("_m_rows")) & (F.col("_m_p") > 0) & (q == F.col("_m_q")) & (tie == F.col("_m_tie")), F.lit(False))
    return out(due_docs.where(~at_cut), extra).unionByName(out(_numbered(due_docs.where(at_cut)), F.when(F.col("_m_no") <= F.col("_m_k"), 1).otherwise(0)))


def _numbered(rows: DataFrame) -> DataFrame:
    """Equal rows of a source with their number ``_m_no``: counted by partition first, so that many of
    them are numbered in many tasks."""
    kept = staged(rows.withColumn("_m_part", F.spark_partition_id()), "mix-equal")
    per = kept.groupBy("_m_source", "_m_part").agg(F.count("*").alias("n"))
    earlier = Window.partitionBy("_m_source").orderBy("_m_part").rowsBetween(Window.unboundedPreceding, -1)
    per = per.select(F.col("_m_source").alias("_p_source"), F.col("_m_part").alias("_p_part"), F.coalesce(F.sum("n").over(earlier), F.lit(0)).alias("_m_before"))
    own = F.row_number().over(Window.partitionBy("_m_source", "_m_part").orderBy(F.lit(0)))
    numbered = kept.withColumn("_m_own", own).join(per, F.col("_m_source").eqNullSafe(F.col("_p_source")) & (F.col("_m_part") == F.col("_p_part")))
    return numbered.withColumn("_m_no", F.col("_m_own") + F.col("_m_before"))


def _uniform(id_col: str, seed: str) -> Column:
    named = F.concat(F.coalesce(F.col(f"`{id_col}`").cast("string"), F.lit("null")), F.lit(f":{seed}"))
    return (F.conv(F.substring(F.md5(named.cast("binary")), 1, 13), 16, 10).cast("double") + 0.5) / float(2**52)


def _tie(id_col: str, text_col: str) -> Column:
    return F.concat_ws("|", F.col(f"`{id_col}`").cast("string"), F.md5(F.coalesce(F.col(f"`{text_col}`"), F.lit("")).cast("binary")))


def _rank(u: Column, p: Column) -> Column:
    return F.try_divide(u / (1 - u), p / (1 - p))


def repeat_copies(mixed: DataFrame, columns: list[str]) -> DataFrame:
    """Each row as often as its ``mix_copies`` says, with ``columns`` only."""
    return mixed.where("mix_copies > 0").withColumn("_copy", F.explode(F.sequence(F.lit(1), F.col("mix_copies")))).select(*columns)


def op7_mixing(spark, sf_dir: str) -> DataFrame:
    mixed = mix_sources(spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text", "source"))
    return mixed.select(
        "doc_id",
        F.col("mix_size").alias("size"),
        F.col("mix_source_size").alias("source_size"),
        F.col("mix_target").alias("target"),
        (F.col("mix_copies") * F.col("mix_size")).alias("taken"),
    )


OP7_SQL = r"""
WITH d AS (
  SELECT doc_id, source, coalesce(len(regexp_extract_all(text, '[^\x20\x09-\x0D]+')), 0)::BIGINT AS size,
    (('0x' || substr(md5(coalesce(doc_id::VARCHAR, 'null') || ':mix'), 1, 13))::BIGINT + 0.5::DOUBLE) / 4503599627370496::DOUBLE AS u,
    concat_ws('|', doc_id::VARCHAR, md5(coalesce(text, ''))) AS tie
  FROM documents),
s AS (SELECT source, sum(size)::BIGINT AS source_size FROM d GROUP BY source),
w AS (SELECT *, CASE (row_number() OVER (ORDER BY source NULLS LAST) - 1) % 3 WHEN 0 THEN 5 WHEN 1 THEN 2 ELSE 1 END::DOUBLE AS w,
  2::DOUBLE * source_size AS cap FROM s),
l AS (SELECT *, (1.5::DOUBLE * sum(source_size) OVER () - coalesce(sum(cap) OVER b, 0)) / (sum(w) OVER () - coalesce(sum(w) OVER b, 0)) AS level
  FROM w WINDOW b AS (ORDER BY cap / w, source NULLS LAST ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
t AS (SELECT source, source_size, CASE WHEN lv IS NULL THEN cap ELSE least(cap, w * lv) END AS target
  FROM l, (SELECT arg_min(level, cap / w) AS lv FROM l WHERE cap > w * level)),
r AS (SELECT *, CASE WHEN source_size > 0 THEN target / source_size ELSE 1 END AS rate FROM t),
e AS (SELECT d.*, source_size, target, floor(rate) AS base, rate - floor(rate) AS p, target - floor(rate) * source_size AS need
  FROM d JOIN r ON d.source IS NOT DISTINCT FROM r.source),
q AS (SELECT *, CASE WHEN p > 0 THEN (u / (1 - u)) / (p / (1 - p)) END AS q FROM e),
c AS (SELECT *, sum(size) OVER (PARTITION BY source ORDER BY q, tie ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW) AS upto FROM q)
SELECT doc_id, size, source_size, target,
  (size * (base + CASE WHEN p > 0 AND upto - size / 2::DOUBLE <= need THEN 1 ELSE 0 END))::BIGINT AS taken FROM c
"""
