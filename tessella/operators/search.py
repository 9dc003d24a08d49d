"""Search in names by a part of them, over a table of their three-letter runs."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

GRAM = 3


def grams(low: Column) -> Column:
    """The distinct runs of three characters; none for shorter texts."""
    starts = F.sequence(F.lit(1), F.char_length(low) - GRAM + 1)
    return F.when(F.char_length(low) >= GRAM, F.array_distinct(F.transform(starts, lambda i: F.substring(low, i, GRAM))))


def build_index(names: DataFrame, column: str, key: str, path: str) -> None:
    """Keep two tables below ``path``: ``postings`` (``gram, key``), in ranges of grams, so that a query reads
    the parts that hold its own grams; and ``names`` (``key, name, low``), in ranges of keys.

    A gram that most names have is a long run of rows over several files, not a list in one row.
    """
    spark = names.sparkSession
    parts = int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = names.select(F.col(key).alias("key"), F.col(column).alias("name"), F.lower(F.col(column)).alias("low")).where("name IS NOT NULL")
    rows.repartitionByRange(parts, "key").sortWithinPartitions("key").write.mode("overwrite").parquet(f"{path}/names")
    posted = spark.read.parquet(f"{path}/names").select(F.explode(grams(F.col("low"))).alias("gram"), "key").distinct()
    posted.repartitionByRange(parts, "gram", "key").sortWithinPartitions("gram", "key").write.mode("overwrite").parquet(f"{path}/postings")


def query_grams(text: str) -> list[str]:
    low = text.lower()
    return sorted({low[i : i + GRAM] for i in range(len(low) - GRAM + 1)})


def search(spark: SparkSession, path: str, text: str, most: int = 50) -> DataFrame:
    """``key, name``: the first ``most`` names by key that hold the text, upper or lower case.

    A name that holds it has all its grams, so only keys that are posted under each of these
    are looked at, and tested in full. A text of under three characters has no gram: then all
    names are read. An empty text is in every name.
    """
    names, wanted = spark.read.parquet(f"{path}/names"), query_grams(text)
    if wanted:
        posted = spark.read.parquet(f"{path}/postings").where(F.col("gram").isin(wanted))
        keys = posted.groupBy("key").agg(F.count("*").alias("n")).where(F.col("n") == len(wanted)).select("key")
        names = names.join(keys, "key", "left_semi")
    return names.where(F.contains("low", F.lit(text.lower()))).orderBy("key").limit(most).select("key", "name")
