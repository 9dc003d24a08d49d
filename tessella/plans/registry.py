"""The queries by name, each with its SQL."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
SQL: dict[str, str] = {}


def query(sql: str | None = None):
    def add(f: Query) -> Query:
        QUERIES[f.__name__] = f
        if sql is not None:
            SQL[f.__name__] = sql
        return f

    return add


def table(spark: SparkSession, d: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{d}/{name}.parquet")


def dealt(df: DataFrame) -> DataFrame:
    """``df`` dealt evenly to as many tasks as a shuffle has: a small file is read by few tasks, however
    much work each of its rows is."""
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")))
