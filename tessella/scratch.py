"""Intermediate tables in the folder that the cluster shares."""

from __future__ import annotations

import atexit
import re
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_LOCAL: list[str] = []


def shared_folder(spark: SparkSession) -> str:
    """The session's ``spark.checkpoint.dir``; a temporary folder only where it is unset and all runs in one process."""
    found = spark.conf.get("spark.checkpoint.dir", None)
    if found:
        return found.rstrip("/")
    if not re.match(r"local(\[|$)", spark.sparkContext.master):
        raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
    if not _LOCAL:
        _LOCAL.append(f"file://{tempfile.mkdtemp(prefix='tessella-core-')}")
    return _LOCAL[0]


def _delete(spark: SparkSession, path: str) -> None:
    try:
        p = spark.sparkContext._jvm.org.apache.hadoop.fs.Path(path)
        p.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).delete(p, True)
    except Exception:  # the session has ended; the folder is the cluster's to clear
        return


def fresh_path(spark: SparkSession, label: str) -> str:
    """A path that nothing uses yet, deleted when the driver ends."""
    path = f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"
    atexit.register(_delete, spark, path)
    return path


def written(df: DataFrame, label: str) -> DataFrame:
    """``df`` as a table of its own: what reads it doesn't compute it again, nor does a lost executor."""
    path = fresh_path(df.sparkSession, label)
    df.write.parquet(path)
    out = df.sparkSession.read.schema(df.schema).parquet(path)
    out.written_at = path
    return out


def drop(*tables: DataFrame | None) -> None:
    """Delete written tables that nothing reads any more."""
    for df in tables:
        if df is not None and getattr(df, "written_at", None):
            _delete(df.sparkSession, df.written_at)
