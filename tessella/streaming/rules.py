"""Row rules on an unbounded table: the same fused projection, as records arrive."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame

from ..operators.rules import RowRule, row_findings


def watch(stream: DataFrame, rules: Sequence[RowRule], file: Column, name: str, checkpoint: str, sink: str = "memory"):
    """Start a query that gives a stream's findings; stateless, so it needs no watermark."""
    found = row_findings(stream, rules, file)
    return found.writeStream.format(sink).queryName(name).outputMode("append").option("checkpointLocation", checkpoint).start()
