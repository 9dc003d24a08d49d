"""Exact top-k inner products as a Voronoi kNN join."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from .common import staged

K = 5
EVERY = 50
PIVOTS = 64, 1024  # cells, and rows of the summaries that the driver holds: the root of the rows, within these
GROUP_QUERIES = 4096  # queries, on average at most, that are solved together
BLOCK_ROWS = 16384  # data rows, on average, in a block
EXACT = 1 << 53  # below this, sums of products are exact as doubles


def _vectors():
    out = pa.schema([("vec_id", pa.int64()), ("v", pa.binary()), ("dim", pa.int32()), ("norm", pa.int64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            ids, vs = [], []
            for vec_id, x in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                if vec_id is None or not x.is_valid or x.values.null_count:
                    continue
                f = x.values.to_numpy(zero_copy_only=False).astype(np.float64)
                if np.isfinite(f).all():
                    f = np.floor(256 * f)
                    if f @ f >= 2.0**62:
                        raise OverflowError(f"vector {vec_id} is too long for scores that are whole numbers of 64 bits")
                    ids.append(vec_id)
                    vs.append(f.astype("<i8"))
            cols = [pa.array(ids, pa.int64()), pa.array([v.tobytes() for v in vs], pa.binary()), pa.array(map(len, vs), pa.int32())]
            yield pa.RecordBatch.from_arrays([*cols, pa.array([int(v @ v) for v in vs], pa.int64())], schema=out)

    return run


def _whole(col: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    if isinstance(col, pa.ChunkedArray):
        col = col.combine_chunks()
    return np.frombuffer(b"".join(col.to_pylist()), "<i8").reshape(len(col), dim)


def _matrix(col: pa.Array | pa.ChunkedArray, dim: int) -> np.ndarray:
    return _whole(col, dim).astype(np.float64)


def _lift(x: np.ndarray, top: float) -> np.ndarray:
    """Vectors on a sphere of squared radius ``top``, with one more component: there the nearest
    point to (q, 0) is the one of largest inner product with q."""
    return np.column_stack([x, np.sqrt(np.maximum(top - (x * x).sum(1), 0))])


def _cells(pivots: np.ndarray, dim: int, top: float, query: bool):
    out = pa.schema([("vec_id", pa.int64()), ("v", pa.binary()), ("cell", pa.int32()), ("dist", pa.float64())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            if not batch.num_rows:
                continue
            x = _matrix(batch.column(1), dim)
            x = np.column_stack([x, np.zeros(len(x))]) if query else _lift(x, top)
            d = np.sqrt(np.maximum((x * x).sum(1)[:, None] + (pivots * pivots).sum(1) - 2 * x @ pivots.T, 0))
            cell = d.argmin(1)
            yield pa.RecordBatch.from_arrays(
                [batch.column(0), batch.column(1), pa.array(cell.astype(np.int32)), pa.array(d[np.arange(len(x)), cell])], schema=out
            )

    return run


def _solve(k: int, dim: int, top: float):
    """The best k of a block for each query; products of doubles where they are exact, else of
    integers, which are slower."""
    matrix, none = (_matrix, -np.inf) if top < EXACT else (_whole, np.iinfo(np.int64).min)
    out = pa.schema([("query_id", pa.int64()), ("q", pa.int64()), ("vec_id", pa.int64()), ("score", pa.int64())])

    def run(queries: pa.Table, data: pa.Table) -> pa.Table:
        if not queries.num_rows or not data.num_rows:
            return out.empty_table()
        ids = data.column("vec_id").to_numpy()
        order = np.argsort(ids, kind="stable")
        ids, x = ids[order], matrix(data.column("v"), dim)[order]
        q_ids, q_keys, q = queries.column("query_id").to_numpy(), queries.column("q").to_numpy(), matrix(queries.column("qv"), dim)
        found = []
        for lo in range(0, len(q), 256):
            scores = q[lo : lo + 256] @ x.T
            scores[q_ids[lo : lo + 256, None] == ids[None, :]] = none
            for r, s in enumerate(scores, lo):
                at = np.arange(len(s)) if len(s) <= k else np.flatnonzero(s >= np.partition(s, len(s) - k)[len(s) - k])
                at = at[s[at] > none]
                at = at[np.argsort(-s[at], kind="stable")[:k]]  # ids ascend among equal scores
                found.append((np.full(len(at), q_ids[r]), np.full(len(at), q_keys[r]), ids[at], s[at].astype(np.int64)))
        return pa.Table.from_arrays([pa.array(np.concatenate(c)) for c in zip(*found, strict=True)], schema=out)

    return run


def _bounds(data: list, queries: list, pivots: np.ndarray, k: int, groups: np.ndarray, top: float) -> dict[tuple[int, int], float]:
    """For each group of query cells and each data cell the least distance from the data cell's
    pivot at which a vector may still be among the k nearest of a query of the group.

    Of k + 1 different ids one at most is the query's own, so k rows that are its candidates lie
    within the (k + 1)-th smallest bound of an id, however many rows an id has in whatever cells.
    """
    apart = np.sqrt(((pivots[:, None, :] - pivots[None, :, :]) ** 2).sum(2))
    near = {r.cell: np.array([x.dist for x in r.nearest]) for r in data}
    ids = np.concatenate([[x.vec_id for x in r.nearest] for r in data]).astype(np.int64)
    out: dict[tuple[int, int], float] = {}
    for r in queries:
        i, reach = r.cell, r.reach
        upper = np.concatenate([reach + apart[i, j] + d for j, d in near.items()])
        order = np.argsort(upper, kind="stable")
        _, least = np.unique(ids[order], return_index=True)  # where each id comes first
        upper = np.sort(upper[order[least]])
        theta = upper[k] if len(upper) > k else np.inf
        g = int(groups[i])
        for j in near:
            low = apart[i, j] - reach - theta
            low -= 1e-6 * (1 + apart[i, j] + reach + top**0.5)  # rounding
            out[g, j] = min(out.get((g, j), np.inf), low)
    return out


def voronoi_top_k(vectors: DataFrame, is_query: Column, *, id_col: str = "vec_id", vec_col: str = "embedding", k: int = K, pivots: int | None = None) -> DataFrame:
    """``query_id, rank, vec_id, score``: for each query the k rows of largest inner product, ties to smaller ids.

    Components count as floor(256 * x). Vectors are lifted to a sphere, where the order by
    distance is that by inner product, and dealt to the cells of ``pivots`` pivots (the vectors
    of smallest id hash). Per cell the summaries hold the largest distance of a query and the
    k + 1 smallest of data with different ids, which bound the distance of a query cell's k-th
    neighbour; a vector goes to a group of queries only if the triangle inequality lets it in.
    A group's queries are split into parts of about ``GROUP_QUERIES``, and the data that it lets in
    into blocks of about ``BLOCK_ROWS``, by hashes, so neither a crowded cell nor a row that occurs
    very often meets in one task; the blocks' best k are merged. Without ``pivots`` there are as many
    as the root of the rows, within ``PIVOTS``; the driver sees that many vectors and summary rows.

    Null ids, null vectors, and vectors with null or non-finite components take no part; a
    query meets only vectors of its dimension. Rows with the query's id are not its candidates. Repeated rows
    are candidates each, and one query together. Too few candidates give fewer ranks; no rows
    give none. Scores are exact; a vector whose product with itself is 2**62 or more raises
    ``OverflowError``. Other columns are not read.
    """
    wanted = vectors.select(F.col(f"`{id_col}`").cast("long").alias("vec_id"), F.col(f"`{vec_col}`").alias("embedding"))
    base = staged(wanted.mapInArrow(_vectors(), "vec_id long, v binary, dim int, norm long"), "vectors")
    found = None
    for row in base.groupBy("dim").agg(F.max("norm").alias("top"), F.count("*").alias("n")).collect():  # a row for each dimension
        part = _one_dimension(base.where(F.col("dim") == row.dim), is_query, row.dim, float(row.top), row.n, k, pivots)
        found = part if found is None else found.unionByName(part)
    if found is None:
        return vectors.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score long")
    return found


def _one_dimension(base: DataFrame, is_query: Column, dim: int, top: float, n: int, k: int, n_pivots: int | None) -> DataFrame:
    n_pivots = n_pivots or min(max(PIVOTS[0], int(n**0.5)), PIVOTS[1])
    chosen = base.orderBy(F.xxhash64("vec_id", F.lit("pivot")), "v").limit(n_pivots).select("v").toArrow()
    pivots = np.unique(_lift(_matrix(chosen.column("v"), dim), top), axis=0)
    schema = "vec_id long, v binary, cell int, dist double"
    own = is_query & F.col("vec_id").isNotNull()
    data = base.select("vec_id", "v").mapInArrow(_cells(pivots, dim, top, False), schema)
    data = staged(data.withColumn("row", F.monotonically_increasing_id()), "cells")
    asked = base.where(own).select("vec_id", "v").distinct().mapInArrow(_cells(pivots, dim, top, True), schema)
    asked = staged(asked.select(F.col("vec_id").alias("query_id"), F.col("v").alias("qv"), F.xxhash64("v").alias("q"), "cell", "dist"), "queries")

    by_dist = Window.partitionBy("cell").orderBy("dist")
    per_id = data.groupBy("cell", "vec_id").agg(F.min("dist").alias("dist"))
    nearest = per_id.withColumn("r", F.row_number().over(by_dist)).where(F.col("r") <= k + 1).groupBy("cell").agg(F.collect_list(F.struct("dist", "vec_id")).alias("nearest"))
    reach = asked.groupBy("cell").agg(F.max("dist").alias("reach"), F.count("*").alias("n"))
    data_rows, query_rows = nearest.collect(), sorted(reach.collect(), key=lambda r: r.cell)  # a row for each pivot at most
    groups, g, held = np.zeros(len(pivots), np.int64), 0, 0
    for r in query_rows:
        if held and held + r.n > GROUP_QUERIES:
            g, held = g + 1, 0
        groups[r.cell] = g
        held += r.n
    limits = _bounds(data_rows, query_rows, pivots, k, groups, top)
    spark = base.sparkSession
    sent = spark.createDataFrame([(int(j), g, float(low)) for (g, j), low in limits.items()], "cell int, g int, low double")
    reached = data.join(F.broadcast(sent), "cell").where("dist >= low")
    asking: dict[int, int] = {}
    for r in query_rows:
        asking[int(groups[r.cell])] = asking.get(int(groups[r.cell]), 0) + r.n
    shape = [(r.g, -(-r.n // BLOCK_ROWS), -(-asking[r.g] // GROUP_QUERIES)) for r in reached.groupBy("g").agg(F.count("*").alias("n")).collect()]
    split = F.broadcast(spark.createDataFrame(shape, "g int, blocks long, parts long"))
    named = spark.createDataFrame([(r.cell, int(groups[r.cell])) for r in query_rows], "cell int, g int")

    def dealt(key: str, into: str) -> Column:
        return F.pmod(F.xxhash64(key), F.col(into))

    def each(into: str) -> Column:
        return F.explode(F.sequence(F.lit(0).cast("long"), F.col(into) - 1))

    left = reached.join(split, "g").select("g", dealt("row", "blocks").alias("block"), each("parts").alias("part"), "vec_id", "v")
    right = asked.join(F.broadcast(named), "cell").join(split, "g").select("g", each("blocks").alias("block"), dealt("q", "parts").alias("part"), "query_id", "q", "qv")
    solved = (
        right.groupBy("g", "part", "block")
        .cogroup(left.groupBy("g", "part", "block"))
        .applyInArrow(_solve(k, dim, top), "query_id long, q long, vec_id long, score long")
    )
    best = Window.partitionBy("query_id", "q").orderBy(F.col("score").desc(), "vec_id")
    ranked = solved.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
    return ranked.select("query_id", F.col("rank").cast("int").alias("rank"), "vec_id", "score")


def op8_topk(spark, sf_dir: str) -> DataFrame:
    return voronoi_top_k(spark.read.parquet(f"{sf_dir}/embeddings.parquet"), F.col("vec_id") % EVERY == 0)


OP8_SQL = """
WITH v AS (SELECT vec_id, list_transform(embedding, lambda x: floor(256 * x::DOUBLE)) AS v FROM embeddings
  WHERE vec_id IS NOT NULL AND embedding IS NOT NULL AND len(list_filter(embedding, lambda x: x IS NULL OR NOT isfinite(x))) = 0),
s AS (SELECT q.vec_id AS query_id, d.vec_id, list_dot_product(q.v, d.v)::BIGINT AS score
  FROM v q JOIN v d ON q.vec_id % 50 = 0 AND d.vec_id <> q.vec_id)
SELECT query_id, rank::INTEGER AS rank, vec_id, score FROM (
  SELECT *, row_number() OVER (PARTITION BY query_id ORDER BY score DESC, vec_id) AS rank FROM s) WHERE rank <= 5
"""
