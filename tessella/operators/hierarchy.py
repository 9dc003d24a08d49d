"""Trees as edge tables, of any depth and size: paths, leaves, pre-order and text notations."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from ..scratch import drop, written
from .rules import ERROR, _finding

EDGE = "parent string, node string, pos int, depth int"
SMALL = 10_000  # edges that are walked in the driver instead of by rounds of joins
CHUNK = 4096  # pieces of a text that are joined at a time
_PLACE = "id long, up long, root long, node string, parent string, pos int, depth long, size long, order long"
_COLUMNS = ["id", "up", "root", "node", "parent", "pos", "depth", "size", "order"]


def tree_edges(tree: dict) -> list[tuple]:
    """(parent, node, pos, depth) of a nested mapping whose leaves are empty or null."""
    out, todo = [], [(None, tree, 0)]
    while todo:
        parent, branch, depth = todo.pop()
        for pos, (node, below) in enumerate((branch or {}).items()):
            out.append((parent, str(node), pos, depth))
            todo.append((str(node), below, depth + 1))
    return out


def edge_frame(spark: SparkSession, tree: dict) -> DataFrame:
    return spark.createDataFrame(tree_edges(tree), EDGE)


# --- places -------------------------------------------------------------------


def places(edges: DataFrame, *, small: int = SMALL) -> DataFrame:
    """``id, up, root, node, parent, pos, depth, size, order``: each occurrence of a node below a root.

    ``id`` names an occurrence, ``up`` and ``root`` the ones above it and at the top; ``size`` counts
    the occurrences below it and itself; ``order`` is its place in pre-order, from 0 over all roots.
    Roots have a null parent. Siblings stand by ``pos``, then by name. A name with several parents
    occurs, with all below it, under each. Nodes that no root leads to (below an unknown parent or
    in a cycle, see ``cycle_findings``) have no place; a cycle that a root leads to is an error.

    Up to ``small`` edges are walked in the driver, a bounded table. Of more, no step needs a node's
    relatives together: ancestors at distance 1, 2, 4, .. are found by joins of the nodes that have
    children with themselves, and sizes, depths and places in order are sums over these, so the
    number of rounds is the logarithm of the depth. Leaves take no part in the rounds: they are
    counted for their parents, put in order among their siblings, and joined to their parent at the end.
    """
    edges = edges.select("parent", "node", "pos")
    if (near := _few(edges, small)) is not None:
        return edges.sparkSession.createDataFrame(_walked(near), _PLACE)
    e = written(edges.join(_with_children(edges), "node", "left").withColumn("id", F.monotonically_increasing_id()), "edges")
    return _in_order(e, _ranked(_occurrences(e.where("children IS NOT NULL"))))


def _few(edges: DataFrame, small: int) -> list[tuple] | None:
    """The edges, if there are no more than ``small``."""
    near = edges.limit(small + 1).collect()
    return [tuple(r) for r in near] if len(near) <= small else None


def _with_children(edges: DataFrame) -> DataFrame:
    """``node, children``: how many edges name a node as their parent."""
    return edges.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("children"))


def _walked(edges: list[tuple]) -> list[tuple]:
    """The places of a small tree."""
    below: dict = {}
    for parent, node, pos in sorted(edges, key=lambda e: (e[2] if e[2] is not None else -1, e[1])):
        below.setdefault(parent, []).append((node, pos))
    out, todo, on_path = [], [(n, None, p, None, 0, None) for n, p in reversed(below.get(None, []))], []
    while todo:
        node, parent, pos, up, depth, root = todo.pop()
        del on_path[depth:]
        if depth and node in below and node in set(on_path):
            raise ValueError(f"{node} is below itself")
        on_path.append(node)
        at = len(out)
        root = at if root is None else root
        out.append([at, up, root, node, parent, pos, depth, 1, at])
        todo += [(n, node, p, at, depth + 1, root) for n, p in reversed(below.get(node, []))]
    for x in reversed(out):
        if x[1] is not None:
            out[x[1]][7] += x[7]
    return [tuple(x) for x in out]


def _occurrences(inner: DataFrame) -> DataFrame:
    """``id, up, edge, node, parent, pos, size`` of edges ``id, node, parent, pos, children`` to nodes that have
    children: each with that of its parent; ``up`` is null where there is none. ``size`` counts the leaves
    below a node and itself.

    Where such names have several parents, occurrences are made from the roots down, level by level.
    """
    within = inner.where("parent IS NOT NULL").groupBy(F.col("parent").alias("node")).agg(F.count("*").alias("within"))
    size = F.col("children") - F.coalesce("within", F.lit(0)) + 1
    e = written(inner.join(within.hint("merge"), "node", "left").select("id", "node", "parent", "pos", size.alias("size")), "inner")
    rest = ["node", "parent", "pos", "size"]
    named = written(e.groupBy("node").agg(F.min("id").alias("up"), F.count("*").alias("n")), "names")
    if named.where("n > 1").isEmpty():
        above = named.select(F.col("node").alias("parent"), "up")
        out = written(e.join(above.hint("merge"), "parent", "left").select("id", "up", F.col("id").alias("edge"), *rest), "occurrences")
        drop(e, named)
        return out
    most, levels = named.count() + 1, []
    level = e.where("parent IS NULL").select(F.lit(None).cast("long").alias("up"), F.col("id").alias("edge"), *rest)
    while True:
        k = len(levels)
        level = written(level.select((F.monotonically_increasing_id() + F.lit(k << 52)).alias("id"), "up", "edge", *rest), "level")
        if level.isEmpty():
            break
        if k > most:
            raise ValueError("a node is below itself")
        levels.append(level)
        above = level.select(F.col("id").alias("up"), F.col("node").alias("parent"))
        level = e.join(above.hint("merge"), "parent").select("up", F.col("id").alias("edge"), *rest)
    out = levels[0] if levels else level
    for x in levels[1:]:
        out = out.unionByName(x)
    out = written(out, "occurrences")
    drop(e, named, *levels)
    return out


def _ranked(rows: DataFrame) -> DataFrame:
    """``rows`` below roots, with ``root, depth``, and ``size`` summed over all below.

    After k rounds ``far`` is the ancestor at distance 2**k, or the topmost one, ``depth`` the distance
    to it, and ``size`` counts what is less than 2**k below. What lies at 2**k or more is below one
    of those that have this node as their ancestor at just that distance.
    """
    state = written(rows.select("*", F.coalesce("up", "id").alias("far"), F.when(F.col("up").isNull(), 0).otherwise(1).cast("long").alias("depth")), "ranks")
    step, most = 1, 2 * rows.count()
    while step <= most and not state.where(F.col("depth") == step).isEmpty():
        above = state.select(F.col("id").alias("far"), F.col("far").alias("farther"), F.col("depth").alias("more"))
        below = state.where(F.col("depth") == step).groupBy(F.col("far").alias("id")).agg(F.sum("size").alias("held"))
        nxt = state.join(above.hint("merge"), "far").join(below.hint("merge"), "id", "left")
        nxt = nxt.select("id", "up", "edge", "node", "parent", "pos", F.col("farther").alias("far"), (F.col("depth") + F.col("more")).alias("depth"), (F.col("size") + F.coalesce("held", F.lit(0))).alias("size"))
        nxt = written(nxt, "ranks")
        drop(state)
        state, step = nxt, step * 2
    roots = rows.where("parent IS NULL").select(F.col("id").alias("far"))
    out = written(state.where(F.col("depth") < step).join(roots, "far").withColumnRenamed("far", "root"), "ranked")
    drop(state, rows)
    return out


def _runs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Rows in order of parents with the task's number, the sum of the sizes before each within its task
    (``before``), and of those of one parent alone (``offset``). Both are equal for the parent that a task
    begins with, and for no other."""
    total, start, last, task = 0, 0, None, TaskContext.get().partitionId()
    for b in batches:
        parent, size = b.column("parent"), b.column("size").to_numpy()
        if not len(size):
            continue
        x, y = parent.slice(1), parent.slice(0, len(parent) - 1)
        new = pc.coalesce(pc.not_equal(x, y), pc.xor(pc.is_null(x), pc.is_null(y))).to_numpy(zero_copy_only=False)
        new = np.r_[total > 0 and parent[0].as_py() != last, new]
        before = total + np.cumsum(size) - size
        at = np.maximum.accumulate(np.where(new, np.arange(len(size)), -1))
        offset = before - np.where(at >= 0, before[at], start)
        yield pa.RecordBatch.from_arrays([*b.columns, pa.array(before), pa.array(offset), pa.array(np.full(len(size), task))], names=[*b.schema.names, "before", "offset", "task"])
        total, start, last = int(before[-1] + size[-1]), int(before[-1] - offset[-1]), parent[-1].as_py()


def _among_siblings(edges: DataFrame) -> DataFrame:
    """``id, parent, node, pos, size, offset`` of edges ``id, parent, node, pos, size``: the sum of the sizes of
    earlier siblings.

    Edges are sorted by parents in ranges, so the children of one node may be spread over many
    tasks. What the siblings in earlier tasks come to is a number a task, which passes the driver.
    """
    spark = edges.sparkSession
    keys = [F.asc_nulls_first("parent"), F.asc_nulls_first("pos"), F.asc("node"), F.asc("id")]
    ranges = edges.repartitionByRange(int(spark.conf.get("spark.sql.shuffle.partitions")), *keys).sortWithinPartitions(*keys)
    run = written(ranges.mapInArrow(_runs, "id long, parent string, node string, pos int, size long, before long, offset long, task long"), "runs")
    tasks = run.groupBy("task").agg(F.min_by("parent", "before").alias("first"), F.max_by("parent", "before").alias("last"), F.max_by(F.col("offset") + F.col("size"), "before").alias("held"), F.max_by(F.col("offset") == F.col("before"), "before").alias("one"))
    carried, starts, last = 0, [], None
    for r in sorted(tasks.collect(), key=lambda r: r["task"]):
        carry = carried if starts and r["first"] == last else 0
        starts.append((r["task"], carry))
        carried, last = r["held"] + (carry if r["one"] else 0), r["last"]
    carry = F.when(F.col("offset") == F.col("before"), F.col("carry")).otherwise(0)
    out = run.join(F.broadcast(spark.createDataFrame(starts, "task long, carry long")), "task").select("id", "parent", "node", "pos", "size", (F.col("offset") + carry).alias("offset"))
    out.written_at = run.written_at
    return out


def _in_order(e: DataFrame, inner: DataFrame) -> DataFrame:
    """All places, of the edges and the ranked occurrences of nodes that have children: an occurrence stands
    one after the one above it, and after all that lies below earlier siblings; these offsets are
    added up along the way to the root. The ``id`` of a leaf is its place in order, below 0.
    """
    sizes = inner.groupBy("node").agg(F.first("size").alias("size"))
    large = e.where("children IS NOT NULL").join(sizes.hint("merge"), "node", "left").select("id", "parent", "node", "pos", F.coalesce("size", F.lit(1)).cast("long").alias("size"))
    leaf = e.where("children IS NULL").select(F.lit(None).cast("long").alias("id"), "parent", "node", "pos", F.lit(1).cast("long").alias("size"))
    at = _among_siblings(leaf.unionByName(large))
    offset = at.where("id IS NOT NULL").select(F.col("id").alias("edge"), "offset")
    first = F.col("offset") + F.when(F.col("up").isNull(), 0).otherwise(1)
    state = written(inner.join(offset.hint("merge"), "edge").select("id", F.col("up").alias("far"), first.alias("order")), "offsets")
    while not state.where("far IS NOT NULL").isEmpty():
        above = state.select(F.col("id").alias("far"), F.col("far").alias("farther"), F.col("order").alias("more"))
        nxt = written(state.join(above.hint("merge"), "far", "left").select("id", F.col("farther").alias("far"), (F.col("order") + F.coalesce("more", F.lit(0))).alias("order")), "offsets")
        drop(state)
        state = nxt
    top = written(inner.join(state.select("id", "order").hint("merge"), "id").select(*_COLUMNS), "top")
    drop(e, inner, state)
    leaf = at.where("id IS NULL").drop("id")
    above = top.select(F.col("node").alias("parent"), F.col("id").alias("up"), "root", (F.col("depth") + 1).alias("depth"), (F.col("order") + 1).alias("least"))
    below = leaf.join(above, "parent").withColumn("order", F.col("least") + F.col("offset")).withColumn("id", -1 - F.col("order"))
    alone = leaf.where("parent IS NULL").withColumn("order", F.col("offset")).withColumn("id", -1 - F.col("order"))
    alone = alone.withColumn("up", F.lit(None).cast("long")).withColumn("root", F.col("id")).withColumn("depth", F.lit(0).cast("long"))
    out = written(top.unionByName(below.select(*_COLUMNS)).unionByName(alone.select(*_COLUMNS)), "places")
    drop(top, at)
    return out


def cycle_findings(edges: DataFrame, check: str, *, small: int = SMALL) -> DataFrame:
    """A finding for each node that no root leads to: it is part of a cycle, or below one or an unknown parent.

    A node is below a root if one of its parents is, so of the nodes without children only the parents count.
    """
    edges = edges.select("parent", "node", "pos")
    if (near := _few(edges, small)) is not None:
        inner = edges.sparkSession.createDataFrame(_walked(near), _PLACE)
    else:
        e = written(edges.join(_with_children(edges), "node").withColumn("id", F.monotonically_increasing_id()), "edges")
        inner = _ranked(_occurrences(e))
        drop(e)
    above = inner.select(F.col("node").alias("parent")).distinct().withColumn("reached", F.lit(True))
    reached = F.col("parent").isNull() | F.col("reached").isNotNull()
    lost = edges.join(above, "parent", "left").groupBy("node").agg(F.max(reached).alias("reached")).where("NOT reached")
    return _finding(lost, check, ERROR, F.col("node"), F.format_string("node '%s' is not below any root", F.col("node")))


# --- what places tell -------------------------------------------------------------


def all_paths(edges: DataFrame, *, small: int = SMALL) -> DataFrame:
    """``node, parent, path, order, depth``: every occurrence of a node, with the names from the root on.

    Paths are put together from pieces of double length in each round; all of them together are as
    long as the sum of the depths.
    """
    at = places(edges, small=small)
    state = at.select("id", F.col("up").alias("far"), F.array("node").alias("path"))
    deepest, done, old = at.agg(F.max("depth")).first()[0] or 0, 1, None
    while done <= deepest:
        above = state.select(F.col("id").alias("far"), F.col("far").alias("farther"), F.col("path").alias("more"))
        state = state.join(above, "far", "left").select("id", F.col("farther").alias("far"), F.when(F.col("more").isNull(), F.col("path")).otherwise(F.concat("more", "path")).alias("path"))
        done *= 2
        if done > 32:  # a plan of few joins as it is, beyond that a table a round
            state = written(state, "paths")
            drop(old)
            old = state
    return at.join(state.select("id", "path"), "id").select("node", "parent", "path", "order", F.col("depth").cast("int").alias("depth"))


def paths(edges: DataFrame, *, small: int = SMALL) -> DataFrame:
    """One path for each node name, the first in pre-order."""
    rest = ["parent", "path", "order", "depth"]
    return all_paths(edges, small=small).groupBy("node").agg(F.min_by(F.struct(*rest), "order").alias("x")).select("node", "x.*")


def with_path(df: DataFrame, key: str, edges: DataFrame, name: str = "taxonomy") -> DataFrame:
    """``df`` with the path of ``key``, an empty array if the tree doesn't have it."""
    p = paths(edges).select(F.col("node").alias("_node"), F.col("path").alias("_path"))
    return df.join(p, df[key] == F.col("_node"), "left").withColumn(name, F.coalesce("_path", F.array().cast("array<string>"))).drop("_node", "_path")


def nodes(edges: DataFrame, *, small: int = SMALL) -> DataFrame:
    """Node names in pre-order, repeated ones included."""
    return places(edges, small=small).select("node", "order").orderBy("order")


def node_set(edges: DataFrame) -> DataFrame:
    return edges.select("node").distinct()


def leaves(edges: DataFrame, *, small: int = SMALL) -> DataFrame:
    """Occurrences without children, in pre-order."""
    return places(edges, small=small).where("size = 1").select("node", "order", F.col("depth").cast("int").alias("depth")).orderBy("order")


# --- text -------------------------------------------------------------------------


def newick_pieces(edges: DataFrame, *, small: int = SMALL) -> DataFrame:
    """``root, place, piece``: the notation of all roots' trees in pieces, a node each, whose text in order of
    ``place`` is the whole; ``root`` is the place in pre-order at which a tree begins.

    Nodes stand in post-order (a node after all below it), each behind the bracket or comma that its
    depth and the depth before it ask for; the one before is found by its number.
    """
    at = places(edges, small=small).withColumn("place", F.col("order") - F.col("depth") + F.col("size") - 1)
    before = at.select((F.col("place") + 1).alias("place"), F.col("root").alias("other"), F.col("depth").alias("before"))
    both = at.join(before, "place", "left").withColumn("before", F.when(F.col("other") == F.col("root"), F.col("before")))
    top = at.where("up IS NULL").select(F.col("root"), F.col("order").alias("top"))
    opened = F.repeat(F.lit("("), F.greatest(F.col("depth") - F.coalesce("before", F.lit(0)), F.lit(0)).cast("int"))
    parted = F.when(F.col("before").isNull(), F.lit("")).when(F.col("depth") < F.col("before"), F.lit(")")).otherwise(F.lit(","))
    ended = F.when(F.col("up").isNull(), F.lit(";")).otherwise(F.lit(""))
    return both.join(top, "root").select(F.col("top").alias("root"), "place", F.concat(parted, opened, "node", ended).alias("piece"))


def newick(edges: DataFrame, root: str | None = None, *, small: int = SMALL) -> DataFrame:
    """``root, newick``: the notation of each root's tree, or of one root's, as one text; children stand
    before the name. Pieces are joined by thousands, then these; a tree whose text is too long for one
    row is written from ``newick_pieces``."""
    p = newick_pieces(edges, small=small)

    def joined(df: DataFrame, keys: list, by: str, text: str) -> DataFrame:
        rows = F.array_sort(F.collect_list(F.struct(by, text)))
        return df.groupBy(*keys).agg(F.array_join(F.transform(rows, lambda x: x[text]), "").alias(text))

    chunks = joined(p.withColumn("chunk", F.floor(F.col("place") / CHUNK)), ["root", "chunk"], "place", "piece")
    trees = joined(chunks, ["root"], "chunk", "piece")
    names = places(edges, small=small).where("up IS NULL").select(F.col("order").alias("root"), "node")
    out = trees.join(names, "root").orderBy("root").select(F.col("node").alias("root"), F.col("piece").alias("newick"))
    return out if root is None else out.where(F.col("root") == root)
