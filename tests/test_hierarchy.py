"""Trees of any depth: rounds of joins against a plain walk."""

import random

import pytest
from pyspark.sql import functions as F

from tessella.operators import hierarchy as H

EDGES = "parent string, node string, pos int"


def walked(rows):
    """node, path, order, depth and size of each occurrence, by recursion."""
    below = {}
    for parent, node, pos in sorted(rows, key=lambda e: (-1 if e[2] is None else e[2], e[1])):
        below.setdefault(parent, []).append(node)
    out = []

    def visit(node, path):
        at = len(out)
        out.append(None)
        for n in below.get(node, []):
            visit(n, (*path, n))
        out[at] = (node, path, at, len(path) - 1, len(out) - at)

    for n in below.get(None, []):
        visit(n, (n,))
    return out


def random_edges(seed, n, repeated):
    r = random.Random(seed)
    rows = [(None, "r0", 1), (None, "r1", None)]
    for i in range(n):
        rows.append((r.choice(rows)[1], f"n{i:02}", r.choice([None, 0, 1, 2])))
    if repeated:  # inner names with two parents
        rows += [("r0", "n01", 5), ("n00", "twice", 0), ("n01", "twice", 0), ("twice", "under", 0)]
    return rows + [("x", "y", 0), ("y", "x", 0), ("y", "z", 0), ("gone", "w", 0)]


@pytest.mark.parametrize("repeated", [False, True])
@pytest.mark.parametrize("small", [1000, 3])
def test_places_and_paths_equal_a_walk(spark, small, repeated):
    rows = random_edges(4, 30, repeated)
    e = spark.createDataFrame(rows, EDGES).repartition(3)
    want = walked(rows)
    got = sorted((r.order, r.node, r.depth, r["size"]) for r in H.places(e, small=small).collect())
    assert got == [(o, n, d, s) for n, _, o, d, s in want]
    assert sorted((r.order, r.node, tuple(r.path), r.depth) for r in H.all_paths(e, small=small).collect()) == [(o, n, p, d) for n, p, o, d, _ in want]
    assert [r.node for r in H.leaves(e, small=small).collect()] == [n for n, _, _, _, s in want if s == 1]
    assert {r.file for r in H.cycle_findings(e, "tree", small=small).collect()} == {"x", "y", "z", "w"}
    text = "".join(r.piece for r in H.newick_pieces(e, small=small).orderBy("place").collect())
    assert text == "".join(r.newick for r in H.newick(e, small=small).collect()) and text.count(";") == 2


@pytest.mark.parametrize("small", [1000, 3])
def test_a_cycle_below_a_root_and_no_edges(spark, small):
    ring = spark.createDataFrame([(None, "a", 0), ("a", "b", 0), ("b", "c", 0), ("c", "b", 0), (None, "d", 0)], EDGES)
    with pytest.raises(ValueError, match="below itself"):
        H.places(ring, small=small).collect()
    assert H.places(ring.limit(0), small=small).count() == 0 and H.newick(ring.limit(0), small=small).count() == 0


def test_a_chain_of_ten_thousand(spark):
    n = 10_000
    chain = spark.range(n).select(F.when(F.col("id") > 0, F.concat(F.lit("n"), (F.col("id") - 1).cast("string"))).alias("parent"), F.concat(F.lit("n"), F.col("id").cast("string")).alias("node"), F.lit(0).alias("pos"))
    for small in (n, 100):
        at = H.places(chain, small=small)
        wrong = at.where((F.concat(F.lit("n"), F.col("depth").cast("string")) != F.col("node")) | (F.col("order") != F.col("depth")) | (F.col("size") != n - F.col("depth")))
        assert at.count() == n and wrong.isEmpty()
    assert [r.node for r in H.leaves(chain, small=100).collect()] == ["n9999"]
    some = chain.where("node IN ('n0') OR cast(substr(node, 2) AS int) < 1500")
    deepest = H.paths(some, small=100).where("node = 'n1499'").first()
    assert deepest.depth == 1499 and deepest.path == [f"n{i}" for i in range(1500)]


def test_a_wide_tree_is_numbered_without_gaps(spark):
    n = 60_000
    key = F.format_string("%07d", F.col("id"))
    up = F.when(F.col("id") < 2, F.lit(0)).when(F.col("id") % 3 > 0, F.lit(1)).otherwise(F.floor(F.col("id") / 3))  # one node holds two thirds
    e = spark.range(n).select(F.when(F.col("id") > 0, F.format_string("%07d", up.cast("long"))).alias("parent"), key.alias("node"), F.lit(0).alias("pos"))
    at = H.places(e).cache()
    assert at.count() == n == at.select("order").distinct().count() and at.agg(F.max("order")).first()[0] == n - 1
    assert at.agg(F.sum("size")).first()[0] == at.agg(F.sum(F.col("depth") + 1)).first()[0]
    above = at.select(F.col("id").alias("up"), F.col("order").alias("o"), F.col("size").alias("s"), F.col("depth").alias("d"))
    assert at.join(above, "up").where((F.col("order") <= F.col("o")) | (F.col("order") + F.col("size") > F.col("o") + F.col("s")) | (F.col("depth") != F.col("d") + 1)).isEmpty()
    assert [r.node for r in at.where("parent = '0000001'").orderBy("order").limit(3).collect()] == ["0000002", "0000003", "0000004"]
    at.unpersist()


def test_leaves_take_no_part_in_the_rounds(spark, monkeypatch):
    rows = [(None, "r", 0), *[("r", f"n{i}", i) for i in range(5)], *[(f"n{i % 5}", f"leaf{i:03}", i) for i in range(300)], (None, "alone", 1), ("x", "y", 0), ("y", "x", 0), ("y", "z", 0)]
    e = spark.createDataFrame(rows, EDGES)
    sizes = {}

    def watched(df, label, held=H.written):
        out = held(df, label)
        sizes[label] = max(sizes.get(label, 0), out.count())
        return out

    monkeypatch.setattr(H, "written", watched)
    assert {r.file for r in H.cycle_findings(e, "tree", small=3).collect()} == {"x", "y", "z"}
    assert max(sizes.values()) == 8  # nodes with children
    at = H.places(e, small=3)
    assert sorted((r.order, r.node, r.depth, r["size"]) for r in at.collect()) == [(o, n, d, s) for n, _, o, d, s in walked(rows)]
    assert sizes["ranks"] == 8 and sizes["offsets"] == 6
    assert at.select("id").distinct().count() == at.count() == 307
