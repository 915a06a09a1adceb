"""Connected components by alternating large-star and small-star rounds."""

from __future__ import annotations

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from weftline.session import cut

#: A node is hot above this many edges, or above the share of all edge ends that would make
#: more than so many nodes hot; the hot nodes are few by construction and so can be broadcast.
HOT_EDGES, MOST_HOT = 2000, 5000
#: Up to so many edges (a few MB) one task joins them; beyond, rounds over all executors do.
FEW_EDGES = 100_000


def _with_least(edges: DataFrame, limit: int) -> DataFrame:
    """Edges (u, v) with ``m``, the least of u and all its v. Edges of nodes with more than
    ``limit`` edges don't meet in a task; they get the result by broadcast."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"), F.count("*").alias("n")).select("u", F.least("m", "u").alias("m"), "n")
    hot = F.broadcast(least.where(F.col("n") > limit).select("u", "m"))
    cold = edges.join(hot.select("u"), "u", "left_anti").join(least.select("u", "m"), "u")
    return cold.unionByName(edges.join(hot, "u"))


def _large_star(edges: DataFrame, limit: int) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    return _with_least(both, limit).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")


def _small_star(edges: DataFrame, limit: int) -> DataFrame:
    least = _with_least(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), limit)
    return least.select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def _settled(edges: DataFrame) -> bool:
    """Each edge leads from a node with no other edge to the least of its component."""
    ends = edges.select(F.col("u").alias("x"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("v").alias("x"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    odd = ends.groupBy("x").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or up = 1 and down = 1")
    return odd.isEmpty()


def _joined(batches):
    """(node, component) of few edges (u, v), by union-find."""
    parent: dict = {}

    def root(x):
        parent.setdefault(x, x)
        while parent[x] != x:
            parent[x] = parent[parent[x]]
            x = parent[x]
        return x

    for b in batches:
        for u, v in zip(b.column("u").to_pylist(), b.column("v").to_pylist(), strict=True):
            u, v = root(u), root(v)
            if u != v:
                parent[max(u, v)] = min(u, v)
    if parent:
        kind = b.schema.field("u").type
        yield pa.RecordBatch.from_arrays([pa.array(list(parent), kind), pa.array([root(x) for x in list(parent)], kind)], ["node", "component"])


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60, few: int | None = None) -> DataFrame:
    """(node, component) for every node of an undirected edge list; the component is its least node.

    Self loops, repeated and reversed edges are fine; edges with a null end are ignored. A node
    whose only edges are loops forms its own component. Each round is checkpointed in the shared
    folder, and so are the edges, which are made once. Rounds grow with the logarithm of the longest path; running out of them is an error.
    Up to ``few`` edges (FEW_EDGES) are joined by one task, with the same result.
    """
    given = cut(edges.select(F.col(src).alias("u"), F.col(dst).alias("v")).where("u is not null and v is not null").distinct())
    many = given.count()
    if many <= (FEW_EDGES if few is None else few):
        kind = dict(given.dtypes)["u"]
        return cut(given.coalesce(1).mapInArrow(_joined, f"node {kind}, component {kind}")) if many else given.select(F.col("u").alias("node"), F.col("v").alias("component"))
    loops = given.where("u = v").select(F.col("u").alias("node"))
    now = cut(given.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct())
    for _ in range(max_rounds):
        if _settled(now):
            break
        limit = max(HOT_EDGES, 2 * now.count() // MOST_HOT)
        now = cut(_small_star(_large_star(now, limit), limit))
    else:
        raise RuntimeError(f"components did not settle within {max_rounds} rounds")
    found = now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(now.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
    alone = loops.distinct().join(found, "node", "left_anti").select("node", F.col("node").alias("component"))
    return found.unionByName(alone)
