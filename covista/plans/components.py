"""Connected components of a table of edges."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from covista.plans.shared import Workspace

# edges that a task contracts at a time
CHUNK = 1 << 17


def forest(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Stars (smallest node, node) that connect what the edges connect."""
    nodes, ends = np.unique(np.concatenate([a, b]), return_inverse=True)
    parent = list(range(len(nodes)))

    def root(x: int) -> int:
        while parent[x] != x:
            parent[x] = x = parent[parent[x]]
        return x

    for x, y in zip(ends[:len(a)].tolist(), ends[len(a):].tolist()):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    roots = np.fromiter((root(x) for x in range(len(nodes))), dtype=np.int64, count=len(nodes))
    moved = roots != np.arange(len(nodes))
    return nodes[roots[moved]], nodes[moved]


def contracted(edges: DataFrame) -> DataFrame:
    """The edges (a, b) as stars of the part that a task reads at a time, without a shuffle. A node with very many
    neighbours is so left with one edge a part."""

    def run(batches):
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(h.num_rows for h in held) >= CHUNK:
                yield from made(held)
                held = []
        if held:
            yield from made(held)

    def made(held):
        a, b = (np.concatenate([h.column(c).to_numpy() for h in held]) for c in ("a", "b"))
        x, y = forest(a, b)
        yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()), pa.array(y, pa.int64())], ["a", "b"])

    return edges.select("a", "b").mapInArrow(run, "a bigint, b bigint")


def components(edges: DataFrame, work: Workspace) -> DataFrame:
    """(node, root) for the nodes of the edges (a, b), both longs: alternating stars until nothing moves.

    Each round every node's larger neighbours, then all its smaller ones, move to its smallest
    neighbour; then every task contracts the edges it has made. Rounds are stored, so a lost executor costs one round;
    they grow with the logarithm of the longest path. Edges of a node with itself give nothing.
    """
    now = work.store(contracted(edges.where("a <> b")).distinct(), "edges")
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.least(F.min("b"), F.col("a")).alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b"), F.col("m")).where("b <> m")
        small = large.groupBy("b").agg(F.min("m").alias("m"))
        moved = (large.join(small.withColumnRenamed("m", "low"), "b")
                 .select(F.explode(F.array(F.struct(F.col("low").alias("a"), F.col("b").alias("b")),
                                           F.struct(F.col("low").alias("a"), F.col("m").alias("b")))).alias("e"))
                 .select("e.a", "e.b").where("a <> b"))
        after = work.store(contracted(moved).distinct(), "edges")
        # done when every edge leads from a root to a leaf
        inner = after.select("a").distinct().join(after.select(F.col("b").alias("a")).distinct(), "a").limit(1).count()
        many = after.groupBy("b").agg(F.count("*").alias("n")).where("n > 1").limit(1).count()
        work.drop(now)
        now = after
        if not inner and not many:
            return now.select(F.col("b").alias("node"), F.col("a").alias("root")).unionByName(
                now.select(F.col("a").alias("node"), F.col("a").alias("root")).distinct())
