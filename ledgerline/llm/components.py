"""Connected components: parts contracted in their tasks, then alternating large-star and small-star steps; edges and labels stay distributed."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import merged, written

#: Edges in a part that one task contracts before parts meet.
PART = 500_000


def contracted(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each node of the edges and the smallest node of its component: roots hang on smaller neighbouring roots until no edge joins two."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        if (low == high).all():
            return nodes, nodes[root]
        np.minimum.at(root, high, low)
        while (root[root] != root).any():
            root = root[root]


def _contracted(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The edges (u, v) of a part -> (node, root) within it."""
    parts = [(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches]
    if parts:
        nodes, roots = contracted(*(np.concatenate(x) for x in zip(*parts, strict=True)))
        for at in range(0, len(nodes), 65_536):
            yield pa.RecordBatch.from_arrays([pa.array(nodes[at : at + 65_536]), pa.array(roots[at : at + 65_536])], ["node", "root"])


def _smallest(edges: DataFrame) -> DataFrame:
    """(u, v, m): m the least of u and its neighbours."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    return merged(edges, least, "u").withColumn("m", F.least("u", "m"))


def _all_stars(edges: DataFrame) -> bool:
    """Whether each node has one smaller neighbour, which itself has none."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")).unionByName(edges.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")).where("up > 1 or (up = 1 and down = 1)").isEmpty()


def connected_components(edges: DataFrame, most_rounds: int = 60) -> DataFrame:
    """(node, root) for every node of edges (u, v); root is its component's smallest node.

    Parts of about PART edges are contracted first, each in one task; if there is more than one, alternating steps join what they found. The
    rounds grow with the logarithm of a component's size; RuntimeError if they have not ended after most_rounds.
    """
    edges = edges.where("u <> v").select("u", "v")
    n = max(1, -(-edges.count() // PART))
    parts = edges.coalesce(1) if n == 1 else edges.repartition(n)
    known = written(parts.mapInArrow(_contracted, "node long, root long"), "edges")
    if n == 1:
        return known
    ends = written(known.where("node <> root").select(F.col("node").alias("u"), F.col("root").alias("v")).distinct(), "edges")
    for _ in range(most_rounds):
        if _all_stars(ends):
            roots = ends.select(F.col("u").alias("node"), F.col("v").alias("root"))
            return roots.unionByName(ends.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
        both = ends.unionByName(ends.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _smallest(both).where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u <> v")
        # Small star: only neighbours below u, and u itself.
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = merged(large, least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        ends = written(small, "edges")
    raise RuntimeError(f"components have not converged after {most_rounds} rounds")
