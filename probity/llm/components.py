"""Connected components by alternating large-star and small-star rounds, every step a join or a grouped minimum.

Up to ``FEW`` different edges (a megabyte) need no rounds: one task unites them."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from probity.llm.common import cut, partitions

#: So many edges are few.
FEW = 1 << 16


def _star(edges: DataFrame) -> DataFrame:
    """(u, v) -> (u, v, m): m is the smaller of u and its smallest v. Both sides of the join are dealt out anew, so that
    the rows of a node with very many edges can be split over tasks."""
    least = edges.groupBy("u").agg(F.min("v").alias("m")).select(F.col("u").alias("_u"), F.least("u", "m").alias("m"))
    least = least.repartition(partitions(edges.sparkSession))
    return edges.join(least, F.col("u") == F.col("_u")).select("u", "v", "m")


def unite(parent: np.ndarray, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """Union-find over arrays: ``parent`` with a[i] and b[i] joined; each set's root is its smallest member."""
    while True:
        while not np.array_equal(up := parent[parent], parent):
            parent = up
        x, y = parent[a], parent[b]
        if not (apart := x != y).any():
            return parent
        x, y, a, b = x[apart], y[apart], a[apart], b[apart]
        np.minimum.at(parent, np.maximum(x, y), np.minimum(x, y))


def _united(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Edges (u, v) of one task -> (node, component)."""
    batches = list(batches)
    if not batches:
        return
    nodes, ends = np.unique(np.concatenate([b.column(c).to_numpy() for c in "uv" for b in batches]), return_inverse=True)
    root = unite(np.arange(len(nodes)), *ends.reshape(2, -1))
    yield pa.RecordBatch.from_arrays([pa.array(nodes), pa.array(nodes[root])], ["node", "component"])


def components(edges: DataFrame, few: int = FEW) -> DataFrame:
    """Edges (a, b) of long ids -> (node, component), the component being its smallest node. Nodes without edges and
    edges from a node to itself give no row. The driver sees two numbers a round."""
    now = cut(edges.filter("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct())
    if now.count() <= few:
        return cut(now.coalesce(1).mapInArrow(_united, "node long, component long"))

    def state(df: DataFrame):
        return tuple(df.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(20,0)"))).first())

    was = state(now)
    while was[0]:
        both = now.unionByName(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).filter("v > u AND v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()
        large = cut(large)
        small = _star(large)
        small = small.select("u", F.col("m").alias("v")).unionByName(small.select(F.col("v").alias("u"), F.col("m").alias("v")))
        now = cut(small.filter("u <> v").distinct())
        if (at := state(now)) == was:
            break
        was = at
    roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return now.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)
