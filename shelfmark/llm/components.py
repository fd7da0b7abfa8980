"""Connected components of a graph of edges between long ids, as Spark joins."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from shelfmark.llm.common import stored


def forest(a: list[int], b: list[int]) -> list[tuple[int, int]]:
    """Edges (node, root) of the components of some edges, the root being the least node."""
    parent: dict[int, int] = {}

    def root(x: int) -> int:
        top = x
        while parent.setdefault(top, top) != top:
            top = parent[top]
        while parent[x] != top:
            parent[x], x = top, parent[x]
        return top
    for x, y in zip(a, b, strict=True):
        x, y = root(x), root(y)
        if x != y:
            parent[max(x, y)] = min(x, y)
    return [(x, root(x)) for x in parent if root(x) != x]


def _local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = forest(batch.column("a").to_pylist(), batch.column("b").to_pylist())
        yield pa.RecordBatch.from_arrays(
            [pa.array([p[k] for p in pairs], pa.int64()) for k in (0, 1)], ["a", "b"])


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``root``, the least node of its component, for the nodes of edges ``a, b``.

    Every round links each node to the least node that it or a neighbour points to, then follows
    the pointers once more, so that long chains shrink by a factor per round. Batches of edges are
    first thinned to forests. A hub is no hazard: its many rows are aggregated in parts.
    """
    edges = edges.select("a", "b").mapInArrow(_local, "a bigint, b bigint")
    edges = stored(edges.where("a <> b").distinct(), "edges")
    both = edges.unionAll(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    labels = stored(both.groupBy(F.col("a").alias("node")).agg(
        F.least(F.col("node"), F.min("b")).alias("root")), "labels")
    while True:
        near = both.join(labels, both.b == labels.node).select(F.col("a").alias("node"), "root")
        # A root is told of what its followers have found, so that whole trees move at once.
        told = near.join(labels.select("node", F.col("root").alias("_old")), "node").select(
            F.col("_old").alias("node"), "root")
        least = (near.unionAll(told).withColumn("_old", F.lit(None).cast("bigint"))
                 .unionAll(labels.select("node", "root", F.col("root").alias("_old")))
                 .groupBy("node").agg(F.min("root").alias("root"), F.max("_old").alias("_old")))
        up = least.select(F.col("node").alias("root"), F.col("root").alias("_up"))
        following = stored(least.join(up, "root", "left").select(
            "node", F.least("root", "_up").alias("root"),
            (F.least("root", "_up") != F.col("_old")).alias("_moved")), "labels")
        labels = following.select("node", "root")
        if not following.where("_moved").limit(1).count():
            return labels
