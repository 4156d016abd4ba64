"""Connected components of a graph given as an edge table."""

from __future__ import annotations

from collections.abc import Iterable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from wavelens.llm.common import arrow_map
from wavelens.session import stored


#: Edges that one task may hold at once.
LOCAL_EDGES = 1 << 20


def components(edges: DataFrame, first: str = "a", second: str = "b", local: int = LOCAL_EDGES) -> DataFrame:
    """``(node, component)`` for every node of an edge; the component is its smallest node.

    Tasks first contract what they read, ``local`` edges at a time, to stars around the
    smallest node they know. Then every round points the larger neighbours of a node at
    the smallest one, then the smaller ones, until all edges are stars around the
    smallest node of all. Each half is an aggregate and a join on the same key; every
    round is written to the shared folder, so a lost executor costs one round at most.
    As soon as no more than ``local`` edges are left, one task does the rest.
    """
    pairs = edges.select(F.col(first).alias("u"), F.col(second).alias("v")).filter("u <> v")
    pairs = stored(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "edges")
    before = None
    while True:
        after = _fingerprint(pairs)
        if after[0] <= local:
            return _contracted(pairs.coalesce(1), local, roots=True).toDF("node", "component")
        if after == before:
            break
        before = after
        pairs = stored(_small_star(_large_star(_contracted(pairs, local))), "edges")
    return _stars(pairs)


def components_by_joins(edges: DataFrame, first: str = "a", second: str = "b") -> DataFrame:
    """As ``components``, by its rounds alone: aggregates and joins, no Python in the tasks."""
    pairs = edges.select(F.col(first).alias("u"), F.col(second).alias("v")).filter("u <> v")
    pairs = stored(pairs.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct(), "edges")
    before, after = None, _fingerprint(pairs)
    while after != before:
        pairs = stored(_small_star(_large_star(pairs)), "edges")
        before, after = after, _fingerprint(pairs)
    return _stars(pairs)


def _stars(pairs: DataFrame) -> DataFrame:
    """``(node, component)`` of edges that are stars around the smallest nodes."""
    star = pairs.groupBy("u").agg(F.min("v").alias("v"))
    roots = pairs.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    return star.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots)


def _contracted(pairs: DataFrame, local: int, roots: bool = False) -> DataFrame:
    """Edges as stars around the smallest node that the task sees together with them.

    With ``roots``, the smallest nodes point at themselves.
    """

    def run(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) > local:
                yield _star(held, roots)
                held = []
        if held:
            yield _star(held, roots)

    return arrow_map(pairs, run, "u long, v long")


def _star(batches: list[pa.RecordBatch], roots: bool) -> pa.RecordBatch:
    u, v = (np.concatenate([np.asarray(b.column(i)) for b in batches]) for i in range(2))
    nodes, index = np.unique(np.concatenate([u, v]), return_inverse=True)
    forest = Forest(len(nodes))
    for i, j in zip(index[: len(u)].tolist(), index[len(u) :].tolist(), strict=True):
        forest.join(i, j)
    found = nodes[forest.labels()] if len(nodes) else nodes
    keep = slice(None) if roots else found != nodes
    return pa.RecordBatch.from_arrays([pa.array(nodes[keep], pa.int64()), pa.array(found[keep], pa.int64())], ["u", "v"])


def _fingerprint(pairs: DataFrame) -> tuple:
    row = pairs.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).collect()[0]
    return tuple(row)


def _large_star(pairs: DataFrame) -> DataFrame:
    both = pairs.unionByName(pairs.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.min("v").alias("m")).withColumn("m", F.least("m", "u"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(pairs: DataFrame) -> DataFrame:
    least = pairs.groupBy("u").agg(F.min("v").alias("m"))
    moved = pairs.join(least, "u").filter("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionByName(least.select("u", F.col("m").alias("v"))).distinct()


class Forest:
    """Union and find over ``n`` local nodes; keeps the edges that joined two trees."""

    def __init__(self, n: int):
        self.up = list(range(n))
        self.edges: list[tuple[int, int]] = []

    def find(self, i: int) -> int:
        up = self.up
        while up[i] != i:
            up[i] = up[up[i]]
            i = up[i]
        return i

    def join(self, i: int, j: int) -> bool:
        a, b = self.find(i), self.find(j)
        if a == b:
            return False
        self.up[max(a, b)] = min(a, b)
        self.edges.append((i, j))
        return True

    def labels(self) -> np.ndarray:
        return np.array([self.find(i) for i in range(len(self.up))])
