"""Connected components of a distributed table of links."""

from __future__ import annotations

from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lattica.llm.common import written

#: Links that one task contracts in memory.
PER_TASK = 200_000

_SCHEMA = pa.schema([("u", pa.int64()), ("v", pa.int64())])


def _forest(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """A task's links contracted: each node with the least node it reaches through them."""
    parent: dict[int, int] = {}

    def find(x: int) -> int:
        while (p := parent.setdefault(x, x)) != x:
            parent[x] = parent[p]
            x = p
        return x

    for batch in batches:
        for a, b in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
            p, q = find(a), find(b)
            if p != q:
                parent[max(p, q)] = min(p, q)
    pairs = [(x, r) for x in parent if (r := find(x)) != x]
    for at in range(0, len(pairs), 65536):
        part = pairs[at : at + 65536]
        yield pa.RecordBatch.from_arrays([pa.array([x for x, _ in part], pa.int64()), pa.array([r for _, r in part], pa.int64())], schema=_SCHEMA)


def _least(links: DataFrame) -> DataFrame:
    return links.groupBy("u").agg(F.min("v").alias("m"))


def connected(links: DataFrame, name: str) -> DataFrame:
    """(node, label) of every node of ``links`` (a, b): the label is the least node of its component.

    Tasks first contract their share of the links. Unless one share is all,
    two steps then alternate until nothing changes: each node tells its larger
    neighbours of its least neighbour, then each node tells its smaller ones.
    The number of rounds grows with the logarithm of the components' width, and
    no task holds more than a share of a node's neighbours.
    """
    edges = written(links.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), f"{name}-0")
    tasks = -(-edges.count() // PER_TASK) or 1
    edges = written(edges.repartition(tasks).mapInArrow(_forest, "u long, v long"), f"{name}-forest")
    before, n = None, 0
    while tasks > 1:
        n += 1
        both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = both.join(_least(both), "u").where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).where("u <> v").distinct()
        near = large.join(_least(large), "u")
        small = near.where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v")).union(near.select("u", F.col("m").alias("v"))).where("u <> v").distinct()
        edges = written(small, f"{name}-{n}")
        state = edges.agg(F.count("*"), F.sum(F.hash("u", "v").cast("long"))).first()
        if state == before:
            break
        before = state
    return edges.select(F.col("u").alias("node"), F.col("v").alias("label")).union(edges.select("v", "v").distinct())
