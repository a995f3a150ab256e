"""Connected components of a graph held in tables."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import written

#: Rounds after which an error is raised; each about halves the longest path.
ROUNDS = 100
#: Edges that a task contracts at once.
EDGES = 1 << 20


def stars(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of these edges that are not the smallest of their component, and the smallest of it."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    x, y = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while (root[x] != root[y]).any():
        ends = root[x], root[y]
        np.minimum.at(root, np.maximum(*ends), np.minimum(*ends))
        while (root[root] != root).any():
            root = root[root]
    moved = root != np.arange(len(nodes))
    return nodes[moved], nodes[root[moved]]


def contracted(edges: DataFrame) -> DataFrame:
    """Edges (``u`` > ``v``) of the same components, in which the edges of one block of a task form stars."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []

        def close() -> pa.RecordBatch:
            block = pa.Table.from_batches(held)
            held.clear()
            return pa.RecordBatch.from_arrays([pa.array(k) for k in stars(block["u"].to_numpy(), block["v"].to_numpy())], names=["u", "v"])

        for batch in batches:
            held.append(batch)
            if sum(b.num_rows for b in held) >= EDGES:
                yield close()
        if held:
            yield close()

    return edges.mapInArrow(run, "u long, v long")


def settled(links: DataFrame) -> bool:
    """Whether every node has one smaller neighbour or only larger ones."""
    ends = links.selectExpr("u AS node", "v AS below").unionByName(links.selectExpr("v AS node", "NULL AS below"))
    found = ends.groupBy("node").agg(F.min("below").alias("low"), F.max("below").alias("high"), F.max(F.isnull("below")).alias("root"))
    return found.where("low < high or (low is not null and root)").isEmpty()


def components(edges: DataFrame) -> DataFrame:
    """``node`` and ``component`` (the smallest node reachable) of every node of ``edges`` (columns ``a``, ``b``).

    Alternates large-star and small-star steps, each a group-by whose rows stay in proportion to the edges, until only
    stars are left; before the first and after each, tasks contract the edges that they hold. Edges are written in every
    round, so a lost executor costs one round. Nodes without an edge are not returned; edges with a null end or between
    the same node are left out.
    """
    pairs = edges.select(F.col("a").cast("long").alias("u"), F.col("b").cast("long").alias("v")).where("u is not null and v is not null and u != v")
    links = written(contracted(pairs), "components")
    for _ in range(ROUNDS):
        if settled(links):
            break
        both = links.unionByName(links.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
        down = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        least = down.groupBy("u").agg(F.min("v").alias("m"))
        small = down.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v")
        links = written(contracted(small.unionByName(least.select("u", F.col("m").alias("v")))), "components")
    else:
        raise RuntimeError(f"components did not settle in {ROUNDS} rounds")
    return links.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(links.select(F.col("v").alias("node"), F.col("v").alias("component"))).distinct()
