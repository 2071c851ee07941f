"""Connected components: contraction of each task's edges, then large-star and small-star rounds."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from tallyframe.plans.lineage import materialize

MOST_ROUNDS = 60
#: A task contracts at most so many edges at a time.
EDGES_IN_TASK = 1 << 20


def least_reached(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The distinct nodes of some edges in order, and the least node that each can reach."""
    nodes, at = np.unique(np.concatenate([a, b]), return_inverse=True)
    a, b, root = at[: len(a)], at[len(a) :], np.arange(len(nodes))
    while True:
        low, high = np.minimum(root[a], root[b]), np.maximum(root[a], root[b])
        apart = low != high
        if not apart.any():
            return nodes, nodes[root]
        # Only roots are linked, to lesser ones; then each node finds its new root.
        np.minimum.at(root, high[apart], low[apart])
        while (root[root] != root).any():
            root = root[root]


def _contract(limit: int):
    """Rows (a, b): the least node that b can reach by edges of one run, b itself if it is that."""

    def contract(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def stars(held: list[pa.RecordBatch]) -> pa.RecordBatch:
            nodes, root = least_reached(*(np.concatenate([b.column(i).to_numpy() for b in held]) for i in (0, 1)))
            return pa.RecordBatch.from_arrays([pa.array(root), pa.array(nodes)], names=["a", "b"])

        held, rows = [], 0
        for batch in batches:
            if held and rows + batch.num_rows > limit:
                yield stars(held)
                held, rows = [], 0
            held.append(batch)
            rows += batch.num_rows
        if held:
            yield stars(held)

    return contract


def _large_star(edges: DataFrame) -> DataFrame:
    """Link each greater neighbour of a node to the least one around the node."""
    both = edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
    least = both.groupBy("a").agg(F.min("b").alias("m"))
    least = least.select("a", F.least("a", "m").alias("m"))
    return both.filter("b > a").join(least, "a").select(F.col("m").alias("a"), "b").filter("a <> b").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Link each node and its lesser neighbours to the least of them."""
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    least = down.groupBy("a").agg(F.min("b").alias("m"))
    moved = down.join(least, "a").select(F.col("m").alias("a"), "b").filter("a <> b")
    return moved.union(least.select(F.col("m").alias("a"), F.col("a").alias("b"))).distinct()


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node that has an edge; root is the least node of its component.

    ``edges`` has bigint columns ``a`` and ``b`` and is read twice. Edges are
    counted and dealt to tasks of ``EDGES_IN_TASK``; each task leaves stars
    around the least nodes that its own edges reach. If one task has them all,
    these are the components. Else rounds go on with the stars: a round never
    gives more rows than it gets, and no neighbourhood is gathered into one
    task: the least neighbour is a sum by key, and the joins can be split where
    a node is hot. Every round is written to the shared folder. When a round
    changes nothing, each component is a star around its root.
    """
    named = edges.select("a", "b").filter("a <> b")
    count = named.count()
    dealt = named.coalesce(max(1, -(-count // EDGES_IN_TASK)))
    now = materialize(dealt.mapInArrow(_contract(EDGES_IN_TASK), "a bigint, b bigint"))
    if count <= EDGES_IN_TASK:
        return now.select(F.col("b").alias("node"), F.col("a").alias("root"))
    now = now.filter("a <> b").distinct()
    mark = None
    for _ in range(MOST_ROUNDS):
        now = materialize(_small_star(_large_star(now)))
        seen = now.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
        if tuple(seen) == mark:
            break
        mark = tuple(seen)
    else:
        raise RuntimeError("components did not settle")
    roots = now.select(F.col("b").alias("node"), F.col("a").alias("root"))
    return roots.union(now.select(F.col("a").alias("node"), F.col("a").alias("root"))).distinct()
