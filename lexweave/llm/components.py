"""Connected components of an edge table, by alternating star contraction."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lexweave.storage import materialize

#: Rounds; each about halves the longest path, so no real input comes near.
MOST_ROUNDS = 60
EDGES_PER_TASK = 200_000


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*").alias("n"), F.coalesce(F.bit_xor(F.xxhash64("a", "b")), F.lit(0)).alias("x")).first()
    return row["n"], row["x"]


def _roots(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(node, root) of one task's edges."""
    own = [(b.column("a").to_numpy(), b.column("b").to_numpy()) for b in batches if len(b)]
    if not own:
        return
    nodes, at = np.unique(np.concatenate([x for pair in zip(*own, strict=True) for x in pair]), return_inverse=True)
    parent = list(range(len(nodes)))

    def find(i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    half = len(at) // 2
    for i, j in zip(at[:half].tolist(), at[half:].tolist(), strict=True):
        i, j = find(i), find(j)
        parent[max(i, j)] = min(i, j)
    root = nodes[[find(i) for i in range(len(nodes))]]
    yield pa.RecordBatch.from_arrays([pa.array(nodes, pa.int64()), pa.array(root, pa.int64())], ["node", "root"])


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of all nodes in edges (a, b): root is the component's smallest node.

    Large star: each node's larger neighbours link to its least neighbour; small
    star: its smaller ones do. Both only need the least neighbour of a node,
    an aggregate that is summed up before the shuffle. Each round is a written
    table. Edges that are few enough for one task (EDGES_PER_TASK) are joined up
    there, at the start or once contraction has left so few.
    """
    cur = materialize(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(cur)
    for _ in range(MOST_ROUNDS):
        # a task for each EDGES_PER_TASK edges: few edges aren't dealt to hundreds of files
        tasks = int(-(-state[0] // EDGES_PER_TASK))
        if tasks <= 1:
            return cur.coalesce(1).mapInArrow(_roots, "node long, root long")
        both = cur.unionByName(cur.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("m", "a").alias("m"))
        large = both.join(least, "a").where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(least, "a")
        small = small.select(F.col("b").alias("a"), F.col("m").alias("b")).unionByName(least.select("a", F.col("m").alias("b"))).where("a <> b").distinct()
        cur = materialize(small.coalesce(tasks), "edges")
        new = _state(cur)
        if new == state:
            break
        state = new
    else:
        raise RuntimeError(f"components: not settled after {MOST_ROUNDS} rounds")
    roots = cur.groupBy("a").agg(F.min("b").alias("root")).select(F.col("a").alias("node"), "root")
    return roots.unionByName(roots.select(F.col("root").alias("node"), "root").distinct())
