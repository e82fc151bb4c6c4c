"""Connected components over an edge table of long ids.

Every round has two parts.  Each task first joins up the edges it has (a
minimum spread over its edges with pointer jumping, in numpy) and hands on one
edge per node, to the smallest node of its group; edges are dealt evenly by a
hash of both ends, so no node gathers its edges in one task, and a task gets
about EDGES_PER_TASK of them.  If that is one task, its answer is the answer.
Otherwise the edges of each node are turned into a star around the smallest node it knows, first over
all neighbours, then over the smaller ones, and the next round begins.  The
rounds end when the edge table no longer changes, after a number of rounds
logarithmic in the longest chain.

Edge tables are checkpointed in the shared folder.  So are the minima before
they are joined back: both inputs of the join are then plain exchanges, and
adaptive execution can split a node that has very many edges.
"""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from quarry.session import cut_lineage

#: Edges joined up in one task (about 50 bytes each there).
EDGES_PER_TASK = 500_000


def joined(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """For every node of the edges but the smallest of each group: the node, and that smallest."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at.ravel()[: len(u)], at.ravel()[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low = np.minimum(label[a], label[b])
        now = label.copy()
        np.minimum.at(now, label[a], low)  # hook the roots seen so far
        np.minimum.at(now, label[b], low)
        while not np.array_equal(jump := now[now], now):
            now = jump
        if np.array_equal(now, label):
            break
        label = now
    own = np.flatnonzero(label != np.arange(len(nodes)))
    return nodes[own], nodes[label[own]]


def _local(batches):
    held = [(np.asarray(b.column("u")), np.asarray(b.column("v"))) for b in batches if len(b)]
    if held:
        u, v = joined(*(np.concatenate(x) for x in zip(*held, strict=True)))
        yield pa.RecordBatch.from_arrays([pa.array(u), pa.array(v)], ["u", "v"])


def _star(edges: DataFrame) -> DataFrame:
    """Each (u, v) with the smallest v of its u as m."""
    least = cut_lineage(edges.groupBy("u").agg(F.min("v").alias("m")))
    return edges.join(least, "u")


def connected_components(edges: DataFrame, a: str = "a", b: str = "b") -> DataFrame:
    """(node, root) for every node with an edge to another node.

    root is the smallest node of the component.  Nulls and self edges are
    ignored; repeated edges count once; an empty table gives no rows.
    """
    edges = edges.where(F.col(a).isNotNull() & F.col(b).isNotNull())
    e = edges.select(F.greatest(a, b).cast("long").alias("u"), F.least(a, b).cast("long").alias("v")).where("u != v").distinct()
    seen = None
    while True:
        e = cut_lineage(e)
        tasks = -(-e.count() // EDGES_PER_TASK)
        e = cut_lineage(e.coalesce(max(1, tasks)).mapInArrow(_local, "u long, v long"))
        if tasks <= 1:
            break
        now = e.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if seen == now:
            break
        seen = now
        both = e.union(e.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _star(both).where("v > u").select(F.col("v").alias("u"), F.least("m", "u").alias("v")).distinct()
        small = _star(cut_lineage(large))
        e = (small.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
             .union(small.select("u", F.col("m").alias("v"))).distinct())
    star = e.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return star.union(e.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
