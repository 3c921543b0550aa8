"""Connected components of an edge list by contraction and alternating large and small stars.

Every task first contracts the edges that it has: of each part that they connect only a star
around its least node stays, at most one edge a node.  While more than ``FINISH`` edges
are left they go through rounds of large and small stars in Spark, contracted before they
are written; as many as that, 16 bytes each, are settled by one task.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from rollbook.llm.storage import written

#: Edges that are contracted at once.
FINISH = 1 << 20


def united(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the edges, and the least node that each is connected with."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    label = np.arange(len(nodes))
    while True:
        low, high = np.minimum(label[a], label[b]), np.maximum(label[a], label[b])
        if (open_ := low != high).any():
            np.minimum.at(label, high[open_], low[open_])
            a, b = a[open_], b[open_]
        else:
            return nodes, nodes[label]
        while (further := label[label]).tolist() != label.tolist():
            label = further


def _contracted(edges: DataFrame, limit: int, roots: bool = False) -> DataFrame:
    """Stars (u, v) around the least nodes of what up to ``limit`` edges of a task connect; with ``roots`` these too."""

    def work(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[np.ndarray, np.ndarray]] = []

        def stars() -> pa.RecordBatch:
            nodes, least = united(*(np.concatenate(x) for x in zip(*held, strict=True)))
            held.clear()
            kept = np.ones(len(nodes), dtype=bool) if roots else nodes != least
            return pa.RecordBatch.from_arrays([pa.array(nodes[kept]), pa.array(least[kept])], names=["u", "v"])

        rows = 0
        for batch in batches:
            for at in range(0, batch.num_rows, limit):
                u, v = (batch.column(c).slice(at, limit).to_numpy() for c in ("u", "v"))
                if rows + len(u) > limit and held:
                    yield stars()
                    rows = 0
                held.append((u, v))
                rows += len(u)
        if held:
            yield stars()

    return edges.select(F.col("u").cast("long"), F.col("v").cast("long")).mapInArrow(work, "u long, v long")


def _with_least(edges: DataFrame) -> DataFrame:
    """Edges u, v with ``m``, the least of u and its neighbours.

    The minimum is combined before it is shuffled and joined back, so a node with very
    many edges is split by adaptive execution instead of meeting in one window.
    """
    least = edges.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))
    return edges.join(least, "u")


def _stars(edges: DataFrame) -> bool:
    """Whether every node is a centre or has one edge to a centre; edges lead to lesser nodes."""
    ends = edges.select(F.col("u").alias("node"), F.col("v").alias("to"))
    heads = edges.select(F.col("v").alias("node"), F.lit(None).cast("long").alias("to"))
    nodes = ends.unionAll(heads).groupBy("node").agg(F.min("to").alias("lo"), F.max("to").alias("hi"), F.count_if(F.col("to").isNull()).alias("in"))
    return nodes.filter("lo < hi OR (lo IS NOT NULL AND in > 0)").isEmpty()


def components(edges: DataFrame, finish: int = FINISH) -> DataFrame:
    """(node, component): every node of an edge u, v and the least node that it is connected with.

    Nodes are longs.  Each round is written, so no lineage grows.  Loops and repeated edges change nothing.
    """
    now = written(_contracted(edges.filter("u <> v"), finish), "edges")
    while now.count() > finish:
        if _stars(now):
            roots = now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
            return now.distinct().select(F.col("u").alias("node"), F.col("v").alias("component")).unionAll(roots)
        both = now.unionAll(now.select(F.col("v").alias("u"), F.col("u").alias("v")))
        large = _with_least(both).filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
        near = _with_least(large.filter("u <> v"))
        small = near.select(F.col("v").alias("u"), F.col("m").alias("v")).unionAll(near.select("u", F.col("m").alias("v")))
        now = written(_contracted(small.filter("u <> v"), finish), "edges")
    return written(_contracted(now.coalesce(1), finish, roots=True), "components").toDF("node", "component")
