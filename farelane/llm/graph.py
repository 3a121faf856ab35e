"""Connected components of links between 64-bit ids, by alternating stars."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from farelane.llm.shared import cut


class Forest:
    """Components of the links seen inside one task; it keeps one root per node, never the links."""

    def __init__(self, n: int):
        self.root = np.arange(n, dtype=np.int64)

    def add(self, i: np.ndarray, j: np.ndarray) -> None:
        while len(i):
            a, b = self.root[i], self.root[j]
            low, high = np.minimum(a, b), np.maximum(a, b)
            open_ = low != high
            if not open_.any():
                return
            i, j, low, high = i[open_], j[open_], low[open_], high[open_]
            np.minimum.at(self.root, high, low)
            while True:
                jump = self.root[self.root]
                if (jump == self.root).all():
                    break
                self.root = jump

    def edges(self) -> tuple[np.ndarray, np.ndarray]:
        """Every node that is not a root, and its root: at most one link per node."""
        i = np.flatnonzero(self.root != np.arange(len(self.root)))
        return i, self.root[i]


def _step(edges: DataFrame, both: bool) -> DataFrame:
    """One star operation: the neighbours of a node (the larger ones, or all smaller) move to the least."""
    if both:
        seen = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    else:
        seen = edges
    # kept apart from the join: an aggregate in the same stage would bind a node's links to one task
    least = cut(seen.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m")).select(F.col("u").alias("c"), "m"))
    at = seen.join(least, F.col("u") == F.col("c"))
    if both:
        moved = at.filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        moved = at.select(F.explode(F.array(F.struct(F.col("v").alias("u"), F.col("m").alias("v")), F.struct("u", F.col("m").alias("v")))).alias("e")).select("e.u", "e.v")
    return moved.filter("u <> v").distinct()


def components(edges: DataFrame) -> DataFrame:
    """``edges(u, v)`` of longs -> ``(node, root)``, root the least id reachable.

    Only nodes with a link appear. Null ends and self links are ignored, repeated
    links count once, no links give no rows. Each round is a pair of star
    operations: minima are combined before the shuffle, the join back may be split
    when one node holds many links, and rounds grow with the logarithm of a
    component's length. The state of a round is kept in the shared folder.
    """
    now = cut(
        edges.filter("u IS NOT NULL AND v IS NOT NULL AND u <> v")
        .select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
        .distinct()
    )
    mark = _mark(now)
    while mark[0]:
        after = cut(_step(_step(now, True), False))
        found = _mark(after)
        now = after
        if found == mark:
            break
        mark = found
    return now.select(F.col("u").alias("node"), F.col("v").alias("root")).unionByName(
        now.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct()
    )


def _mark(edges: DataFrame) -> tuple:
    """Count and sum of hashes: two states that agree in both hold the same links."""
    row = edges.agg(
        F.count("*"),
        F.coalesce(F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")), F.lit(0)),
        F.coalesce(F.sum(F.hash("v", "u").cast("decimal(38,0)")), F.lit(0)),
    ).first()
    return tuple(row)
