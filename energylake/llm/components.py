"""Connected components of a distributed edge list."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from energylake.llm.common import staged

NODES = 200_000


class Forest:
    """Keeps of many links a spanning forest."""

    def __init__(self):
        self.parent: dict[int, int] = {}

    def root(self, x: int) -> int:
        parent = self.parent
        while parent.setdefault(x, x) != x:
            parent[x] = x = parent[parent[x]]
        return x

    def add(self, left: np.ndarray, right: np.ndarray) -> list[tuple[int, int]]:
        kept = []
        for a, b in zip(left.tolist(), right.tolist()):
            ra, rb = self.root(a), self.root(b)
            if ra != rb:
                self.parent[max(ra, rb)] = min(ra, rb)
                kept.append((a, b))
        return kept

    def stars(self) -> pa.RecordBatch:
        """Every node that is no root with the least node of its tree."""
        rows = [(x, r) for x in list(self.parent) if (r := self.root(x)) != x]
        return pa.RecordBatch.from_arrays(
            [pa.array([row[k] for row in rows], pa.int64()) for k in (0, 1)], ["u", "v"])


def _contracted(edges: DataFrame, nodes: int = NODES) -> DataFrame:
    """The edges of each task as stars, in forests of about ``nodes`` nodes; what they connect is the same.

    Needs no shuffle; edges that form stars already stay as they are.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        forest = Forest()
        for batch in batches:
            forest.add(batch.column(0).to_numpy(), batch.column(1).to_numpy())
            if len(forest.parent) >= nodes:
                yield forest.stars()
                forest = Forest()
        yield forest.stars()

    return edges.mapInArrow(run, "u long, v long")


def _least(pairs: DataFrame) -> DataFrame:
    """(u, m) of pairs (u, v): m is the least of u and its partners."""
    return pairs.groupBy("u").agg(F.least(F.col("u"), F.min("v")).alias("m"))


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select(F.inline(F.array(F.struct("u", "v"), F.struct(F.col("v").alias("u"), F.col("u").alias("v")))))
    return (both.join(_least(both), "u").filter("v > u and v != m")
            .select(F.col("v").alias("u"), F.col("m").alias("v")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    """Needs u > v, as ``_large_star`` makes them."""
    least = _least(edges)
    moved = edges.join(least, "u").filter("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def _tangled(edges: DataFrame) -> bool:
    """Whether some node has two lesser partners, or one lesser and one greater."""
    ends = edges.select(F.inline(F.array(
        F.struct(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down")),
        F.struct(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down")))))
    nodes = ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down"))
    return nodes.agg(F.max((F.col("up") + F.col("down") > 1) & (F.col("up") > 0))).first()[0] or False


def components(edges: DataFrame) -> DataFrame:
    """(node, root) of every node with an edge; the root is the least node it reaches.

    ``edges`` has long columns u and v in any direction, repeats and loops included.  Each task
    first makes stars of its own edges; then large and small stars alternate until the edges form
    one star per component.  Each round is written to the shared folder, and only whether it is
    the last comes to the driver.
    """
    now = staged(_contracted(edges.filter("u != v").select("u", "v")).distinct(), "edges")
    while _tangled(now):
        now = staged(_small_star(_large_star(_contracted(now))), "edges")
    stars = now.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return stars.unionAll(stars.select(F.col("root").alias("node"), "root")).distinct()
