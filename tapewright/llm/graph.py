"""Connected components of an edge table: in one task while the edges are few, else by alternating large-star and small-star steps.

Nothing goes to the driver but counts.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, land


def _spread(edges: DataFrame, least: DataFrame, copies: int = 8) -> DataFrame:
    """edges joined with least on u; each row of least is copied, so that the edges of a node with many are dealt out."""
    spread = least.withColumn("_copy", F.explode(F.sequence(F.lit(0).cast("bigint"), F.lit(copies - 1).cast("bigint"))))
    return edges.withColumn("_copy", F.pmod(F.xxhash64("v"), F.lit(copies))).join(spread, ["u", "_copy"])


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.union(edges.select("v", "u")).toDF("u", "v")
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return _spread(both.where("v > u"), least).select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    least = down.groupBy("u").agg(F.min("v").alias("m"))
    moved = _spread(down, least).select(F.col("v").alias("u"), F.col("m").alias("v"))
    return moved.where("u <> v").union(least.select("u", F.col("m").alias("v")))


def smallest_reachable(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The nodes of the edges and, for each, the smallest node of its component."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    into = np.arange(len(nodes))
    while True:
        low, high = np.minimum(into[a], into[b]), np.maximum(into[a], into[b])
        if (low == high).all():
            return nodes, nodes[into]
        np.minimum.at(into, high, low)
        while (into[into] != into).any():
            into = into[into]


def _at_once(edges: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        table = pa.Table.from_batches(batches, pa.schema([("u", pa.int64()), ("v", pa.int64())]))
        nodes, least = smallest_reachable(table.column(0).to_numpy(), table.column(1).to_numpy())
        own = nodes != least
        yield pa.RecordBatch.from_arrays([pa.array(nodes[own], pa.int64()), pa.array(least[own], pa.int64())], names=["node", "component"])

    return edges.select("u", "v").repartition(1).mapInArrow(run, "node long, component long")


def components(edges: DataFrame, most_rounds: int = 60, most_at_once: int = 1_000_000) -> DataFrame:
    """(node, component) for every node of an edge (u, v), u <> v, both long, but the smallest of a component; component: the smallest node reachable.

    Up to most_at_once edges (16 bytes each) are joined in one task. Beyond, a round is one large-star and one small-star step, after which the edges are
    written to the shared folder; rounds end when the edges stay the same, and their number grows with the logarithm of the longest path.
    """
    current = land(edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).where("u <> v").distinct(), "edges")
    if current.count() <= most_at_once:
        return _at_once(current)
    mark = None
    for _ in range(most_rounds):
        after = land(_small_star(_large_star(current)).distinct(), "edges")
        discard(current)
        current = after
        now = current.agg(F.count("*").alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if mark == now:
            return current.select(F.col("u").alias("node"), F.col("v").alias("component"))
        mark = now
    raise RuntimeError("components did not settle")
