"""Connected components as joins and aggregates (alternating large-star and small-star)."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import cut, written

#: Links that one task joins by itself, after they have been counted; more are joined by rounds of shuffles, with the same result.
SMALL = 1 << 14


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
    return both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    low = down.groupBy("u").agg(F.min("v").alias("m"))
    near = down.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    return near.union(low.select("u", F.col("m").alias("v"))).where("u <> v").distinct()


def roots(u: np.ndarray, v: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Nodes of some links and the smallest node that links reach: labels go to their minimum, by hooking and short cuts."""
    nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
    a, b = at[: len(u)], at[len(u) :]
    root = np.arange(len(nodes))
    while len(a):
        x, y = root[a], root[b]
        np.minimum.at(root, np.maximum(x, y), np.minimum(x, y))
        while (root[root] != root).any():
            root = root[root]
        open_ = root[a] != root[b]
        a, b = a[open_], b[open_]
    return nodes, nodes[root]


def _in_one_task(edges: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        u, v = (np.concatenate([np.zeros(0, np.int64), *x]) for x in zip(*[(b.column(0).to_numpy(), b.column(1).to_numpy()) for b in batches], strict=True)) if (batches := list(batches)) else (np.zeros(0, np.int64),) * 2
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in roots(u, v)], ["node", "component"])

    return edges.select("u", "v").coalesce(1).mapInArrow(run, "node long, component long")


def components(edges: DataFrame, max_rounds: int = 60) -> DataFrame:
    """Edges (u, v: long) to (node, component): the smallest node that links reach.

    Self-links and repeated links are ignored; nulls are dropped; an empty frame gives no rows. A node appears once if it
    has a link to another node. Up to SMALL links are joined in one task. Else each round halves long chains; every round is cut by a reliable
    checkpoint. A hub's links are split by the join, and minima are aggregated before the shuffle."""
    kept = written(edges.where("u is not null and v is not null and u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")), "edges")
    if kept.count() <= SMALL:
        return _in_one_task(kept)
    now = cut(kept.distinct())
    seen = None
    for _ in range(max_rounds):
        now = cut(_small_star(_large_star(now)))
        mark = now.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if mark == seen:
            break
        seen = mark
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    return now.groupBy("u").agg(F.min("v").alias("component")).select(F.col("u").alias("node"), "component").union(now.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct())
