"""Connected components by alternating large-star and small-star steps, each step written to a scratch table. Tasks join
what links they hold before they write them, so that few steps are left to the cluster."""

from __future__ import annotations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import Scratch, narrowed

HELD = 1 << 20  # links that a task joins at a time


def local_roots(n: int, u: np.ndarray, v: np.ndarray) -> np.ndarray:
    """For nodes 0..n-1 and links u-v: the smallest node of each one's component."""
    root = np.arange(n)
    while len(u):
        low = np.minimum(root[u], root[v])
        before = root.copy()
        np.minimum.at(root, root[u], low)
        np.minimum.at(root, root[v], low)
        while not np.array_equal(up := root[root], root):
            root = up
        if np.array_equal(before, root):
            break
        far = root[u] != root[v]
        u, v = u[far], v[far]
    return root


def folded(links: DataFrame, held: int = HELD) -> DataFrame:
    """links(u, v) as stars of what each task has at hand: every node with the least one that so many links lead it to. The
    components are the same, and no node's least neighbour grows, so the steps between which this is done end as before."""

    def star(batches: list) -> pa.RecordBatch:
        u, v = (np.concatenate([b.column(i).to_numpy() for b in batches]) for i in (0, 1))
        nodes, at = np.unique(np.concatenate([u, v]), return_inverse=True)
        root = local_roots(len(nodes), at[: len(u)], at[len(u) :])
        told = root != np.arange(len(nodes))
        return pa.RecordBatch.from_arrays([pa.array(nodes[told]), pa.array(nodes[root[told]])], names=["u", "v"])

    def run(batches):
        own, n = [], 0
        for b in batches:
            own.append(b)
            n += len(b)
            if n >= held:
                yield star(own)
                own, n = [], 0
        if own:
            yield star(own)

    return links.select("u", "v").mapInArrow(run, "u long, v long")


def _star(e: DataFrame, scratch: Scratch, name: str, large: bool, rows: int) -> DataFrame:
    """One step over about so many links. The least neighbour of every node is written first, so that both sides of the join
    that follows are plain exchanges, which adaptive execution can split where one node has very many links."""
    both = e.unionByName(e.select(F.col("v").alias("u"), F.col("u").alias("v"))) if large else e
    least = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    least = scratch.table(narrowed(least, rows), f"{name}-min")
    met = narrowed(both.join(scratch.shuffled(least), "u"), 2 * rows)
    if large:
        out = met.where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        out = met.where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(least.select("u", F.col("m").alias("v")))
    out = narrowed(out.where("u != v").distinct(), rows)
    out = scratch.table(out if large else folded(out), name)
    scratch.forget(f"{name}-min")
    return out


def _open(e: DataFrame, rows: int | None) -> tuple[int, int]:
    """How many links, and how many nodes that keep them from being stars around the least of each component: with more than
    one link up, or with links up and down."""
    up = e.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("down"))
    down = e.select(F.col("v").alias("node"), F.lit(0).alias("up"), F.lit(1).alias("down"))
    nodes = narrowed(up.unionByName(down).groupBy("node").agg(F.sum("up").alias("up"), F.max("down").alias("down")), rows)
    return nodes.agg(F.coalesce(F.sum("up"), F.lit(0)), F.count_if((F.col("up") > 1) | ((F.col("up") > 0) & (F.col("down") > 0)))).first()


def components(links: DataFrame, scratch: Scratch, name: str = "cc", most: int = 200, rows: int | None = None) -> DataFrame:
    """links(u, v): undirected, of longs; rows: about how many, if that is known. Returns (node, root) for every node that is
    not the least of its component."""
    # the number of rounds grows with the logarithm of the nodes; one that has not ended by then is a fault, and is told
    e = links.where("u != v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
    e, last = scratch.table(folded(narrowed(e, rows)), f"{name}-0"), f"{name}-0"
    for i in range(1, most + 1):
        n, left = _open(e, rows)
        if not n or (i > 1 and not left):
            break
        rows = n
        e = _star(_star(e, scratch, f"{name}-{i}l", True, rows), scratch, f"{name}-{i}s", False, rows)
        scratch.forget(last, f"{name}-{i}l")
        last = f"{name}-{i}s"
    else:
        raise RuntimeError(f"components have not converged in {most} rounds")
    return e.select(F.col("u").alias("node"), F.col("v").alias("root"))
