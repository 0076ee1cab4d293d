"""Graph operators: connected components by alternating star contraction."""

from __future__ import annotations

import itertools

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import materialize


def _star(edges: DataFrame, large: bool) -> DataFrame:
    """One star step over edges (u, v) with u > v."""
    if large:
        both = edges.select("u", "v").union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        out = both.where("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v"))
    else:
        least = edges.groupBy("u").agg(F.min("v").alias("m"))
        out = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).union(least.select("u", F.col("m").alias("v")))
    return out.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether each upper end has one edge and is no lower end: then lower ends are the components."""
    ends = edges.select(F.col("u").alias("k"), F.lit(1).alias("up"), F.lit(0).alias("low")).union(edges.select("v", F.lit(0), F.lit(1)))
    return not ends.groupBy("k").agg(F.sum("up").alias("up"), F.max("low").alias("low")).where("up > 1 or up = 1 and low = 1").limit(1).count()


def _solve(batches):
    """Components of edges that fit one task: smallest labels along edges, then jumps to the label's label."""
    frames = list(batches)
    if not frames:
        return
    ends = pa.Table.from_batches(frames).combine_chunks()
    names, at = np.unique(np.concatenate([ends.column(c).to_numpy() for c in ("u", "v")]), return_inverse=True)
    u, v = at[: len(ends)], at[len(ends) :]
    label = np.arange(len(names))
    while True:
        low = np.minimum(label[u], label[v])
        new = label.copy()
        np.minimum.at(new, u, low)
        np.minimum.at(new, v, low)
        np.minimum.at(new, label[u], low)
        np.minimum.at(new, label[v], low)
        new = new[new]
        if (new == label).all():
            break
        label = new
    yield pa.RecordBatch.from_arrays([pa.array(names), pa.array(names[label])], ["node", "component"])


def _forests(size: int):
    """Edges to (u, v) of each node and the smallest one that so many edges of its task lead to: as connected, at most one edge a node."""

    def run(batches):
        held, rows = [], 0
        for batch in itertools.chain(batches, [None]):
            if batch is not None:
                held.append(batch)
                rows += len(batch)
            if held and (batch is None or rows >= size):
                for found in _solve(held):
                    kept = found.filter(pc.not_equal(found.column(0), found.column(1)))
                    yield pa.RecordBatch.from_arrays(kept.columns, ["u", "v"])
                held, rows = [], 0

    return run


def connected_components(edges: DataFrame, src: str = "src", dst: str = "dst", max_rounds: int = 60, one_task: int = 1_000_000) -> DataFrame:
    """(node, component) of every node on an edge; the component is its smallest node.

    Alternates large-star and small-star steps until the edges are stars around their smallest
    node.  The work of a round is in proportion to the edges, a hub needs no row that holds its
    neighbours, and each round is a written table, so lost executors cost one round at most.
    Up to ``one_task`` edges (counted first) are solved in one task instead, which saves the rounds.  More are
    solved so many at a time before, as long as that leaves half of them at most: an edge a node stays of each part.
    Null ends and self-loops: a node with only a self-loop is its own component, nulls are left out.
    """
    pairs = edges.select(F.col(src).alias("a"), F.col(dst).alias("b")).where("a is not null and b is not null")
    now = materialize(pairs.where("a <> b").select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    loops = pairs.where("a = b").select(F.col("a").alias("node"))
    kind = now.schema["u"].dataType.simpleString()
    n = now.count()
    while n > one_task > 0:
        before = n
        now = materialize(now.coalesce(-(-n // one_task)).mapInArrow(_forests(one_task), f"u {kind}, v {kind}"), "forests")
        n = now.count()
        if 2 * n > before:
            break
    if n <= one_task:
        found = materialize(now.coalesce(1).mapInArrow(_solve, f"node {kind}, component {kind}"), "components")
        return found.union(loops.distinct().join(found, "node", "left_anti").select("node", F.col("node").alias("component")))
    for _ in range(max_rounds):
        if _stars(now):
            break
        now = materialize(_star(_star(now, True), False), "star")
    else:
        raise RuntimeError(f"no fixed point after {max_rounds} rounds")
    named = now.select(F.col("u").alias("node"), F.col("v").alias("component"))
    roots = now.select("v").distinct().select(F.col("v").alias("node"), F.col("v").alias("component"))
    found = named.union(roots)
    return found.union(loops.distinct().join(found, "node", "left_anti").select("node", F.col("node").alias("component")))
