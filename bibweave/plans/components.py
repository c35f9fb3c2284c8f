"""Connected components by contraction, then by alternating large-star and small-star rounds.

While it leaves at most half of the edges, every node is merged into its smallest neighbour, so later rounds see only
nodes that others were merged into. What remains, such as long paths, is settled by stars after
Kiveris et al., "Connected Components in MapReduce and Beyond" (SoCC 2014): every
round replaces each neighbourhood by a star around its smallest node, so the number of
rounds grows with the logarithm of the longest path. A hub costs one row per
neighbour; its minimum is a partial aggregate and the join that follows can be split
by adaptive execution.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from bibweave.plans.scratch import discard, materialize


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    low = both.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))
    return both.where("v > u").join(low, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    low = edges.groupBy("u").agg(F.min("v").alias("m"))
    moved = edges.join(low, "u").where("v <> m").select(F.col("v").alias("u"), F.col("m").alias("v"))
    turned = moved.select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v"))
    return turned.unionByName(low.select("u", F.col("m").alias("v"))).where("u > v").distinct()


def _hooks(edges: DataFrame) -> DataFrame:
    """``node, parent``: the smallest of every node and its neighbours; a first end is never the smaller one."""
    both = edges.select(F.col("u").alias("node"), "v").unionByName(edges.select(F.col("v").alias("node"), "v"))
    return both.groupBy("node").agg(F.min("v").alias("parent"))


def _contract(edges: DataFrame, hooks: DataFrame) -> DataFrame:
    """Edges between the parents of their ends. A parent that is none of them afterwards is the smallest node of a whole component."""
    a, b = (hooks.select(F.col("node").alias(end), F.col("parent").alias(to)) for end, to in (("u", "a"), ("v", "b")))
    moved = edges.where("u > v").join(a, "u").join(b, "v").where("a <> b")
    return moved.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()


def connected_components(edges: DataFrame, left: str = "u", right: str = "v", max_rounds: int = 60) -> DataFrame:
    """Map every node of ``edges`` to the smallest node that it reaches.

    Returns ``(node, component)`` with one row per node that has an edge. Null ends
    and self loops are ignored, except that a node with only a self loop maps to
    itself; repeated edges and an empty input are fine. A caller that writes the result may
    ``discard`` it then, which deletes the tables that it was read from.
    """
    pairs = edges.select(F.col(left).alias("a"), F.col(right).alias("b")).where("a is not null and b is not null")
    state = materialize(pairs.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    n, levels, halved = state.count(), [], True
    while n and halved:
        hooks = materialize(_hooks(state), "hooks")
        after = materialize(_contract(state, hooks), "edges", rows=n)
        discard(state)
        rest = after.count()
        levels.append(hooks)
        state, halved, n = after, 2 * rest <= n, rest
    for _ in range(max_rounds):
        if not n or _is_stars(state):
            break
        # the stars of the next round are at most as many edges as there are now
        after = materialize(_small_star(_large_star(state)), "edges", rows=2 * n)
        discard(state)
        state = after
    else:
        raise RuntimeError(f"components did not settle in {max_rounds} rounds")
    out = state.select(F.col("u").alias("node"), F.col("v").alias("component"))
    # the smallest node of a component is no first end, so it is not found and stays as it is
    for hooks in reversed(levels):
        found = hooks.join(out.select(F.col("node").alias("parent"), "component"), "parent", "left")
        out = found.select("node", F.coalesce("component", "parent").alias("component"))
    out._bibweave_parts = (state, *levels)
    return out


def _is_stars(state: DataFrame) -> bool:
    """Whether every node has one smaller neighbour at most, and none is between two others."""
    ends = state.select(F.col("u").alias("node"), F.lit(1).alias("down"), F.lit(0).alias("up"))
    ends = ends.unionByName(state.select(F.col("v").alias("node"), F.lit(0).alias("down"), F.lit(1).alias("up")))
    odd = ends.groupBy("node").agg(F.sum("down").alias("down"), F.max("up").alias("up")).where("down > 1 or down + up > 1")
    return odd.isEmpty()
