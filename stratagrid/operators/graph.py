"""Pointer and component loops on distributed tables.

The loops run on graphs between raster blocks, which are smaller than the raster by about
the block size.  Each round is one written table; hot targets are salted (``lookup``) or
folded by partial aggregation.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from stratagrid.scratch import Rounds, lookup

HOPS = 4  # table lookups per written round: each round multiplies the reach by up to five


def resolve(pointers: DataFrame, rounds: Rounds) -> DataFrame:
    """Follow an acyclic ``(node, root, ...)`` pointer table to the end of every chain.

    Other columns stay on their rows.  A row whose root is an end is closed and is looked up no more:
    nearly all chains may end at one node.  All lookups of a round read the same right side, so its
    exchange is built once.
    """
    kept = [c for c in pointers.columns if c not in ("node", "root")]
    current = rounds.put("pointer", pointers.select(
        "node", "root", *kept, (F.col("node") != F.col("root")).alias("open")), watch="open")
    while rounds.seen:
        moving = current.filter(F.col("node") != F.col("root")).select(
            F.col("node").alias("root"), F.col("root").alias("further")
        )
        step = current.filter("open").select("node", "root", *kept)
        for _ in range(HOPS):
            step = lookup(step, moving, "root", "node", "left").select(
                "node", F.coalesce("further", "root").alias("root"), *kept,
                F.col("further").isNotNull().alias("open"),
            )
        current = rounds.put("pointer", step.union(current.filter("not open")), watch="open")
        rounds.sweep()
    return current.select("node", "root", *kept)


def connect(edges: DataFrame, rounds: Rounds) -> DataFrame:
    """``(node, root)`` for every node of an undirected ``(a, b)`` edge table; root = least node.

    Every round hooks each node to its least neighbour, follows the hooks, and contracts the
    edges, so the edge table shrinks round by round.
    """
    live = rounds.put("edge", edges.select("a", "b").filter("a <> b").distinct())
    contractions = []
    while rounds.seen:
        both = live.union(live.select(F.col("b").alias("a"), F.col("a").alias("b")))
        hooks = both.groupBy("a").agg(F.min("b").alias("b")).select(
            F.col("a").alias("node"), F.least("a", "b").alias("root")
        )
        contractions.append(resolve(hooks, rounds))
        rounds.keep("pointer")
        live = rounds.put("edge", _contract(live, contractions[-1]).select("a", "b").distinct())
        rounds.sweep()
    if not contractions:
        return live.select(F.col("a").alias("node"), F.col("b").alias("root"))
    # compose from the last, smallest round back to the first: the work adds up to little
    # more than one pass over the nodes
    members = contractions.pop()
    while contractions:
        upper = members.select(F.col("node").alias("root"), F.col("root").alias("upper"))
        members = lookup(contractions.pop(), upper, "root", "node", "left").select(
            "node", F.coalesce("upper", "root").alias("root")
        )
    return members


def _contract(edges: DataFrame, roots: DataFrame) -> DataFrame:
    """Replace both ends of the edges by their roots and drop the loops; keeps other columns."""
    for end, other in (("a", "b"), ("b", "a")):
        named = roots.select(F.col("node").alias(end), F.col("root").alias("_r"))
        edges = lookup(edges, named, end, other, "left").withColumn(
            end, F.coalesce("_r", end)
        ).drop("_r")
    return edges.filter("a <> b")


def spill_levels(edges: DataFrame, outside: int, rounds: Rounds) -> DataFrame:
    """Lowest level at which each node of a weighted graph connects to ``outside``.

    ``edges`` is undirected ``(a, b, w)``.  Contraction along lowest edges: a component's
    level is the greatest of the lowest-edge weights it met on its way, and the number of
    components at least halves each round.
    """
    live = rounds.put("edge", _least_edges(edges))
    contractions = []
    while rounds.seen:
        both = live.select("a", "b", "w").union(
            live.select(F.col("b").alias("a"), F.col("a").alias("b"), "w")
        ).filter(F.col("a") != F.lit(outside))
        picks = both.groupBy("a").agg(
            F.min(F.struct("w", F.least("a", "b").alias("lo"), F.greatest("a", "b").alias("hi"))).alias("e")
        ).select(
            F.col("a").alias("node"), F.col("e.w").alias("w"),
            (F.col("e.lo") + F.col("e.hi") - F.col("a")).alias("to"),
        )
        # two nodes that pick each other: the lesser one is the root of their component
        back = picks.select(F.col("node").alias("to"), F.col("to").alias("node"), F.lit(True).alias("mutual"))
        hooks = picks.join(back, ["node", "to"], "left").select(
            "node",
            F.when(F.col("mutual") & (F.col("node") < F.col("to")), F.col("node"))
            .otherwise(F.col("to")).alias("root"),
            "w",
        )
        contractions.append(resolve(hooks, rounds))
        rounds.keep("pointer")
        live = rounds.put("edge", _least_edges(_contract(live, contractions[-1])))
        rounds.sweep()
    if not contractions:
        return live.select(F.col("a").alias("node"), F.col("w").alias("level"))
    levels = contractions.pop().select("node", F.col("w").alias("level"))
    while contractions:
        upper = levels.select(F.col("node").alias("root"), "level")
        levels = lookup(contractions.pop(), upper, "root", "node", "left").select(
            "node", F.greatest("w", "level").alias("level")
        )
    return levels


def _least_edges(edges: DataFrame) -> DataFrame:
    return edges.groupBy(
        F.least("a", "b").alias("a1"), F.greatest("a", "b").alias("b1")
    ).agg(F.min("w").alias("w")).select(F.col("a1").alias("a"), F.col("b1").alias("b"), "w")


def subtree_sums(nodes: DataFrame, rounds: Rounds) -> DataFrame:
    """``(node, total)``: weights summed over all nodes that lead to a node, itself included.

    ``nodes`` is ``(node, next, weight)`` with a null ``next`` at the end of a chain.  Pointer
    doubling: every round adds the totals that point here and doubles the reach.
    """
    current = rounds.put(
        "flow", nodes.select("node", "next", F.col("weight").alias("total")), "next is not null"
    )
    while rounds.seen:
        moving = current.filter(F.col("next").isNotNull())
        inflow = moving.groupBy(F.col("next").alias("node")).agg(F.sum("total").alias("inflow"))
        further = current.select(F.col("node").alias("next"), F.col("next").alias("further"))
        ends = current.filter(F.col("next").isNull()).withColumn("further", F.lit(None).cast("long"))
        jumped = lookup(moving, further, "next", "node", "left").select(
            "node", "next", "total", "further"
        ).union(ends.select("node", "next", "total", "further"))
        current = rounds.put("flow", jumped.join(inflow, "node", "left").select(
            "node", F.col("further").alias("next"),
            (F.col("total") + F.coalesce("inflow", F.lit(0))).alias("total"),
        ), "next is not null")
        rounds.sweep()
    return current.select("node", "total")
