"""Connected components by contraction, in DataFrame operations."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from funnelwright.llm.common import Scratch


def components(edges: DataFrame, scratch: Scratch, name: str = "graph") -> DataFrame:
    """(``node``, ``component``) for each node of ``edges`` (``src``, ``dst``): the smallest node reachable.

    Each round, every node moves to the first node among itself and its neighbours, twice, and edges whose ends met
    go. "First" is by number in even rounds, which collapses a star around its smallest node at once, and by a hash
    that differs per round in odd rounds, which shrinks any graph, chains too, by a constant factor on average. So
    the rounds are logarithmic in the number of nodes. Neighbours are combined in the map tasks before they move, so a
    node may have any number of them. Loops and NULL ends are left out; no edges give no rows.
    """
    left = scratch.store(
        edges.filter("src != dst").select(F.least("src", "dst").alias("u"), F.greatest("src", "dst").alias("v")).distinct(),
        f"{name}-edges-0",
    )
    ends = left.select(F.col("u").alias("node")).union(left.select("v")).distinct()
    roots = scratch.store(ends.withColumn("root", F.col("node")), f"{name}-roots-0")
    turn = 0
    while not left.isEmpty():
        first = (lambda c: F.col(c)) if turn % 2 == 0 else (lambda c, t=turn: F.xxhash64(F.lit(t), F.col(c)))
        ways = left.union(left.select("v", "u"))
        near = ways.groupBy("u").agg(F.min(F.struct(first("v").alias("k"), F.col("v").alias("x"))).alias("near"))
        step = near.select(
            F.col("u").alias("at"),
            F.least("near", F.struct(first("u").alias("k"), F.col("u").alias("x")))["x"].alias("to"),
        )
        step = scratch.store(step, f"{name}-step-{turn}")
        again = step.select(F.col("at").alias("to"), F.col("to").alias("far"))
        move = scratch.store(step.join(again, "to").select("at", F.col("far").alias("to")), f"{name}-move-{turn}")
        tail = move.select(F.col("at").alias("u"), F.col("to").alias("u2"))
        head = move.select(F.col("at").alias("v"), F.col("to").alias("v2"))
        moved = left.join(tail, "u").join(head, "v").filter("u2 != v2")
        moved = moved.select(F.least("u2", "v2").alias("u"), F.greatest("u2", "v2").alias("v")).distinct()
        now = move.select(F.col("at").alias("root"), "to")
        shifted = roots.join(now, "root", "left").select("node", F.coalesce("to", "root").alias("root"))
        left = scratch.store(moved, f"{name}-edges-{turn + 1}")
        roots = scratch.store(shifted, f"{name}-roots-{turn + 1}")
        for table in ("edges", "roots", "step", "move"):
            scratch.drop(f"{name}-{table}-{turn}")
        turn += 1
    smallest = roots.groupBy("root").agg(F.min("node").alias("component"))
    return roots.join(smallest, "root").select("node", "component")
