"""Connected components of a graph, as joins and aggregates."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import staged

ROUNDS = 60


def _both_ways(edges: DataFrame) -> DataFrame:
    return edges.select(F.col("a").alias("u"), F.col("b").alias("v")).union(edges.select(F.col("b").alias("u"), F.col("a").alias("v")))


def components(edges: DataFrame) -> DataFrame:
    """(``node``, ``root``) for every node of the edges (``a``, ``b``: long), ``root`` the least node it reaches.

    Stars alternate: every node hangs its larger neighbours, then its smaller ones, under the least of
    them, until only stars around roots are left. A node's neighbours are never gathered: the least of them is
    an aggregate that is joined back. Each round is a stored table, so lost executors cost no more than one.
    """
    now = staged(edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).filter("a <> b").distinct(), "edges")
    for _ in range(ROUNDS):
        # Stars around roots: every node hangs once, and nothing hangs under a node that hangs itself.
        hung = now.groupBy("a").agg(F.count("*").alias("n"))
        again = hung.filter("n > 1").select("a").union(hung.join(now.select(F.col("b").alias("a")), "a", "left_semi").select("a"))
        if not again.limit(1).count():
            break
        both = _both_ways(now)
        least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
        large = both.join(least, "u").filter(F.col("v") > F.col("u")).select(F.col("v").alias("a"), F.col("m").alias("b")).distinct()
        # All edges now go from larger to smaller; hang each node's smaller neighbours under the least.
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        now = staged(small.union(low.select("a", F.col("m").alias("b"))).distinct(), "edges")
    else:
        raise RuntimeError(f"no fixed point after {ROUNDS} rounds")
    roots = now.groupBy("b").agg(F.lit(1)).select(F.col("b").alias("node"), F.col("b").alias("root"))
    return now.select(F.col("a").alias("node"), F.col("b").alias("root")).union(roots)
