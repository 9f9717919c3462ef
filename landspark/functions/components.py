"""Connected components of a graph given by edges, by alternating star contractions.

Each round links every node's larger neighbours to its smallest one (large star) and
then its smaller neighbours too (small star), until the edges are stars around the
smallest node of each component; that takes logarithmically many rounds. Edges are
written between rounds, so lost executors cost one round at most. Least neighbours are
written too, so both sides of the join at the centres of stars are plain shuffles, which
adaptive execution splits where a star is large. Nothing but whether it is done reaches the
driver.

Loops and repeated edges are dropped, as are edges with a null end. No edges give an
empty result.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from landspark.sources.shared import Scratch, materialize


def _least(pairs: DataFrame) -> DataFrame:
    """The least of each u and its v, as ``u, m``."""
    return pairs.groupBy("u").agg(F.min("v").alias("m")).select("u", F.least("u", "m").alias("m"))


def _large_star(edges: DataFrame, write: Callable) -> DataFrame:
    both = edges.union(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    # the centre of a large star is one u with many v: with its least neighbour written, its rows can be split
    return both.join(write(_least(both), "least").hint("merge"), "u").filter("v > u").select(F.col("v").alias("u"), F.col("m").alias("v"))


def _small_star(edges: DataFrame) -> DataFrame:
    """Edges have their larger end first; after a large star few have the same one."""
    found = edges.join(_least(edges).hint("merge"), "u")
    own = edges.groupBy("u").agg(F.min("v").alias("v"))
    return found.select(F.col("v").alias("u"), F.col("m").alias("v")).union(own).filter("u != v").distinct()


def _settled(edges: DataFrame) -> bool:
    """Whether the edges are stars: each larger end has one edge and is no one's smaller end."""
    ends = edges.select(F.col("u").alias("node"), F.lit(1).alias("up"), F.lit(0).alias("centre")).union(edges.select("v", F.lit(0), F.lit(1)))
    return ends.groupBy("node").agg(F.sum("up").alias("up"), F.max("centre").alias("centre")).filter("up > 1 OR up = 1 AND centre = 1").isEmpty()


def components(edges: DataFrame, rounds: int = 50) -> DataFrame:
    """``node, component`` of every node with an edge; the component is its least node.

    ``edges`` has two columns of the same orderable type.
    """
    a, b = (F.col(c) for c in edges.columns)
    now = edges.filter(a != b).select(F.greatest(a, b).alias("u"), F.least(a, b).alias("v")).distinct()
    with Scratch(edges.sparkSession) as write:
        now = write(now, "edges")
        for _ in range(rounds):
            if _settled(now):
                return materialize(now.select(F.col("u").alias("node"), F.col("v").alias("component")).union(now.select("v", "v").distinct()), "components")
            now = write(_small_star(_large_star(now, write)), "edges")
    raise RuntimeError(f"components did not settle in {rounds} rounds")
