"""Connected components by alternating large-star and small-star rounds.

Every round is a grouped minimum (combined map-side) and one equi-join, its
result is written to the shared folder, and only two numbers per round reach
the driver. The number of rounds grows with the logarithm of the longest path.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from reelrank.llm.common import materialise

MAX_ROUNDS = 64


def _both(edges: DataFrame) -> DataFrame:
    return edges.union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))


def _large_star(edges: DataFrame) -> DataFrame:
    sym = _both(edges)
    low = sym.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
    return (sym.join(low, "a").filter("b > a and b <> m")
            .select(F.col("b").alias("a"), F.col("m").alias("b")).distinct())


def _small_star(edges: DataFrame) -> DataFrame:
    down = edges.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
    low = down.groupBy("a").agg(F.min("b").alias("m"))
    rest = down.join(low, "a").filter("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return rest.union(low.select("a", F.col("m").alias("b"))).distinct()


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)


def connected_components(edges: DataFrame) -> DataFrame:
    """(a, b) long pairs -> (node, component): the smallest node reachable.

    Nodes without an edge do not appear. Loops, repeated and reversed pairs are
    harmless; pairs with a null end are no links.
    """
    edges = edges.filter("a <> b").select(F.col("a").cast("long"), F.col("b").cast("long"))
    edges = materialise(edges.distinct(), "cc-edges")
    state = _state(edges)
    for _ in range(MAX_ROUNDS):
        if not state[0]:
            break
        edges = materialise(_small_star(_large_star(edges)), "cc-round")
        before, state = state, _state(edges)
        if before == state:
            break
    else:
        raise RuntimeError("components did not settle")
    down = edges.select(F.col("a").alias("node"), F.col("b").alias("component"))
    return down.union(down.select("component", "component").distinct())
