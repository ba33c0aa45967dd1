"""Connected components of a graph given as edges between whole numbers."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .shared import discard, heavy_keys, join_spread, written


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).head())


#: Rows of two numbers that one task gets of a hub.
PART = 1 << 16


def components(edges: DataFrame) -> DataFrame:
    """Returns `node` long and `component` long, the least node of its component, for every node of an edge (`a` long, `b` long).

    Alternates two steps until nothing changes: every node's larger neighbours, then its smaller ones, are tied to the
    least node that it knows. Both keep the components as they are, and the number of rounds grows with the logarithm of
    the graph's size. A hub's neighbours are rows of their own throughout; they meet its least node in as many parts as
    their number asks for. Least nodes are found by aggregation before the shuffle. Loops and repeated edges don't matter.
    """
    edges = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct())
    state = _state(edges)
    while state[0]:
        both = edges.select("a", "b").union(edges.select(F.col("b").alias("a"), F.col("a").alias("b")))
        heavy = heavy_keys(both.groupBy("a").agg(F.count(F.lit(1)).alias("n")), 2 * state[0], PART)  # neighbours of each node, which bound its rows in either step
        least = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = join_spread(both.where("b > a"), least, "a", heavy).select(F.col("b").alias("a"), F.col("m").alias("b")).where("a <> b").distinct()
        least = large.groupBy("a").agg(F.min("b").alias("m"))  # b < a throughout
        small = join_spread(large, least, "a", heavy).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
        last, edges = edges, written(small.union(least.select("a", F.col("m").alias("b"))).distinct())
        discard(last)
        if (new := _state(edges)) == state:
            break
        state = new
    return edges.select(F.col("a").alias("node"), F.col("b").alias("component")).union(edges.select(F.col("b").alias("node"), F.col("b").alias("component")).distinct())
