"""Connected components of a graph that is larger than any one machine."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tillwatch.llm.text import written


def connected_components(edges: DataFrame) -> DataFrame:
    """(node, root) for every node of `edges` (a, b: long, not null); equal roots are connected.

    In each round every node points to the neighbour (or itself) that comes first in
    a fixed random order, and the graph is contracted along the pointers: the rounds
    grow with the logarithm of the longest chain. All rounds aggregate with a
    map-side half, so a node with very many edges needs no task of its own, and hand
    over through written tables.
    """
    live = written(edges.filter("a <> b").select("a", "b").distinct(), "edges")
    labels = None
    while True:
        both = live.union(live.select("b", "a"))
        rank = F.struct(F.xxhash64("b"), F.col("b"))
        best = both.groupBy("a").agg(F.min(rank).alias("best"))
        own = F.struct(F.xxhash64("a"), F.col("a"))
        points = written(
            best.select("a", F.when(F.col("best") < own, F.col("best.b")).otherwise(F.col("a")).alias("to")),
            "pointers",
        )
        if labels is None:
            labels = points.select(F.col("a").alias("node"), F.col("to").alias("root"))
        else:
            moved = points.select(F.col("a").alias("root"), "to")
            labels = labels.join(moved, "root", "left").select(
                "node", F.coalesce("to", "root").alias("root")
            )
        labels = written(labels, "labels")
        to_a = points.select("a", F.col("to").alias("x"))
        to_b = points.select(F.col("a").alias("b"), F.col("to").alias("y"))
        contracted = live.join(to_a, "a").join(to_b, "b").filter("x <> y")
        live = written(contracted.select(F.col("x").alias("a"), F.col("y").alias("b")).distinct(), "edges")
        if live.isEmpty():
            return labels
