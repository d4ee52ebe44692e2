"""Connected components of a graph given by its links."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from coldshelf.plans.staging import stage


def connected_components(links: DataFrame) -> DataFrame:
    """Columns ``a`` and ``b`` of one type in; ``node`` and ``component`` (its least node) out.

    Large and small stars by turns: every node is linked to the least node among its
    neighbours until nothing changes.  Each step is an aggregation with partial minima and
    a join, and is written before the next, so no lineage grows and no hub is gathered.
    Nodes without a link to another node do not appear.
    """
    edges = links.where("a <> b").select(F.greatest("a", "b").alias("big"), F.least("a", "b").alias("small"))
    edges = stage(edges.distinct(), "edges")
    print_of = _print(edges)
    while True:
        # large star: the greater neighbours of a node go to the least of all its neighbours
        both = edges.union(edges.select("small", "big")).toDF("small", "other")
        least = stage(both.groupBy("small").agg(F.min("other").alias("least")), "least")
        edges = stage(
            edges.join(least, "small").select("big", F.least("small", "least").alias("small")).distinct(), "edges"
        )
        # small star: the lesser neighbours of a node, and the node, go to the least of them
        least = stage(edges.groupBy("big").agg(F.min("small").alias("least")), "least")
        lesser = edges.join(least, "big").where("small <> least").select(F.col("small").alias("big"), "least")
        edges = stage(lesser.union(least.select("big", "least")).toDF("big", "small").distinct(), "edges")
        now = _print(edges)
        if now == print_of:
            break
        print_of = now
    roots = edges.select(F.col("small").alias("node"), F.col("small").alias("component")).distinct()
    return edges.select(F.col("big").alias("node"), F.col("small").alias("component")).union(roots)


def _print(edges: DataFrame) -> tuple:
    """A number of rows and a sum of hashes that change when the edges do."""
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("big", "small").cast("decimal(20,0)"))).first())
