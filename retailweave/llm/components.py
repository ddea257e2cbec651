"""Connected components of a graph that is a table of links, by alternating star steps.

Each step is a grouped minimum and a join, so a node with very many links is summed up
before the shuffle and split by adaptive execution in the join (``batches.shuffled_anew``). Every step is
written to the shared work folder and read again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailweave.llm.batches import shuffled_anew
from retailweave.sinks.scratch import written


def components(links: DataFrame) -> DataFrame:
    """``(node, root)`` for every node of ``links(a, b)``: ``root`` is the smallest node it is linked to, over any way.

    Links with a null end or from a node to itself say nothing and are left out, and so
    are nodes that have no other link.
    """
    edges = written(
        links.select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b"))
        .where("a is not null and b is not null and a <> b")
        .distinct()
    )
    while not _stars(edges):
        edges = written(_small_star(_large_star(edges)))
    roots = edges.select(F.col("b").alias("node"), F.col("b").alias("root")).distinct()
    return edges.select(F.col("a").alias("node"), F.col("b").alias("root")).unionByName(roots)


def _large_star(edges: DataFrame) -> DataFrame:
    """Links every larger neighbour of a node to the smallest of the node and its neighbours."""
    both = edges.union(edges.select("b", "a"))
    least = both.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m")).select("n", F.least("n", "m").alias("m"))
    least = shuffled_anew(least, "n")
    return both.join(least, F.col("a") == F.col("n")).where("b > a").select(F.col("b").alias("a"), F.col("m").alias("b")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Links a node and its smaller neighbours to the smallest of them. ``a`` is larger than ``b`` in every row."""
    edges = written(edges)
    least = edges.groupBy(F.col("a").alias("n")).agg(F.min("b").alias("m"))
    moved = edges.join(shuffled_anew(least, "n"), F.col("a") == F.col("n")).where("b <> m").select(F.col("b").alias("a"), F.col("m").alias("b"))
    return moved.unionByName(least.select(F.col("n").alias("a"), F.col("m").alias("b"))).distinct()


def _stars(edges: DataFrame) -> bool:
    """Whether every node is either the end of links from larger ones or has one link itself, to such an end."""
    times = edges.select(F.col("a").alias("n"), F.lit(1).alias("from_it"), F.lit(0).alias("to_it")).union(
        edges.select("b", F.lit(0), F.lit(1))
    )
    nodes = times.groupBy("n").agg(F.sum("from_it").alias("from_it"), F.max("to_it").alias("to_it"))
    return nodes.where("from_it > 1 or from_it = 1 and to_it = 1").isEmpty()
