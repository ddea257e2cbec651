"""Joins of a group with itself in blocks: the common part of the similarity joins.

A group of any size is cut into blocks of rows, and every two blocks meet in a task of
their own, which holds two blocks and no more. A task returns one row per node, not
one per pair: how many rows the node is linked to there, and the smallest node of
its local component. Sums and components of these rows are the exact result.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailweave.llm.batches import groups, shuffled_anew
from retailweave.llm.components import components
from retailweave.sinks.scratch import written

PARTS = "node binary, n_links long, root binary"


def meetings(members: DataFrame, pairs: DataFrame) -> DataFrame:
    """The rows of ``members``, a table with ``block``, for every pair ``(block_a, block_b)`` of blocks: ``task``, ``side`` and their columns.

    A pair of a block with itself has the block's rows once.
    """
    a = members.join(pairs, F.col("block") == F.col("block_a")).withColumn("side", F.lit(0))
    b = members.join(pairs.where("block_a <> block_b"), F.col("block") == F.col("block_b")).withColumn("side", F.lit(1))
    return a.unionByName(b).withColumn("task", F.concat_ws("|", "block_a", "block_b")).drop("block", "block_a", "block_b")


def meet(tasks: DataFrame, link: Callable[[pa.Table], tuple[np.ndarray, np.ndarray]]) -> DataFrame:
    """Links within every task of ``tasks``, a table with ``task`` and ``node`` and what ``link`` needs.

    ``link(rows)`` returns the weighted number of links and the local component's
    first row for each row of a task, whose rows come sorted by node.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for rows in groups(batches, "task"):
            rows = rows.combine_chunks()
            n_links, root = link(rows)
            nodes = rows.column("node").combine_chunks()
            yield pa.RecordBatch.from_arrays([nodes, pa.array(n_links, pa.int64()), nodes.take(pa.array(root))], ["node", "n_links", "root"])

    return tasks.repartition("task").sortWithinPartitions("task", "node").mapInArrow(run, PARTS)


def local_roots(linked: np.ndarray) -> np.ndarray:
    """The first row of every row's component, from a symmetric matrix of links."""
    n = len(linked)
    own = np.arange(n)
    reach = linked | np.eye(n, dtype=bool)
    while True:
        new = np.where(reach, own[None, :], n).min(axis=1)
        new = np.minimum(new, new[new])
        if (new == own).all():
            return own
        own = new


def classes(nodes: DataFrame, parts: DataFrame) -> DataFrame:
    """``nodes(node, weight, first_id)`` with ``n_links`` and ``class_id`` from the rows of ``meet``.

    A node stands for ``weight`` equal rows, which are linked with each other;
    ``class_id`` is the smallest ``first_id`` of a component.
    """
    sums = parts.groupBy(F.col("node").alias("n")).agg(F.sum("n_links").alias("others"))
    roots = components(parts.select(F.col("node").alias("a"), F.col("root").alias("b")))
    known = nodes.join(sums, nodes.node == sums.n, "left").drop("n")
    # Written, as a class may hold a third of all rows: adaptive execution splits joins of plain tables.
    member = written(
        known.join(roots.withColumnRenamed("node", "n"), F.col("node") == F.col("n"), "left").select(
            "node", "weight", "first_id", "others", F.coalesce("root", "node").alias("root")
        )
    )
    smallest = shuffled_anew(member.groupBy(F.col("root").alias("r")).agg(F.min("first_id").alias("class_id")), "r")
    return member.join(smallest, F.col("root") == F.col("r")).select(
        "node", "class_id", (F.coalesce("others", F.lit(0)) + F.col("weight") - 1).alias("n_links")
    )
