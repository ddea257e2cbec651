"""Near-duplicate vectors by an epsilon grid order join.

Cosine similarity of at least s between unit vectors means a distance of at most
eps = sqrt(2 - 2 s), and no projection makes a distance larger. So:

1. Equal vectors of a label are one node.
2. Unit vectors are projected on the leading principal directions of a bounded sample,
   and sorted by label and by the grid cells of width eps along these directions.
3. The sorted sequence is cut into blocks. Two blocks whose bounding boxes in the projection
   are more than eps apart are not joined.
4. Two blocks that are joined meet in a task, which halves them again and again and
   skips the pairs of intervals that are too far apart; what is left is compared by the
   cosine in double precision. Blocks are as large as memory allows, since a vector is sent
   to a task for every block that its own one is joined with.

The directions are orthonormal whatever the sample, so they change the speed, not the result.
"""

from __future__ import annotations

import hashlib
import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailweave.llm.batches import quoted
from retailweave.llm.linking import classes, meet, meetings
from retailweave.sinks.scratch import written

THRESHOLD = 0.98
DIRECTIONS = 3
SAMPLE = 5000  # vectors that the directions are fitted on
BLOCK_BYTES = 4 * 1024 * 1024  # of the vectors of a block; a task holds two blocks
BLOCK_ROWS = 8192
LEAF_ROWS = 256

_NODES = "id {id}, label {label}, node binary, vector array<double>"
_SLACK = 1e-9  # for rounding in distances


def _usable(label: str, vector: str):
    """Rows that can have links: a label, and finite components that are not all zero."""
    v = quoted(vector)
    finite = F.forall(v, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return quoted(label).isNotNull() & v.isNotNull() & F.coalesce(finite, F.lit(False)) & F.exists(v, lambda x: x != 0)


def _with_nodes(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Adds the digest of label and vector, which names the node."""
    for batch in batches:
        lists = batch.column(2)
        values, ends = np.asarray(lists.flatten()) + 0.0, np.cumsum([0, *np.asarray(lists.value_lengths())])
        nodes = [
            hashlib.blake2b(repr(label).encode() + b":" + values[a:b].tobytes(), digest_size=16).digest()
            for label, a, b in zip(batch.column(1).to_pylist(), ends[:-1], ends[1:])
        ]
        yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(nodes, pa.binary()), lists], ["id", "label", "node", "vector"])


def _unit(rows: pa.Array) -> np.ndarray:
    """Vectors of one length as unit rows. Scaling by the largest component first keeps squares finite."""
    lists = rows.combine_chunks() if isinstance(rows, pa.ChunkedArray) else rows
    x = np.asarray(lists.flatten(), dtype=np.float64).reshape(len(lists), -1)
    x = x / np.abs(x).max(axis=1, keepdims=True)
    return x / np.linalg.norm(x, axis=1, keepdims=True)


def _directions(nodes: DataFrame, size: int, directions: int, sample: int) -> np.ndarray:
    """Orthonormal leading directions of the vectors of ``size`` components with the smallest digests."""
    picked = nodes.where(F.size("vector") == size).select("node", "vector").orderBy("node").limit(sample).toArrow()
    unit = _unit(picked.column("vector"))
    return np.linalg.svd(unit - unit.mean(axis=0), full_matrices=False)[2][:directions].T.copy()


def _gap(a: np.ndarray, b: np.ndarray) -> float:
    """Least distance of the bounding boxes of two sets of points."""
    apart = np.maximum(a.min(axis=0) - b.max(axis=0), b.min(axis=0) - a.max(axis=0))
    return float(np.linalg.norm(np.maximum(apart, 0)))


def _link(threshold: float, eps: float, directions: dict[int, np.ndarray]):
    """Links of the rows of a task by recursive joins of intervals."""

    def link(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        unit = _unit(rows.column("vector"))
        # As the definition has it: dot product over norms, in doubles.
        places = unit @ directions[unit.shape[1]]
        order = np.lexsort(_cells(places, eps).T[::-1])
        unit, places = unit[order], places[order]
        side = np.asarray(rows.column("side"))[order]
        weight = np.asarray(rows.column("weight"))[order]
        two = bool(side.any())
        n_links = np.zeros(len(unit), dtype=np.int64)
        edges: list[tuple[np.ndarray, np.ndarray]] = []

        def compare(a: slice, b: slice) -> None:
            """Counts the links between two intervals, or within one, and joins every linked row to the first that it is linked to."""
            found = unit[a] @ unit[b].T >= threshold
            if two:
                found &= side[a][:, None] != side[b][None, :]
            if a == b:
                np.fill_diagonal(found, False)
            if not found.any():
                return
            n_links[a] += found @ weight[b]
            if a != b:
                n_links[b] += found.T @ weight[a]
            # Every linked row is joined to the first row of its component within the two intervals.
            one, other = np.arange(a.start, a.stop), np.arange(b.start, b.stop)
            while True:
                least = np.minimum(other, np.where(found, one[:, None], len(unit)).min(axis=0))
                own = np.minimum(one, np.where(found, least[None, :], len(unit)).min(axis=1))
                if (least == other).all() and (own == one).all():
                    break
                one, other = own, least
            edges.append((np.arange(a.start, a.stop), one))
            edges.append((np.arange(b.start, b.stop), other))

        def join(a: slice, b: slice) -> None:
            if _gap(places[a], places[b]) > eps + _SLACK:
                return
            n, m = a.stop - a.start, b.stop - b.start
            if max(n, m) <= LEAF_ROWS:
                compare(a, b)
                return
            halves = [(x,) if k <= LEAF_ROWS else (slice(x.start, x.start + k // 2), slice(x.start + k // 2, x.stop)) for x, k in ((a, n), (b, m))]
            for i, x in enumerate(halves[0]):
                for j, y in enumerate(halves[1]):
                    if a != b or i <= j:
                        join(x, y)

        if two:
            for first in _runs(side == 0):
                for second in _runs(side == 1):
                    join(first, second)
        else:
            join(slice(0, len(unit)), slice(0, len(unit)))
        # Back to the order of the rows: the roots' nodes must be the smallest.
        counts = np.empty_like(n_links)
        counts[order] = n_links
        ends = [order[np.concatenate(x)] for x in zip(*edges)] or [np.zeros(0, np.int64)] * 2
        return counts, _roots(len(unit), *ends)

    return link


def _roots(n: int, a: np.ndarray, b: np.ndarray) -> np.ndarray:
    """The first row of every row's component, by the edges between them."""
    own = np.arange(n)
    while True:
        new = own.copy()
        np.minimum.at(new, a, own[b])
        np.minimum.at(new, b, own[a])
        new = np.minimum(new, new[new])
        if (new == own).all():
            return own
        own = new


def _runs(flags: np.ndarray) -> list[slice]:
    """The runs of true values."""
    turns = np.flatnonzero(np.diff(flags.astype(np.int8), prepend=0, append=0))
    return [slice(int(a), int(b)) for a, b in zip(turns[::2], turns[1::2])]


def _cells(places: np.ndarray, eps: float) -> np.ndarray:
    return np.floor(places / eps).astype(np.int64)


def near_duplicates(
    df: DataFrame,
    id_column: str = "vec_id",
    vector: str = "embedding",
    label: str = "label",
    threshold: float = THRESHOLD,
    directions: int = DIRECTIONS,
    sample: int = SAMPLE,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per row of ``df``: its id, ``n_links``, ``component_id`` and ``kept``.

    Two rows are linked if their labels are equal and not null and the cosine of their vectors is
    at least ``threshold``; vectors of different length are not comparable. ``n_links`` counts the other
    rows a row is linked to, equal vectors included; ``component_id`` is the smallest id that can
    be reached; ``kept`` says whether that is the row's own. Vectors that are null, empty, zero or hold
    null, NaN or infinite components link with nothing. Rows without an id are kept and are never the
    smallest of a component that has one.
    """
    rows = df.select(quoted(id_column).alias("id"), quoted(label).alias("label"), quoted(vector).cast("array<double>").alias("vector"))
    usable = rows.where(_usable("label", "vector"))
    kinds = {name: rows.schema[name].dataType.simpleString() for name in ("id", "label")}
    signed = written(usable.mapInArrow(_with_nodes, _NODES.format(**kinds)))
    nodes = written(
        signed.groupBy("node").agg(
            F.count("*").alias("weight"), F.min("id").alias("first_id"), F.first("label").alias("label"), F.first("vector").alias("vector")
        )
    )
    eps = math.sqrt(2 - 2 * threshold)
    lengths = [row[0] for row in nodes.select(F.size("vector")).distinct().collect()]
    axes = {size: _directions(nodes, size, min(directions, size), sample) for size in lengths}
    blocks = written(_blocks(nodes, axes, eps, block_rows))
    pairs = written(_block_pairs(blocks, eps, max([1, *(x.shape[1] for x in axes.values())])))
    tasks = meetings(blocks.select("node", "vector", "weight", "block"), pairs)
    known = classes(nodes.select("node", "weight", "first_id"), written(meet(tasks, _link(threshold, eps, axes))))
    found = signed.select("id", "node").join(known, "node").select("id", "n_links", F.col("class_id").alias("component_id"))
    alone = rows.where(~_usable("label", "vector")).select("id", F.lit(0).cast("long").alias("n_links"), F.col("id").alias("component_id"))
    return found.unionByName(alone).select(
        F.col("id").alias(id_column), "n_links", "component_id", F.col("id").eqNullSafe(F.col("component_id")).alias("kept")
    )


def _blocks(nodes: DataFrame, axes: dict[int, np.ndarray], eps: float, block_rows: int) -> DataFrame:
    """The nodes in epsilon grid order, each with its block and its place in the projection."""

    def project(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            size = np.asarray(batch.column("vector").value_lengths())
            places = [None] * len(size)
            for n in np.unique(size):
                own = np.flatnonzero(size == n)
                for i, place in zip(own, _unit(batch.column("vector").take(pa.array(own))) @ axes[n]):
                    places[i] = place.tolist()
            cells = [np.floor(np.asarray(place) / eps).astype(int).tolist() for place in places]
            yield pa.RecordBatch.from_arrays(
                [*batch.columns, pa.array(size, pa.int32()), pa.array(places, pa.list_(pa.float64())), pa.array(cells, pa.list_(pa.int32()))],
                [*batch.schema.names, "size", "place", "cell"],
            )

    schema = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in nodes.schema)
    placed = nodes.mapInArrow(project, f"{schema}, size int, place array<double>, cell array<int>")
    order = ["size", "label", "cell", "node"]
    ordered = placed.repartitionByRange(*order).sortWithinPartitions(*order)

    def cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        n, last = -1, None
        filled = 0
        for batch in batches:
            names = []
            for key in zip(batch.column("size").to_pylist(), batch.column("label").to_pylist()):
                most = max(1, min(block_rows, BLOCK_BYTES // (8 * max(key[0], 1))))
                if filled >= most or key != last:
                    n, filled, last = n + 1, 0, key
                filled += 1
                names.append(n)
            yield pa.RecordBatch.from_arrays([*batch.columns, pa.array(names, pa.int64())], [*batch.schema.names, "nth"])

    fields = ", ".join(f"{field.name} {field.dataType.simpleString()}" for field in placed.schema)
    return ordered.mapInArrow(cut, f"{fields}, nth long").select(
        "node", "vector", "weight", "size", "label", "place", ((F.spark_partition_id().cast("long") * (1 << 32)) + F.col("nth")).alias("block")
    )


def _block_pairs(blocks: DataFrame, eps: float, directions: int) -> DataFrame:
    """``(block_a, block_b)`` of one label whose boxes are at most eps apart, each pair once.

    Boxes meet over the grid cells of the first two directions: one side takes its own cells,
    the other those around it as well. There are at most 2 / eps + 3 along a direction.
    """
    axes = range(directions)
    boxes = written(
        blocks.groupBy("block").agg(
            F.first("size").alias("size"),
            F.first("label").alias("label"),
            *(F.min(F.coalesce(F.get("place", F.lit(i)), F.lit(0.0))).alias(f"low{i}") for i in axes),
            *(F.max(F.coalesce(F.get("place", F.lit(i)), F.lit(0.0))).alias(f"high{i}") for i in axes),
        )
    )
    first = range(min(2, directions))

    def cells(df: DataFrame, margin: float) -> DataFrame:
        for i in first:
            low, high = (F.floor((F.col(name) + shift) / eps) for name, shift in ((f"low{i}", -margin), (f"high{i}", margin)))
            df = df.withColumn(f"cell{i}", F.explode(F.sequence(low, high)))
        return df

    a = cells(boxes, 0.0).select(*(F.col(name).alias(f"a_{name}") for name in [*boxes.columns, *(f"cell{i}" for i in first)]))
    b = cells(boxes, eps + _SLACK)
    on = [F.col("a_size") == F.col("size"), F.col("a_label") == F.col("label"), *(F.col(f"a_cell{i}") == F.col(f"cell{i}") for i in first)]
    apart = [F.greatest(F.col(f"a_low{i}") - F.col(f"high{i}"), F.col(f"low{i}") - F.col(f"a_high{i}"), F.lit(0.0)) for i in axes]
    near = sum((x * x for x in apart), F.lit(0.0)) <= (eps + _SLACK) ** 2
    # A block's own cells need not be its neighbour's own, so both directions are looked at.
    return (
        a.join(b, on)
        .where(near)
        .select(F.least("a_block", "block").alias("block_a"), F.greatest("a_block", "block").alias("block_b"))
        .distinct()
    )
