"""Self join of documents on the Jaccard similarity of their word n-grams, by MinHash banding.

1. Texts with the same words are one node, so exact copies are compared once.
2. Every node gets ``bands`` hashes, each over ``rows`` MinHash values; the numbers follow
   from the threshold and the recall that is asked for (``choose_bands``).
3. The rows are shuffled on band hashes. Nodes that share one are candidates. A node's
   leader is the smallest node that it shares a band with, and the nodes of a leader form a
   block, or several of at most about ``BLOCK_ROWS`` nodes.
4. Every block, and every two blocks that share a band, meet in a task, which verifies all
   pairs on the full n-gram sets (``linking``). So a chain of candidates, however long, is
   compared along the chain only.

No table of pairs of documents is made: the result has one row per document.
"""

from __future__ import annotations

import hashlib
import math
from fractions import Fraction

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window as W

from retailweave.llm.batches import add_columns, packed, quoted, shuffled_anew, unpacked
from retailweave.llm.linking import classes, local_roots, meet, meetings
from retailweave.llm.words import Words, mixed
from retailweave.sinks.scratch import written

NGRAM = 5
THRESHOLD = 0.8
RECALL = 0.999
MAX_BANDS = 24
BLOCK_ROWS = 256

_COLUMNS = 8192  # n-grams in one matrix product
_SIGNATURE = T.StructType([T.StructField("node", T.BinaryType()), T.StructField("bands", T.ArrayType(T.LongType()))])
_NGRAMS = T.StructType([T.StructField("node", T.BinaryType()), T.StructField("ngrams", T.ArrayType(T.LongType()))])


def choose_bands(threshold: float = THRESHOLD, recall: float = RECALL, max_bands: int = MAX_BANDS) -> tuple[int, int]:
    """``(bands, rows)`` so that a pair at the threshold shares a band with probability ``recall``.

    Of all choices of at most ``max_bands`` the one with most rows, which has the
    fewest candidates below the threshold.
    """
    rows = 1
    while _bands(threshold, recall, rows + 1) <= max_bands:
        rows += 1
    return _bands(threshold, recall, rows), rows


def _bands(threshold: float, recall: float, rows: int) -> int:
    hit = threshold**rows
    return 1 if hit >= 1 else math.ceil(math.log1p(-recall) / math.log1p(-hit))


def _node_ids(words: Words) -> list[bytes | None]:
    """A 128-bit digest of each text's words in order; None where there is no word."""
    return [
        hashlib.blake2b(words.hashes[a:b].tobytes(), digest_size=16).digest() if b > a else None
        for a, b in zip(words.first[:-1], words.first[1:])
    ]


def _signatures(n: int, bands: int, rows: int):
    """A function from texts to their node ids and band hashes."""
    random = np.random.Generator(np.random.PCG64(7))
    factors = random.integers(0, 1 << 31, bands * rows, dtype=np.uint32) * np.uint32(2) + np.uint32(1)
    shifts = random.integers(0, 1 << 32, bands * rows, dtype=np.uint32)

    def compute(texts: pa.Array):
        words = Words(texts)
        ngrams, first = words.shingles(n)
        ngrams = (ngrams >> np.uint64(32)).astype(np.uint32)
        full = np.flatnonzero(np.diff(first))
        hashes = np.zeros((bands, len(full)), dtype=np.uint64)
        if len(full):
            starts = first[full]
            for band in range(bands):
                for row in range(band * rows, band * rows + rows):
                    least = np.minimum.reduceat(ngrams * factors[row] + shifts[row], starts)
                    hashes[band] = mixed(hashes[band] * np.uint64(0x9E3779B97F4A7C15) + least + np.uint64(1))
                hashes[band] += np.uint64(band)
        values = pa.array(hashes.T.reshape(-1).view(np.int64))
        length = np.zeros(len(texts) + 1, dtype=np.int32)
        length[1:][full] = bands
        bands_of = pa.ListArray.from_arrays(pa.array(np.cumsum(length, dtype=np.int32)), values)
        return pa.array(_node_ids(words), pa.binary()), bands_of

    return compute


def _ngram_sets(n: int):
    """A function from texts to their node ids and sorted sets of n-gram hashes."""

    def compute(texts: pa.Array):
        words = Words(texts)
        ngrams, first = words.shingles(n)
        sets = [np.unique(ngrams[a:b].view(np.int64)) for a, b in zip(first[:-1], first[1:])]
        ends = np.cumsum([0, *map(len, sets)], dtype=np.int32)
        values = pa.array(np.concatenate(sets) if sets else np.zeros(0, np.int64), pa.int64())
        return pa.array(_node_ids(words), pa.binary()), pa.ListArray.from_arrays(pa.array(ends), values)

    return compute


def _verify(threshold: float):
    """Links of the rows of a task: all pairs of one block, or those between two blocks."""
    share = Fraction(str(threshold))

    def link(rows: pa.Table) -> tuple[np.ndarray, np.ndarray]:
        lists = rows.column("ngrams").combine_chunks()
        size = np.asarray(lists.value_lengths(), dtype=np.int64)
        values, ids = np.unique(np.asarray(lists.flatten()), return_inverse=True)
        times = np.bincount(ids, minlength=len(values))
        column = np.cumsum(times > 1) - 1
        shared = times[ids] > 1
        row, ids = np.repeat(np.arange(len(size)), size)[shared], column[ids[shared]]
        common = np.zeros((len(size), len(size)), dtype=np.float64)
        order = np.argsort(ids, kind="stable")
        row, ids = row[order], ids[order]
        for start in range(0, int(ids[-1]) + 1 if len(ids) else 0, _COLUMNS):
            a, b = np.searchsorted(ids, [start, start + _COLUMNS])
            matrix = np.zeros((len(size), _COLUMNS), dtype=np.float32)
            matrix[row[a:b], ids[a:b] - start] = 1
            common += matrix @ matrix.T
        either = size[:, None] + size[None, :] - common
        linked = share.denominator * common >= share.numerator * either
        side = np.asarray(rows.column("side"))
        if side.any():
            linked &= side[:, None] != side[None, :]
        np.fill_diagonal(linked, False)
        return linked @ np.asarray(rows.column("weight")), local_roots(linked)

    return link


def similarity_join(
    df: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    n: int = NGRAM,
    threshold: float = THRESHOLD,
    recall: float = RECALL,
    block_rows: int = BLOCK_ROWS,
) -> DataFrame:
    """One row per row of ``df``: its id, ``class_id`` and ``n_links``.

    Two rows are linked if the Jaccard similarity of their sets of word n-grams is at least
    ``threshold``; a text of fewer than n words has one n-gram of all its words. ``n_links``
    counts the other rows a row is linked to, copies included, and ``class_id`` is the smallest
    id that can be reached over links. Null and wordless texts link with nothing and are their own
    class. Null ids are kept and never the smallest. Other columns are not looked at.
    """
    bands, rows = choose_bands(threshold, recall)
    ids = df.select(quoted(id_column).alias("id"), quoted(text).cast("string").alias("text"))
    signed = written(add_columns(ids, "text", _SIGNATURE, lambda: _signatures(n, bands, rows), ["id"]))
    worded = signed.where("node is not null")
    nodes = written(
        worded.groupBy("node").agg(
            F.count("*").alias("weight"), F.min("id").alias("first_id"), F.first("bands").alias("bands")
        )
    )
    blocks, pairs = _blocks(nodes, block_rows)
    wanted = written(nodes.join(blocks, "node").select("node", "first_id", "weight", "block"))
    texts = ids.join(
        wanted.select(F.col("first_id").alias("wanted_id")).distinct(), F.col("id").eqNullSafe(F.col("wanted_id")), "left_semi"
    )
    sets = add_columns(texts, "text", _NGRAMS, lambda: _ngram_sets(n), ["id"])
    # Rows with one id may have different texts, and repeated rows the same: one row per node goes on.
    sets = sets.where("node is not null").dropDuplicates(["node"]).drop("id")
    members = written(sets.join(wanted, "node").select("node", "ngrams", "weight", "block"))
    tasks = meetings(members, pairs)
    known = classes(nodes.select("node", "weight", "first_id"), written(meet(tasks, _verify(threshold))))
    found = worded.select("id", "node").join(known, "node").select("id", "class_id", "n_links")
    alone = signed.where("node is null").select("id", F.col("id").alias("class_id"), F.lit(0).cast("long").alias("n_links"))
    return found.unionByName(alone).select(F.col("id").alias(id_column), "class_id", "n_links")


def _blocks(nodes: DataFrame, block_rows: int) -> tuple[DataFrame, DataFrame]:
    """``(node, block)`` of the nodes that share a band with another one, and ``(block_a, block_b)`` of the blocks to compare."""
    rows = nodes.select("node", F.explode("bands").alias("band"))
    # Adaptive execution splits the joins on a hot band, leader or block.
    least = rows.groupBy(F.col("band").alias("key")).agg(F.min("node").alias("first"), F.count("*").alias("n")).where("n > 1")
    shared = written(rows.join(shuffled_anew(least, "key"), F.col("band") == F.col("key")).select("node", "band", "first"))
    leaders = shared.groupBy("node").agg(F.min("first").alias("leader"))
    sizes = leaders.groupBy(F.col("leader").alias("of")).agg(F.ceil(F.count("*") / block_rows).alias("n_blocks"))
    sizes = shuffled_anew(sizes, "of")
    block = F.concat_ws(":", F.hex("leader"), F.pmod(F.xxhash64("node"), F.col("n_blocks")))
    blocks = written(leaders.join(sizes, F.col("leader") == F.col("of")).select("node", block.alias("block")))
    in_band = written(shared.join(blocks, "node").select("band", "block").distinct())
    other = in_band.select(F.col("band").alias("key"), F.col("block").alias("block_b"))
    across = in_band.join(other, (F.col("band") == F.col("key")) & (F.col("block") < F.col("block_b")))
    several = blocks.groupBy("block").count().where("count > 1")
    within = several.select(F.col("block").alias("block_a"), F.col("block").alias("block_b"))
    return blocks, written(across.select(F.col("block").alias("block_a"), "block_b").unionByName(within).distinct())


def drop_near_duplicates(df: DataFrame, id_column: str = "doc_id", text: str = "text", **options) -> DataFrame:
    """One row of every class of ``similarity_join``: the one with the smallest id.

    Rows with the same id and text are one row, and null or wordless texts stay. Ids are taken to be
    unique otherwise: of different texts under one id all stay if one does, and so do those without id.
    """
    found = similarity_join(df, id_column, text, **options)
    kept = found.where(quoted(id_column) == F.col("class_id")).select(F.col("class_id").alias("__kept")).distinct()
    rows = packed(df, text).withColumn("__key", F.col("__others")[id_column])
    # The join leaves the rows of an id together, so that the window does not move the texts again.
    with_id = rows.where("__key is not null").join(kept, F.col("__key") == F.col("__kept"), "left_semi")
    same = W.partitionBy("__key", F.xxhash64("__text")).orderBy(F.lit(0))
    first = [
        df.withColumn("__nth", F.row_number().over(same)).where("__nth = 1")
        for df in (with_id, rows.where("__key is null"))
    ]
    return unpacked(first[0].unionByName(first[1]), df.columns, text)
