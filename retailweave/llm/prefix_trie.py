"""The trie of conversation prefixes, from sorted neighbours and the lengths of their common prefixes.

Every turn is a key of 16 bytes, a hash of its role and text, and a conversation is the path of its turns' keys.

1. Equal paths are one path, with the number of conversations and the smallest of them.
2. The distinct paths are sorted by range. A task takes its sorted paths in blocks of bounded size.
3. In a block, an edge joins every two neighbours, and its depth is the length of their common prefix. Union-find takes
   the edges in descending depth: every merge of components makes a branching node of that depth, or adds to the one
   that is there, and what a component had as its top before becomes a child. A node without branches stands for the
   chain above it up to its parent. All figures of a node are sums over the neighbouring paths below it.
4. Nodes on the first or last path of a block may go on in the block before or after. The forest of a block is contracted
   to them; all other nodes are final. A block knows the depths that it shares with its neighbours in the same
   partition; what is counted twice at the bounds of partitions is taken back by rows of corrections.
5. The contracted forests are merged across all bounds by the prefix that a node stands for.

Of a partition's bounds Spark sees the first and last path, and the driver only the partitions' numbers.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.pandas.types import from_arrow_schema

from retailweave.llm.batches import quoted
from retailweave.sinks.scratch import written

KEY = 16  # bytes
BLOCK_TURNS = 1 << 17  # turns in a block, or one path

_FIGURES = ("n_convs", "n_children", "n_leaves", "saved_tokens")
_NODES = pa.schema(
    [("kind", pa.string()), ("block", pa.string()), ("part", pa.int32()), ("key", pa.binary()), ("parent_key", pa.binary())]
    + [(name, pa.int64()) for name in ("conv", "parent_conv", "depth", *_FIGURES)]
    + [("is_end", pa.bool_()), ("path", pa.binary()), ("tokens", pa.list_(pa.int64()))]
)
# Nodes that are final, nodes of contracted forests, and the first and last path of a partition.
_FINAL, _OPEN, _FIRST, _LAST = "final", "open", "first", "last"


@dataclass(frozen=True)
class Trie:
    """``nodes``: one row per node, ``ends``: ``(conv, key)`` of every conversation, ``key`` being that of the node it ends at."""

    nodes: DataFrame
    ends: DataFrame


# ---- turns -----------------------------------------------------------------------


def short_hash(value: Column) -> Column:
    """The first 16 bytes of the SHA-256."""
    return F.substring(F.unhex(F.sha2(value, 256)), 1, KEY)


def turn_keys(turns: DataFrame, conversation: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text") -> DataFrame:
    """``conv``, ``turn``, ``role``, ``key`` and ``tokens`` (words between white space) of every turn, without its text.

    A null role or text is empty. Other columns are not looked at.
    """
    roles, texts = (F.coalesce(quoted(name).cast("string"), F.lit("")) for name in (role, text))
    said = F.concat(F.octet_length(roles).cast("string"), F.lit(":"), roles, texts).cast("binary")
    words = F.regexp_count(texts, F.lit(r"[^\x20\x09-\x0D]+"))
    return turns.select(
        quoted(conversation).cast("long").alias("conv"),
        quoted(turn).cast("long").alias("turn"),
        roles.alias("role"),
        short_hash(said).alias("key"),
        words.cast("long").alias("tokens"),
    )


def paths(turns: DataFrame, conversations: DataFrame | None = None) -> DataFrame:
    """``conv``, ``path`` and ``tokens`` (of each turn) of every conversation of ``turn_keys``, by turn, role and key; null turns come first.

    ``conversations(conv)`` may name more of them, which have no turns. Null ids are none.
    """
    entry = F.struct("turn", "role", "key", "tokens")
    rows = turns.select("conv", entry.alias("entry"))
    if conversations is not None:
        rows = rows.unionByName(conversations.select(F.col("conv").cast("long"), F.lit(None).cast(rows.schema["entry"].dataType).alias("entry")))
    grouped = rows.where("conv is not null").groupBy("conv").agg(F.sort_array(F.collect_list("entry")).alias("entries"))
    keys = F.array_join(F.transform("entries", lambda x: F.hex(x["key"])), "")
    return grouped.select("conv", F.unhex(keys).alias("path"), F.col("entries.tokens").alias("tokens"))


# ---- one block -------------------------------------------------------------------


def common_prefixes(data: list[bytes]) -> np.ndarray:
    """The number of keys that each path has in common with the one before; 0 for the first."""
    lengths = np.array([len(path) // KEY for path in data], dtype=np.int64)
    keys = np.frombuffer(b"".join(data), dtype="<u8").reshape(-1, 2)
    first = np.cumsum(lengths) - lengths
    both = np.minimum(lengths[1:], lengths[:-1])
    step = np.arange(both.sum()) - np.repeat(np.cumsum(both) - both, both)
    same = (keys[np.repeat(first[:-1], both) + step] == keys[np.repeat(first[1:], both) + step]).all(axis=1)
    pair = np.repeat(np.arange(len(both)), both)
    out = np.zeros(len(data), dtype=np.int64)
    # The first difference of each pair, or the whole length of the shorter path.
    out[1:] = both
    at = np.flatnonzero(~same)
    np.minimum.at(out, pair[at] + 1, step[at])
    return out


def merged(lengths: np.ndarray, common: np.ndarray) -> tuple[np.ndarray, ...]:
    """Depth, parent (-1: none), number of children, first and last path of the branching nodes and ends of sorted distinct paths.

    The first nodes are the paths' own ends.
    """
    n = len(lengths)
    depth, parent, children = lengths.tolist(), [-1] * n, [0] * n
    first, last = list(range(n)), list(range(n))
    link, top = list(range(n)), list(range(n))

    def find(i: int) -> int:
        while link[i] != i:
            link[i] = link[link[i]]
            i = link[i]
        return i

    # Of edges of one depth the left one comes first, so the component to the right of an edge has a deeper top.
    for edge in (np.argsort(-common[1:], kind="stable") + 1).tolist():
        at = int(common[edge])
        left, right = find(edge - 1), find(edge)
        node, child = top[left], top[right]
        if depth[node] > at:
            depth.append(at)
            parent.append(-1)
            children.append(1)
            first.append(first[node])
            last.append(last[node])
            parent[node] = len(depth) - 1
            node = len(depth) - 1
        parent[child] = node
        children[node] += 1
        last[node] = last[child]
        link[right] = left
        top[left] = node
    return tuple(np.array(x, dtype=np.int64) for x in (depth, parent, children, first, last))


@dataclass
class Block:
    """Some sorted distinct paths, the number of turns that the first has in common with the path before it, and the last with the
    one after it. Both are None at a bound of the partition."""

    data: list[bytes]
    tokens: list[list[int]]
    n_convs: list[int]
    conv: list[int]
    before: int | None = None
    after: int | None = None

    def nodes(self, block: str, part: int) -> Iterator[pa.RecordBatch]:
        """The final and the open nodes. The figures of an open node are what this block adds to it."""
        m = len(self.data)
        lengths = np.array([len(path) // KEY for path in self.data], dtype=np.int64)
        common = common_prefixes(self.data)
        depth, parent, children, first, last = merged(lengths, common)
        common[0] = -1 if self.before is None else self.before
        open_first = lengths[0] if self.before is None else self.before
        open_last = lengths[-1] if self.after is None else self.after
        # Tokens of the first d turns of path i are at start[i] + d.
        start = np.cumsum(lengths + 1) - (lengths + 1)
        up_to = np.zeros(int((lengths + 1).sum()), dtype=np.int64)
        flat = np.array([x for own in self.tokens for x in own], dtype=np.int64)
        up_to[np.delete(np.arange(len(up_to)), start)] = flat
        up_to = np.cumsum(up_to)
        up_to -= np.repeat(up_to[start], lengths + 1)
        total = up_to[start + lengths]
        convs = np.array(self.n_convs, dtype=np.int64)
        follows = np.append(common[1:], -1 if self.after is None else self.after)

        def below(values: np.ndarray) -> np.ndarray:
            """The sum over the paths of each node."""
            sums = np.concatenate([[0], np.cumsum(values)])
            return sums[last + 1] - sums[first]

        shared = up_to[start + np.maximum(common, 0)]
        n_convs, n_leaves = below(convs), below(follows < lengths)
        # Of (n - 1) * tokens, summed up over nodes: all tokens of all conversations, less those of every node once.
        spent = below((convs - 1) * total + shared) - shared[first]
        smallest = self._smallest(first, last)

        # From every node up its chain, a row for each depth.
        above = np.where(parent >= 0, depth[parent], -1)
        length = depth - above
        node = np.repeat(np.arange(len(depth)), length)
        d = np.repeat(above + 1, length) + np.arange(length.sum()) - np.repeat(np.cumsum(length) - length, length)
        own_first = first[node]
        before = up_to[start[own_first] + np.maximum(d - 1, 0)]
        # The first path of a block may have turns in common with the one before, which counts those nodes.
        known = np.where(own_first == 0, np.maximum(common[0], 0), 0)
        seen = np.where((own_first == 0) & (common[0] >= d), up_to[known], before)
        saved = spent[node] - n_convs[node] * before + seen
        bottom = d == depth[node]
        n_children = np.where(bottom, children[node], 1) - ((own_first == 0) & (common[0] > d))
        on_first = (own_first == 0) & (d <= open_first)
        on_last = (last[node] == m - 1) & (d <= open_last)
        is_open = on_first | on_last
        up = np.where(d == above[node] + 1, parent[node], node)
        up_open = ((first[up] == 0) & (d - 1 <= open_first)) | ((last[up] == m - 1) & (d - 1 <= open_last))
        up_open &= d > 0
        is_end = bottom & (lengths[own_first] == d)

        prefixes = _Prefixes(self.data[0], self.data[-1], int(max(open_first, 0)), int(max(open_last, 0)))
        on_first_up = (first[up] == 0) & (d - 1 <= open_first)
        keys: list[bytes | None] = [None] * len(d)
        parent_keys: list[bytes | None] = [None] * len(d)
        for i in np.flatnonzero(is_open).tolist():
            keys[i] = prefixes.key(0 if on_first[i] else 1, int(d[i]))
        for i in np.flatnonzero(up_open).tolist():
            parent_keys[i] = prefixes.key(0 if on_first_up[i] else 1, int(d[i]) - 1)
        for i in np.flatnonzero(is_end & ~is_open).tolist():
            keys[i] = path_key(self.data[int(own_first[i])])
        kind = np.where(is_open, _OPEN, _FINAL)
        has_parent = (d > 0) & ~up_open
        n = len(d)
        columns = [
            pa.array(kind.tolist(), pa.string()),
            pa.array([block] * n, pa.string()),
            pa.array([part] * n, pa.int32()),
            pa.array(keys, pa.binary()),
            pa.array(parent_keys, pa.binary()),
            pa.array(smallest[node]),
            pa.array(smallest[up], mask=~has_parent),
            pa.array(d),
            pa.array(n_convs[node]),
            pa.array(n_children),
            pa.array(n_leaves[node]),
            pa.array(saved),
            pa.array(is_end),
            pa.nulls(n, pa.binary()),
            pa.nulls(n, pa.list_(pa.int64())),
        ]
        yield pa.RecordBatch.from_arrays(columns, schema=_NODES)

    def _smallest(self, first: np.ndarray, last: np.ndarray) -> np.ndarray:
        """The smallest conversation among the paths of each node."""
        convs = np.array(self.conv, dtype=np.int64)
        # Minima of runs of 1, 2, 4, ... paths; any range is covered by two of them.
        runs = [convs]
        while 2 ** len(runs) <= len(convs):
            half = 2 ** (len(runs) - 1)
            runs.append(np.minimum(runs[-1][:-half], runs[-1][half:]))
        level = np.frexp((last - first + 1).astype(np.float64))[1] - 1
        out = np.empty(len(first), dtype=np.int64)
        for i, run in enumerate(runs):
            at = np.flatnonzero(level == i)
            out[at] = np.minimum(run[first[at]], run[last[at] - 2**i + 1])
        return out


def path_key(path: bytes) -> bytes:
    return hashlib.sha256(path).digest()[:KEY]


def prefix_keys(path: bytes, up_to: int) -> list[bytes]:
    """The key of every prefix of a path, from none of its turns to the first ``up_to``."""
    running, out = hashlib.sha256(), [path_key(b"")]
    for d in range(up_to):
        running.update(path[KEY * d : KEY * (d + 1)])
        out.append(running.copy().digest()[:KEY])
    return out


class _Prefixes:
    """Keys of the prefixes of the first and the last path of a block."""

    def __init__(self, first: bytes, last: bytes, open_first: int, open_last: int):
        self.keys = (prefix_keys(first, open_first), prefix_keys(last, open_last))

    def key(self, side: int, depth: int) -> bytes:
        return self.keys[side][depth]


def common_length(a: bytes, b: bytes) -> int:
    return int(common_prefixes([a, b])[1])


def _blocks(batches: Iterator[pa.RecordBatch], most: int) -> Iterator[Block]:
    """The sorted rows ``path, tokens, n_convs, conv`` of a partition in blocks that know what they share with their neighbours."""
    held, turns, last = None, 0, None
    for batch in batches:
        for path, tokens, n_convs, conv in zip(*(batch.column(i).to_pylist() for i in range(4))):
            if held is not None and turns >= most:
                held.after = common_length(held.data[-1], path)
                yield held
                held, last = Block([], [], [], [], before=held.after), None
                turns = 0
            if held is None:
                held = Block([], [], [], [])
            held.data.append(path)
            held.tokens.append(tokens)
            held.n_convs.append(n_convs)
            held.conv.append(conv)
            turns += len(tokens) + 1
    if held is not None:
        yield held


def _forests(most: int):
    """A function from the sorted paths of a partition to the rows of ``_NODES``."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, nth, block = TaskContext.get().partitionId(), 0, None
        for block in _blocks(batches, most):
            if nth == 0:
                yield _edge(_FIRST, part, block.data[0], block.tokens[0])
            yield from block.nodes(f"{part}:{nth}", part)
            nth += 1
        if block is not None:
            yield _edge(_LAST, part, block.data[-1], block.tokens[-1])

    return run


def _edge(kind: str, part: int, path: bytes, tokens: list[int]) -> pa.RecordBatch:
    values = {"kind": [kind], "part": [part], "path": [path], "tokens": [tokens]}
    return pa.RecordBatch.from_arrays([pa.array(values.get(field.name, [None]), field.type) for field in _NODES], schema=_NODES)


def _corrections(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """What two partitions both counted, for ``path`` and ``tokens`` of the first path of one and ``last`` of the one before."""
    for batch in batches:
        for path, tokens, last in zip(*(batch.column(i).to_pylist() for i in range(3))):
            shared = common_length(last, path)
            keys = prefix_keys(path, shared)
            up_to = np.concatenate([[0], np.cumsum(tokens, dtype=np.int64)])
            d = np.arange(shared + 1)
            columns = [
                pa.array(keys, pa.binary()),
                pa.array(np.where(d < shared, -1, 0)),
                pa.array(np.full(shared + 1, -1 if len(last) == KEY * shared else 0)),
                pa.array(up_to[shared] - up_to[np.maximum(d - 1, 0)]),
            ]
            yield pa.RecordBatch.from_arrays(columns, ["key", "n_children", "n_leaves", "saved_tokens"])


# ---- all blocks ------------------------------------------------------------------


def prefix_trie(turns: DataFrame, conversations: DataFrame | None = None, block_turns: int = BLOCK_TURNS) -> Trie:
    """The trie of the conversations of ``turn_keys`` rows; ``conversations(conv)`` may name more, which have no turns.

    Every distinct sequence of first turns, the empty one included, is a node. Its columns: ``conv`` (the smallest
    conversation that begins with it), ``depth``, ``parent_conv`` (that of its parent, null for the root), ``n_convs``
    (conversations that begin with it), ``n_children``, ``n_leaves`` (childless nodes in its subtree, itself included),
    ``saved_tokens`` (over its subtree, a node's tokens in its last turn times the conversations beyond the first) and ``key``
    (null unless a conversation ends there). Rows with a null conversation are left out, equal turns are one of the other's copies
    at the next depth, and no conversations give no nodes.

    A conversation's keys are held in one row, 24 bytes for each of its turns.
    """
    found = written(paths(turns, conversations))
    ends = found.select("conv", short_hash(F.col("path")).alias("key"))
    distinct = found.groupBy("path").agg(F.first("tokens").alias("tokens"), F.count("*").alias("n"), F.min("conv").alias("conv"))
    ordered = distinct.select("path", "tokens", "n", "conv").repartitionByRange("path").sortWithinPartitions("path")
    rows = written(ordered.mapInArrow(_forests(block_turns), from_arrow_schema(_NODES)))
    final, opened = (rows.where(F.col("kind") == kind) for kind in (_FINAL, _OPEN))

    parts = opened.select("key", "parent_key", "conv", "depth", *_FIGURES, "is_end")
    nothing = [F.lit(None).cast(opened.schema[name].dataType).alias(name) for name in ("parent_key", "conv", "depth", "is_end")]
    twice = _at_bounds(rows).select("key", *nothing, F.lit(0).cast("long").alias("n_convs"), *_FIGURES[1:])
    spines = written(
        parts.unionByName(twice)
        .groupBy("key")
        .agg(
            F.max("parent_key").alias("parent_key"),
            F.min("conv").alias("conv"),
            F.max("depth").alias("depth"),
            *(F.sum(name).alias(name) for name in _FIGURES),
            F.max("is_end").alias("is_end"),
        )
    )
    of = spines.select(F.col("key").alias("of"), F.col("conv").alias("parent_conv"))
    across = spines.join(of, F.col("parent_key") == F.col("of"), "left")
    # The parent of a final node may be open. Each block has it at most once, so a block, not a parent, is what nodes share.
    in_block = opened.select("block", "key").join(of, F.col("key") == F.col("of"))
    in_block = in_block.select(F.col("block").alias("of_block"), F.col("key").alias("of_key"), F.col("parent_conv").alias("of_conv"))
    under = final.where("parent_key is not null").join(
        in_block, (F.col("block") == F.col("of_block")) & (F.col("parent_key") == F.col("of_key"))
    )
    names = ("conv", "depth", "parent_conv", *_FIGURES, F.when(F.col("is_end"), F.col("key")).alias("key"))
    nodes = (
        final.where("parent_key is null").select(*names)
        .unionByName(under.withColumn("parent_conv", F.col("of_conv")).select(*names))
        .unionByName(across.select(*names))
    )
    return Trie(nodes, ends)


def _at_bounds(rows: DataFrame) -> DataFrame:
    """The rows of ``_corrections`` for every two partitions that follow each other."""
    spark = rows.sparkSession
    edges = rows.where(F.col("kind").isin(_FIRST, _LAST)).select("kind", "part", "path", "tokens")
    # One number for each partition, of which there are at most spark.sql.shuffle.partitions.
    numbers = sorted(row.part for row in edges.where(F.col("kind") == _FIRST).select("part").collect())
    follows = spark.createDataFrame(list(zip(numbers, numbers[1:])), "before int, after int")
    first = edges.where(F.col("kind") == _FIRST).select(F.col("part").alias("after"), "path", "tokens")
    last = edges.where(F.col("kind") == _LAST).select(F.col("part").alias("before"), F.col("path").alias("last"))
    pairs = follows.join(first, "after").join(last, "before").select("path", "tokens", "last")
    return pairs.mapInArrow(_corrections, "key binary, n_children long, n_leaves long, saved_tokens long")


def digests(ends: DataFrame) -> DataFrame:
    """``key`` and ``sha256`` (of the decimal ``conv`` numbers in ascending order, joined by commas) of the rows of each key.

    Very many rows may have one key. They are sorted by range, and written out in pieces of text by all tasks. A hash takes its
    input in turn, so the pieces of one key pass through one task, which holds one of them at a time.
    """
    ordered = ends.select("key", "conv").repartitionByRange("key", "conv").sortWithinPartitions("key", "conv")
    told = ordered.mapInArrow(_told, "key binary, conv long, text string")
    rows = told.repartition("key").sortWithinPartitions("key", "conv")
    return rows.mapInArrow(_hashed, "key binary, sha256 string")


def _runs(keys: list[bytes]) -> Iterator[tuple[int, int]]:
    """Where runs of equal keys begin and end."""
    start = 0
    for i in range(1, len(keys) + 1):
        if i == len(keys) or keys[i] != keys[start]:
            yield start, i
            start = i


def _told(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Every run of a key within a batch, as its first number and its text."""
    for batch in batches:
        keys, convs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
        rows = [(keys[a], convs[a], ",".join(map(str, convs[a:b]))) for a, b in _runs(keys)]
        if rows:
            yield pa.RecordBatch.from_arrays([pa.array(x, kind) for x, kind in zip(zip(*rows), (pa.binary(), pa.int64(), pa.string()))], ["key", "conv", "text"])


def _hashed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    key, running = None, None
    for batch in batches:
        done: list[tuple[bytes, str]] = []
        for new, text in zip(batch.column(0).to_pylist(), batch.column(2).to_pylist()):
            if running is not None and new == key:
                running.update(b"," + text.encode())
                continue
            if running is not None:
                done.append((key, running.hexdigest()))
            key, running = new, hashlib.sha256(text.encode())
        if done:
            yield _pairs(done)
    if running is not None:
        yield _pairs([(key, running.hexdigest())])


def _pairs(rows: list[tuple[bytes, str]]) -> pa.RecordBatch:
    keys, hashes = zip(*rows)
    return pa.RecordBatch.from_arrays([pa.array(keys, pa.binary()), pa.array(hashes, pa.string())], ["key", "sha256"])
