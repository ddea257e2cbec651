"""SentencePiece encoding by sampling from the piece lattice, and decoding.

The lattice of a text has a node at every byte and an arc for every piece that stands there. Forward
filtering sums up the weights of all ways to a node; backward sampling walks from the end
and draws one of the arcs that lead to the node, in proportion to their share. That draws a whole
segmentation with the probability its pieces give it. The random numbers are hashes of the
row's key, so a row is always cut the same way, wherever and however often it is encoded.

Both passes work on arrays, for many texts at once:

* A text falls apart between two characters whose bytes are neighbours in no piece, since
  no arc crosses there. The lattices of the chunks in between are independent.
* Equal chunks share one lattice; only the backward walks differ.

Spaces are the piece model's word marks, and a text begins with one that decoding takes away. A
character without a piece is written as its bytes, so decoding gives back every text.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
import sentencepiece
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailweave.llm.batches import pieces, quoted, text_bytes
from retailweave.llm.words import Spans, mixed, span_hashes, utf8

ALPHA = 0.5  # power of the pieces' probabilities; 0 makes all segmentations alike, larger ones favour the likely
SEED = 0

_MARK = "▁"
_BATCH_BYTES = 2 << 20  # of text that is looked through for equal chunks
_LATTICE_BYTES = 128 << 10  # of distinct chunks whose lattices are held, in some hundred times as much memory
_SLOT_BITS = 18


@dataclass(frozen=True)
class Vocabulary:
    """Pieces as bytes, with spaces for word marks; their ids, and ranks from the best score down."""

    pieces: tuple[bytes, ...]
    ids: tuple[int, ...]
    ranks: tuple[int, ...]
    byte_ids: tuple[int, ...]


def read_vocabulary(path: str) -> Vocabulary:
    """The pieces of a model file with byte fallback. Control and unused pieces are never used."""
    with open(path, "rb") as file:
        model = sentencepiece.SentencePieceProcessor(model_proto=file.read())
    byte_ids, usable = [-1] * 256, []
    for i in range(model.get_piece_size()):
        piece = model.id_to_piece(i)
        if model.is_byte(i):
            byte_ids[int(piece[3:5], 16)] = i
        elif not (model.is_control(i) or model.is_unknown(i) or model.is_unused(i)):
            usable.append((-model.get_score(i), i, piece.replace(_MARK, " ").encode()))
    if min(byte_ids) < 0:
        raise ValueError("the model has no byte fallback, so not every text could be decoded")
    rank = {i: nth for nth, (_, i, _) in enumerate(sorted(usable))}
    return Vocabulary(tuple(x[2] for x in usable), tuple(x[1] for x in usable), tuple(rank[x[1]] for x in usable), tuple(byte_ids))


class Lattice:
    """Encodes and decodes with a vocabulary. A piece of rank r has the probability of Zipf's law, 1 / (r + 1)."""

    def __init__(self, vocabulary: Vocabulary, alpha: float = ALPHA):
        n = len(vocabulary.pieces)
        total = np.log(np.sum(1 / np.arange(1, n + 2)))
        weight = alpha * (-np.log(np.array(vocabulary.ranks) + 1.0) - total)
        self.byte_weight = alpha * (-np.log(n + 1.0) - total)
        self.byte_ids = np.array(vocabulary.byte_ids, dtype=np.int32)
        data = np.frombuffer(b"".join(vocabulary.pieces), np.uint8)
        end = np.cumsum([len(piece) for piece in vocabulary.pieces])
        start = np.concatenate([[0], end[:-1]])
        hashes, ids, length = span_hashes(data, start, end), np.array(vocabulary.ids, dtype=np.int32), end - start
        self.lengths = [int(size) for size in np.unique(length)]
        self.hashes, self.ids, self.weight = hashes, ids, weight
        # A hash table: a slot holds one of its pieces, and every piece the next of its slot.
        self.slot, self.next = np.full(1 << _SLOT_BITS, -1, dtype=np.int32), np.full(n, -1, dtype=np.int32)
        for piece, slot in enumerate((hashes >> np.uint64(64 - _SLOT_BITS)).tolist()):
            self.next[piece], self.slot[slot] = self.slot[slot], piece
        # Whether two bytes are neighbours in a piece.
        self.neighbours = np.zeros((256, 256), dtype=bool)
        inner = np.ones(len(data), dtype=bool)
        inner[end - 1] = False
        at = np.flatnonzero(inner)
        self.neighbours[data[at], data[at + 1]] = True
        most = max([*vocabulary.ids, *vocabulary.byte_ids]) + 1
        of_id: list[bytes] = [b""] * most
        for piece, i in zip(vocabulary.pieces, vocabulary.ids):
            of_id[i] = piece
        for byte, i in enumerate(vocabulary.byte_ids):
            of_id[i] = bytes([byte])
        self.id_bytes = np.frombuffer(b"".join(of_id), np.uint8)
        self.id_end = np.cumsum([len(piece) for piece in of_id])
        self.id_length = np.diff(self.id_end, prepend=0)

    # ---- encoding ----

    def encode(self, texts: pa.Array, keys: np.ndarray) -> pa.ListArray:
        """Sampled piece ids of each text; ``keys`` are 64-bit numbers that decide the draws. Null for null, none for empty."""
        data, bounds = utf8(pc.if_else(pc.equal(pc.binary_length(texts), 0), "", pc.binary_join_element_wise(" ", texts, "")))
        cut = np.zeros(len(data) + 1, dtype=bool)
        cut[1:-1] = ~self.neighbours[data[:-1], data[1:]] & ((data[1:] & 0xC0) != 0x80)
        cut[bounds] = True
        cuts = np.flatnonzero(cut)
        start, end = cuts[:-1], cuts[1:]
        owner = np.searchsorted(bounds, start, "right") - 1
        n_chunks = np.bincount(owner, minlength=len(texts))
        nth = np.arange(len(start)) - np.repeat(np.cumsum(n_chunks) - n_chunks, n_chunks)
        ids, n_pieces = self._sample(data, start, end, mixed(keys[owner] + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))
        per_text = np.bincount(owner, weights=n_pieces, minlength=len(texts)).astype(np.int64)
        offsets = pa.array(np.concatenate([[0], np.cumsum(per_text)]).astype(np.int32), mask=np.append(np.asarray(texts.is_null()), False))
        return pa.ListArray.from_arrays(offsets, pa.array(ids))

    def _sample(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, seeds: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Piece ids of all chunks in turn, and their number by chunk."""
        n_pieces, steps = np.zeros(len(start), dtype=np.int64), []
        # Equal chunks one after the other, and the first of each kind.
        hashes = span_hashes(data, start, end)
        order = np.argsort(hashes, kind="stable")
        new = np.flatnonzero(np.diff(hashes[order], prepend=~hashes[order[:1]]))
        sample, bounds = order[new], np.append(new, len(order))
        total = np.cumsum((end - start)[sample])
        at = 0
        while at < len(sample):
            before = total[at - 1] if at else 0
            stop = max(at + 1, int(np.searchsorted(total, before + _LATTICE_BYTES, "right")))
            walks = order[bounds[at] : bounds[stop]]
            kind = np.repeat(np.arange(stop - at), np.diff(bounds[at : stop + 1]))
            for step, (walk, ids) in enumerate(self._walk(data, start[sample[at:stop]], end[sample[at:stop]], kind, seeds[walks])):
                steps.append((walks[walk], step, ids))
                n_pieces[walks[walk]] += 1
            at = stop
        out, last = np.empty(n_pieces.sum(), dtype=np.int32), np.cumsum(n_pieces) - 1
        for walk, step, ids in steps:
            out[last[walk] - step] = ids
        return out, n_pieces

    def _walk(self, data: np.ndarray, start: np.ndarray, end: np.ndarray, kind: np.ndarray, seeds: np.ndarray):
        """Draws a segmentation of the chunk ``kind`` for each seed, from its end: yields walks and their next piece."""
        length = end - start
        # The chunks, one after the other, with one node more than bytes each.
        first = np.cumsum(length) - length
        inside = np.arange(length.sum()) - np.repeat(first, length)
        own = data[np.repeat(start, length) + inside]
        first_node = first + np.arange(len(length))
        node_of = np.arange(len(own)) + np.repeat(np.arange(len(length)), length)
        source, target, ids, weight = self._arcs(own, np.repeat(first + length, length))
        source, target = node_of[source], node_of[target - 1] + 1
        arcs = _sampler(source, target, weight, target - np.repeat(first_node, length + 1)[target], int(node_of[-1]) + 2)
        node, goal, walk, step = (first_node + length)[kind], first_node[kind], np.arange(len(kind)), 0
        while len(walk):
            arc = arcs.draw(node, mixed(seeds[walk] + np.uint64(step)) >> np.uint64(32))
            yield walk, ids[arc]
            node = source[arc]
            left = node > goal
            node, goal, walk = node[left], goal[left], walk[left]
            step += 1

    def _arcs(self, data: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...]:
        """From, to, piece id and weight of all arcs, in bytes of ``data``; ``stop`` is the end of each byte's chunk."""
        begins = (data & 0xC0) != 0x80
        char_length = np.where(data < 0x80, 1, np.where(data < 0xE0, 2, np.where(data < 0xF0, 3, 4)))
        at, left = np.flatnonzero(begins), (stop - np.arange(len(data)))[begins]
        alone = np.zeros(len(data), dtype=bool)  # characters that are a piece
        found = []
        spans = Spans(data)
        for size in self.lengths:
            fits = left >= size
            at, left = at[fits], left[fits]
            if not len(at):
                break
            own = spans.hashes(at, at + size)
            piece = self.slot[own >> np.uint64(64 - _SLOT_BITS)]
            here = np.flatnonzero(piece >= 0)
            piece = piece[here]
            while len(here):
                same = self.hashes[piece] == own[here]
                start = at[here[same]]
                found.append((start, start + size, self.ids[piece[same]], self.weight[piece[same]]))
                if size <= 4:
                    alone[start[char_length[start] == size]] = True
                piece = np.where(same, -1, self.next[piece])
                here, piece = here[piece >= 0], piece[piece >= 0]
        char = np.cumsum(begins) - 1
        single = np.flatnonzero(~alone[np.flatnonzero(begins)][char])
        found.append((single, single + 1, self.byte_ids[data[single]], np.full(len(single), self.byte_weight)))
        return tuple(np.concatenate(columns) for columns in zip(*found))

    # ---- decoding ----

    def decode(self, lists: pa.Array) -> pa.Array:
        """The texts of lists of piece ids; null for null."""
        ids = np.asarray(lists.flatten(), dtype=np.int64)
        length = self.id_length[ids]
        end = np.cumsum(length)
        data = self.id_bytes[np.arange(length.sum()) + np.repeat(self.id_end[ids] - end, length)]
        n_ids = np.asarray(pc.fill_null(pc.list_value_length(lists), 0), dtype=np.int64)
        bounds = np.concatenate([[0], end])[np.concatenate([[0], np.cumsum(n_ids)])]
        keep = np.ones(len(data), dtype=bool)
        keep[bounds[:-1][n_ids > 0]] = False  # the word mark every text begins with
        offsets = np.concatenate([[0], np.cumsum(np.diff(bounds) - (n_ids > 0))])
        texts = pa.LargeStringArray.from_buffers(len(lists), pa.py_buffer(offsets.astype(np.int64)), pa.py_buffer(data[keep].tobytes()))
        return pc.if_else(lists.is_null(), pa.scalar(None, pa.large_string()), texts)


@dataclass(frozen=True)
class _Sampler:
    """The arcs by target node: where a node's begin, their numbers, and up to where each reaches, in 2 ** -32."""

    first: np.ndarray
    order: np.ndarray
    reach: np.ndarray

    def draw(self, node: np.ndarray, number: np.ndarray) -> np.ndarray:
        """An arc into each node, by a number of 32 bits."""
        at = self.first[node]
        further = np.flatnonzero(self.reach[at] <= number)
        while len(further):
            at[further] += 1
            further = further[self.reach[at[further]] <= number[further]]
        return self.order[at]


def _sampler(source: np.ndarray, target: np.ndarray, weight: np.ndarray, depth: np.ndarray, n_nodes: int) -> _Sampler:
    """Forward filtering; ``depth`` is the place of an arc's target in its chunk, by which nodes are gone through."""
    # A node's arcs come together, in the order in which they were found, which is that of their length.
    order = np.argsort(depth * n_nodes + target, kind="stable")
    source, target, weight, depth = source[order], target[order], weight[order], depth[order]
    ways = np.zeros(n_nodes)  # logarithm of the weight of all ways from the chunk's start
    share = np.empty(len(source))
    edges = np.flatnonzero(np.diff(depth, prepend=-1, append=-1))
    for a, b in zip(edges[:-1], edges[1:]):
        x = ways[source[a:b]] + weight[a:b]
        node = np.flatnonzero(np.diff(target[a:b], prepend=-1))
        n_arcs = np.diff(node, append=b - a)
        most = np.maximum.reduceat(x, node)
        x = np.exp(x - np.repeat(most, n_arcs))
        total = np.add.reduceat(x, node)
        ways[target[a:b][node]] = most + np.log(total)
        share[a:b] = x / np.repeat(total, n_arcs)
    first = np.flatnonzero(np.diff(target, prepend=-1))
    n_arcs = np.diff(first, append=len(target))
    # Summed up arc by arc, so that a node's numbers do not depend on what else is in the batch.
    for nth in range(1, int(n_arcs.max())):
        at = first[n_arcs > nth] + nth
        share[at] += share[at - 1]
    reach = np.floor(share * (1 << 32)).astype(np.uint64)
    reach[first + n_arcs - 1] = 1 << 32
    first_of = np.zeros(n_nodes, dtype=np.int64)
    first_of[target[first]] = first
    return _Sampler(first_of, order, reach)


ENCODED = T.StructType([T.StructField("piece_ids", T.ArrayType(T.IntegerType()))])
DECODED = T.StructType([T.StructField("decoded", T.StringType())])


def encode(
    df: DataFrame,
    vocabulary: Vocabulary,
    key: str = "doc_id",
    text: str = "text",
    keep: list[str] | None = None,
    alpha: float = ALPHA,
    seed: int = SEED,
) -> DataFrame:
    """``piece_ids``: a sampled segmentation of every whole text. Rows with equal keys and texts are cut alike.

    Null texts have null ids and empty ones none; a null key is a key. The columns ``keep`` (all by
    default) stay; those named like a result are replaced.
    """
    return _encoded(df, vocabulary, key, text, keep, alpha, seed, ENCODED)


def round_trip(df: DataFrame, vocabulary: Vocabulary, key: str = "doc_id", text: str = "text", keep: list[str] | None = None) -> DataFrame:
    """``piece_ids`` as ``encode`` gives them and ``decoded``, the text that ``decode`` makes of them, in one pass."""
    return _encoded(df, vocabulary, key, text, keep, ALPHA, SEED, T.StructType(ENCODED.fields + DECODED.fields))


def _encoded(df, vocabulary: Vocabulary, key: str, text: str, keep, alpha: float, seed: int, added: T.StructType) -> DataFrame:
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)
    new = set(added.names)
    kept = [name for name in (df.columns if keep is None else keep) if name.lower() not in new]
    schema = T.StructType([df.schema[name] for name in kept] + added.fields)

    def run(batches):
        lattice = Lattice(shared.value, alpha)
        for batch in batches:
            texts = batch.column(len(kept))
            for piece in pieces(batch, text_bytes(texts), _BATCH_BYTES):
                keys = np.asarray(piece.column(len(kept) + 1), dtype=np.int64).view(np.uint64)
                columns = [lattice.encode(piece.column(len(kept)), keys)]
                if len(added) > 1:
                    columns.append(lattice.decode(columns[0]).cast(pa.string()))
                yield pa.RecordBatch.from_arrays([*piece.columns[: len(kept)], *columns], schema.names)

    source = [quoted(name) for name in kept]
    key_number = F.xxhash64(F.lit(seed), quoted(key)).alias("__key")
    return df.select(*source, quoted(text).cast("string").alias("__text"), key_number).mapInArrow(run, schema)


def decode(df: DataFrame, vocabulary: Vocabulary, ids: str = "piece_ids", keep: list[str] | None = None) -> DataFrame:
    """``decoded``: the texts of the piece ids; null for null. The columns ``keep`` (all by default) stay."""
    shared = df.sparkSession.sparkContext.broadcast(vocabulary)
    kept = [name for name in (df.columns if keep is None else keep) if name.lower() != "decoded"]
    schema = T.StructType([df.schema[name] for name in kept] + DECODED.fields)

    def run(batches):
        lattice = Lattice(shared.value)
        for batch in batches:
            lists = batch.column(len(kept))
            sizes = np.asarray(pc.fill_null(pc.list_value_length(lists), 0), dtype=np.int64)
            for piece in pieces(batch, 4 * sizes, _BATCH_BYTES):
                texts = lattice.decode(piece.column(len(kept))).cast(pa.string())
                yield pa.RecordBatch.from_arrays([*piece.columns[: len(kept)], texts], schema.names)

    return df.select(*(quoted(name) for name in kept), quoted(ids).alias("__ids")).mapInArrow(run, schema)
