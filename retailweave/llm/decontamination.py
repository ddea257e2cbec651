"""Benchmark decontamination by Wu-Manber multi-pattern search over words.

Patterns are the windows of 13 consecutive words of the benchmark items; an item of
fewer words, but not none, is one window. Patterns of one length m are searched
together, for blocks of two words (one, if m is 1):

* a shift table says for the block that ends at a position how far the search may
  move on without missing a pattern, and most blocks occur in no pattern;
* where the shift is 0, the hash of the block names the bucket of the patterns that
  end in it;
* the bucket's patterns are compared with the text word by word, as bytes.

The benchmark is a table in the shared folder, in parts of about ``part_bytes`` of text. A task holds one part at a
time and goes through all of them for each lot of documents (``batches``); the driver holds none. Items longer than
``PIECE_BYTES`` are cut into pieces that overlap by a window less one word.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.parquet as pq
from pyarrow import fs
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailweave.llm.batches import PIECE_BYTES, add_columns_by_parts, packed, pieces, quoted, text_bytes, unpacked
from retailweave.llm.words import Words, mixed
from retailweave.sinks.scratch import written

WINDOW = 13
PART_BYTES = 16 * 1024 * 1024  # of benchmark text that a task holds, at about ten bytes for each
MIN_SHARE = 20  # contaminated: at least one word in so many is hit

_TABLE_BITS = 20
_SEGMENT = 512
_STATE = T.StructType(
    [
        T.StructField("n_words", T.LongType()),
        T.StructField("n_hit", T.LongType()),
        T.StructField("item_ids", T.ArrayType(T.StringType())),
        T.StructField("hit_spans", T.ArrayType(T.IntegerType())),
    ]
)


class _Patterns:
    """The distinct patterns of one length, with their shift table and suffix buckets.

    A pattern is ``words`` words of the benchmark from the place ``begin`` on; ``owner[first_owner[p]:first_owner[p + 1]]`` are its items.
    """

    def __init__(self, benchmark: Words, words: int, begin: np.ndarray, items: np.ndarray):
        self.benchmark, self.words, self.block = benchmark, words, min(2, words)
        hashes = benchmark.hashes
        # Equal windows come together, and the first of them stands for all.
        key = np.zeros(len(begin), dtype=np.uint64)
        for k in range(words):
            key = mixed(key * np.uint64(0x9E3779B97F4A7C15) + hashes[begin + k])
        order = np.lexsort((items, begin, key))
        begin, items, key = begin[order], items[order], key[order]
        new = np.ones(len(begin), dtype=bool)
        new[1:] = key[1:] != key[:-1]
        for k in range(words):
            new[1:] |= hashes[begin[1:] + k] != hashes[begin[:-1] + k]
        self.begin = begin[new]
        self.owner, self.first_owner = items, np.append(np.flatnonzero(new), len(begin))
        per_pattern = words - self.block + 1
        blocks = _blocks(hashes, self.block)
        self.shift = np.full(1 << _TABLE_BITS, per_pattern, dtype=np.uint8 if per_pattern < 256 else np.int64)
        for at in range(per_pattern):
            np.minimum.at(self.shift, _slot(blocks[self.begin + at]), per_pattern - 1 - at)
        suffix = blocks[self.begin + per_pattern - 1]
        self.order = np.argsort(suffix, kind="stable")
        self.suffixes = suffix[self.order]

    def items(self, pattern: int) -> np.ndarray:
        return self.owner[self.first_owner[pattern] : self.first_owner[pattern + 1]]

    def equals(self, words: Words, at: int, pattern: int) -> bool:
        """Whether the words from ``at`` on are those of the pattern, by their bytes."""
        begin = int(self.begin[pattern])
        return all(words.word(at + k) == self.benchmark.word(begin + k) for k in range(self.words))


def _blocks(hashes: np.ndarray, size: int) -> np.ndarray:
    """Hashes of the blocks of ``size`` words along the last axis."""
    return hashes if size == 1 else mixed(hashes[..., :-1] * np.uint64(0x9E3779B97F4A7C15) + hashes[..., 1:])


def _slot(blocks: np.ndarray) -> np.ndarray:
    return (blocks >> np.uint64(64 - _TABLE_BITS)).astype(np.int64)


def pattern_sets(texts: pa.Array, window: int = WINDOW) -> list[_Patterns]:
    """The patterns of the items' texts, by length. Items without a word have none."""
    words = Words(texts)
    size = np.minimum(words.count, window)
    out = []
    for length in np.unique(size[size > 0]).tolist():
        items = np.flatnonzero(size == length)
        n = words.count[items] - length + 1
        step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
        out.append(_Patterns(words, length, np.repeat(words.first[items], n) + step, np.repeat(items, n)))
    return out


def occurrences(words: Words, patterns: _Patterns) -> Iterator[tuple[int, int]]:
    """All ``(first word, pattern)`` that occur within one text."""
    m = patterns.words
    long_enough = words.count >= m
    starts = words.first[:-1][long_enough]
    if not len(starts):
        return
    blocks = _blocks(words.hashes, patterns.block)
    shifts = patterns.shift[_slot(blocks)]
    # A cursor walks over the last words of possible occurrences; long texts get several.
    n_ends = words.count[long_enough] - m + 1
    n_cursors = -(-n_ends // _SEGMENT)
    nth = np.arange(n_cursors.sum()) - np.repeat(np.cumsum(n_cursors) - n_cursors, n_cursors)
    at = np.repeat(starts + m - 1, n_cursors) + nth * _SEGMENT
    stop = np.minimum(at + _SEGMENT, np.repeat(starts + m - 1 + n_ends, n_cursors))
    candidates = []
    while len(at):
        shift = shifts[at - patterns.block + 1].astype(np.int64)
        candidates.append(at[shift == 0])
        at = at + np.maximum(shift, 1)
        left = at < stop
        at, stop = at[left], stop[left]
    ends = np.concatenate(candidates)
    block = blocks[ends - patterns.block + 1]
    low = np.searchsorted(patterns.suffixes, block, "left")
    size = np.searchsorted(patterns.suffixes, block, "right") - low
    begin = np.repeat(ends - m + 1, size)
    nth = np.arange(size.sum()) - np.repeat(np.cumsum(size) - size, size)
    pattern = patterns.order[np.repeat(low, size) + nth]
    for k in range(m):
        same = words.hashes[begin + k] == patterns.benchmark.hashes[patterns.begin[pattern] + k]
        begin, pattern = begin[same], pattern[same]
    for i, p in zip(begin.tolist(), pattern.tolist()):
        if patterns.equals(words, i, p):
            yield i, p


def search(
    documents: DataFrame,
    benchmark: DataFrame,
    text: str = "text",
    item: str = "item_id",
    item_text: str = "text",
    keep: list[str] | None = None,
    window: int = WINDOW,
    part_bytes: int = PART_BYTES,
) -> DataFrame:
    """Per document: ``n_words``, ``n_hit`` (words inside any occurrence), ``item_ids`` (of items with
    occurring windows, as strings, sorted) and ``hit_spans`` (first word and end of each hit run, in turn).

    The columns ``keep`` (all by default) stay; those named like a result are replaced.
    Null and wordless texts have no words and no hits; items whose text is null or wordless
    have no window. Items with equal ids count once; one without an id marks words and is not listed.
    """
    parts = benchmark_parts(benchmark, item, item_text, window, part_bytes)
    return add_columns_by_parts(documents, text, _STATE, lambda: _Visitor(window), parts, keep)


def benchmark_parts(benchmark: DataFrame, item: str, item_text: str, window: int, part_bytes: int) -> list[str]:
    """Files in the shared folder with all items, each of about ``part_bytes`` of text, or of one piece of an item."""
    texts = benchmark.select(quoted(item).cast("string").alias("item"), quoted(item_text).cast("string").alias("text"))
    cut = written(texts.where("text is not null").mapInArrow(lambda batches: _pieces(batches, window, part_bytes), "item string, text string"))
    total = cut.agg(F.sum(F.octet_length("text"))).first()[0]
    if not total:
        return []
    n = -(-total // part_bytes)
    part = F.pmod(F.xxhash64("item", "text"), F.lit(n)).cast("int")
    return sorted(written(cut.repartitionById(n, part)).inputFiles())


def _pieces(batches: Iterator[pa.RecordBatch], window: int, part_bytes: int) -> Iterator[pa.RecordBatch]:
    """The items, long ones in pieces that have every window of theirs."""
    most = min(PIECE_BYTES, part_bytes)
    for batch in batches:
        for piece in pieces(batch, text_bytes(batch.column(1))):
            if piece.num_rows > 1 or len(piece.column(1)[0].as_buffer()) <= most:
                yield piece
                continue
            words = Words(piece.column(1))
            at, n = 0, len(words.start)
            while at < n:
                stop = int(np.searchsorted(words.end, words.start[at] + most, "right"))
                stop = min(n, max(stop, at + window))
                text = words.data[words.start[at] : words.end[stop - 1]].tobytes().decode()
                yield pa.RecordBatch.from_arrays([piece.column(0), pa.array([text], piece.column(1).type)], piece.schema.names)
                at = n if stop == n else stop - window + 1


class _Visitor:
    """Finds the windows of one part of the benchmark after the other in slices of texts."""

    def __init__(self, window: int):
        self.window = window

    def load(self, part: str) -> tuple[list[str | None], list[_Patterns]]:
        system, path = fs.FileSystem.from_uri(part)
        with system.open_input_file(path) as source:
            table = pq.ParquetFile(source).read(["item", "text"])
        return table["item"].to_pylist(), pattern_sets(table["text"].combine_chunks(), self.window)

    def begin(self, texts: pa.Array) -> tuple[dict[int, set[str]], dict[int, list[tuple[int, int]]]]:
        """By row, the items that were found and the first word and end of what they hit."""
        return {}, {}

    def visit(self, loaded, texts: pa.Array, state) -> None:
        ids, sets = loaded
        items, spans = state
        words = Words(texts)
        for patterns in sets:
            for begin, pattern in occurrences(words, patterns):
                row = int(words.text_of[begin])
                at = begin - int(words.first[row])
                own = spans.setdefault(row, [])
                if own and own[-1][0] <= at <= own[-1][1]:
                    own[-1] = (own[-1][0], max(own[-1][1], at + patterns.words))
                else:
                    own.append((at, at + patterns.words))
                items.setdefault(row, set()).update(ids[i] for i in patterns.items(pattern).tolist() if ids[i] is not None)

    def end(self, texts: pa.Array, state) -> list[pa.Array]:
        items, spans = state
        count = Words(texts).count
        n_hit, joined = np.zeros(len(texts), dtype=np.int64), [[] for _ in range(len(texts))]
        for row, own in spans.items():
            for at, stop in sorted(own):
                if joined[row] and at <= joined[row][-1]:
                    joined[row][-1] = max(joined[row][-1], stop)
                else:
                    joined[row] += [at, stop]
            n_hit[row] = sum(joined[row][1::2]) - sum(joined[row][::2])
        return [
            pa.array(count, pa.int64()),
            pa.array(n_hit, pa.int64()),
            pa.array([sorted(items.get(row, ())) for row in range(len(texts))], pa.list_(pa.string())),
            pa.array(joined, pa.list_(pa.int32())),
        ]


def contaminated(min_share: int = MIN_SHARE):
    """Whether at least one word in ``min_share`` of a searched document is hit."""
    return (F.col("n_hit") > 0) & (min_share * F.col("n_hit") >= F.col("n_words"))


def decontaminate(documents: DataFrame, benchmark: DataFrame, text: str = "text", min_share: int = MIN_SHARE, **options) -> DataFrame:
    """The documents that are not contaminated, with their own columns. Null texts stay."""
    marked = search(packed(documents, text), benchmark, "__text", keep=["__others", "__text"], **options)
    return unpacked(marked.where(~contaminated(min_share)), documents.columns, text)
