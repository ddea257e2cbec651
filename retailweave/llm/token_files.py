"""Token ids in flat binary files, with 64-bit document offsets, to be memory-mapped.

Documents are put in order of their id by range. Every partition encodes its texts and writes them one
after the other to pairs of files:

* ``<name>.bin``: the token ids and nothing else, as little-endian unsigned integers of ``width`` bytes
  (2 if the vocabulary allows, 4 otherwise);
* ``<name>.idx``: ``TOKENIDX`` and three 64-bit numbers (version, width, number of documents n), n + 1
  offsets, n document ids, all 64-bit and little-endian, and n bytes that are 1 where the id is null. An offset
  is the number of ids before a document in the file, the last one that of all ids.

A table of the files gives each its ``first_token`` and ``first_document`` among all: prefix sums over the
files of a partition and over the partitions. So a document starts at its offset plus the file's first token.

Texts are cut where a byte-level tokenizer always begins a new word, so the ids of a text are those of its pieces, one
after the other, and the library encodes each distinct piece of a slice of texts once.
"""

from __future__ import annotations

import os
import struct
import uuid
from collections.abc import Iterator
from functools import cache

import numpy as np
import pyarrow as pa
from pyarrow import fs
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window as W
from tokenizers import Tokenizer

from retailweave.llm.batches import pieces, quoted, text_bytes
from retailweave.llm.words import mixed, utf8
from retailweave.sinks.scratch import written

FILE_BYTES = 256 * 1024 * 1024  # of token ids in a file, after which a task begins another
FILE_DOCUMENTS = 1 << 20  # documents in a file; offsets and ids of one are held until it is closed
READ_TOKENS = 1 << 20  # ids that a task reads at a time, or those of one document
TASK_TOKENS = 1 << 24  # ids that a task reads in all

_MAGIC, _VERSION = b"TOKENIDX", 1
_HEAD = struct.Struct("<8sqqq")
_SLICE_BYTES = 2 << 20  # of text that are encoded at a time

FILES = "part int, nth int, path string, width int, n_documents long, n_tokens long, first_document long, first_token long"


# ---- encoding ------------------------------------------------------------------

_SPACE, _BREAK, _LETTER, _DIGIT, _MARK, _QUOTE, _OTHER = range(7)


def _byte_classes() -> np.ndarray:
    """The class of every ASCII byte; bytes beyond ASCII are ``_OTHER`` here."""
    of = np.full(256, _OTHER, dtype=np.uint8)
    for code in range(33, 127):
        char = chr(code)
        of[code] = _LETTER if char.isalpha() else _DIGIT if char.isdigit() else _QUOTE if char == "'" else _MARK
    of[32] = _SPACE
    of[9:14] = _BREAK
    return of


def _cuts() -> np.ndarray:
    """Whether a new word always begins between a byte of one class and a byte of another.

    Words are contractions, runs of letters, of digits or of marks, each with one blank before it or none, and runs of
    white space. After an apostrophe letters may belong to a contraction, and a blank to the word that follows.
    """
    table = np.zeros((7, 7), dtype=bool)
    runs = (_LETTER, _DIGIT, _MARK, _QUOTE)
    for before in runs:
        table[before, [_SPACE, _BREAK]] = True
        table[before, [after for after in runs if after != before]] = True
    table[_QUOTE, _LETTER] = table[_QUOTE, _MARK] = table[_MARK, _QUOTE] = False
    table[_BREAK, list(runs)] = True
    return table


_CLASS, _CUT = _byte_classes(), _cuts()
_MASK = np.array([(1 << 8 * n) - 1 for n in range(9)], dtype=np.uint64)
_SLOT_BITS = 21
_SHORT = 15  # bytes of a piece whose ids are remembered
_FEW = 4  # ids of such a piece


def piece_starts(data: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """Where the pieces of texts begin in their UTF-8 bytes: at each text that is not empty and at safe cuts.

    A safe cut is one where the usual pattern of byte-level tokenizers always begins a new word, whatever comes before
    and after, and after which the words are those of the rest alone. ASCII and the letters U+00C0 to U+017F are told apart.
    """
    n = len(data)
    of = _CLASS[data]
    latin = np.flatnonzero((data[:-1] >= 0xC3) & (data[:-1] <= 0xC5))
    signs = (data[latin] == 0xC3) & ((data[latin + 1] == 0x97) | (data[latin + 1] == 0xB7))
    latin = latin[~signs]
    of[latin] = of[latin + 1] = _LETTER
    cut = np.zeros(n, dtype=bool)
    cut[1:] = _CUT[of[:-1], of[1:]]
    edge = np.zeros(n + 1, dtype=bool)
    edge[bounds] = True
    # Two characters of white space are told apart by what follows, so there is no cut after more than one.
    blank = of <= _BREAK
    cut[2:] &= ~(blank[1:-1] & (blank[:-2] | (of[:-2] == _OTHER)) & ~edge[1:-1][: n - 2])
    return np.flatnonzero(cut | edge[:n])


class Encoder:
    """Token ids of many texts at once, by a byte-level tokenizer file of the ``tokenizers`` library.

    The library encodes each distinct piece of a slice of texts. The ids of short pieces are remembered in a table of
    fixed size, under their bytes and length, where a new piece takes the place of an older one with the same hash.
    Strings of special tokens inside a text are ordinary text.
    """

    def __init__(self, path: str, end_id: int | None):
        os.environ["TOKENIZERS_PARALLELISM"] = "false"  # a task has one core
        self.tokenizer = Tokenizer.from_file(path)
        self.tokenizer.encode_special_tokens = True
        split = self.tokenizer.pre_tokenizer
        words = split and [word for word, _ in split.pre_tokenize_str("a b, c1 ?d's")]
        if self.tokenizer.normalizer is not None or words != ["a", "Ġb", ",", "Ġc", "1", "Ġ?", "d", "'s"]:
            raise ValueError(f"{path} is no byte-level tokenizer that leaves texts as they are and splits words")
        self.width = 2 if max(self.tokenizer.get_vocab_size(), (end_id or 0) + 1) <= 1 << 16 else 4
        self.kind = np.dtype(f"<u{self.width}")
        self.end_id = end_id
        self.low = np.zeros(1 << _SLOT_BITS, dtype=np.uint64)
        self.high = np.zeros(1 << _SLOT_BITS, dtype=np.uint64)
        self.few = np.zeros((1 << _SLOT_BITS, _FEW), dtype=self.kind)
        self.n_ids = np.zeros(1 << _SLOT_BITS, dtype=np.uint8)

    def encode(self, texts: pa.Array) -> tuple[np.ndarray, np.ndarray]:
        """The ids of all texts, one after the other, and where each begins (one more entry for the end).

        Every text ends with the end id, if there is one. Null and empty texts have no other.
        """
        data, bounds = utf8(texts)
        starts = piece_starts(data, bounds) if len(data) else np.zeros(0, np.int64)
        lengths = np.diff(starts, append=len(data))
        low, high = _keys(data, starts, lengths)
        slot = (mixed(low ^ mixed(high)) >> np.uint64(64 - _SLOT_BITS)).astype(np.int64)
        hit = (self.low[slot] == low) & (self.high[slot] == high) & (lengths <= _SHORT)
        n_ids = self.n_ids[slot].astype(np.int64)
        missed = np.flatnonzero(~hit)
        own, nth = self._missing(data, starts[missed], lengths[missed], low[missed], high[missed])
        n_own = np.array([len(ids) for ids in own], dtype=np.int64)
        n_ids[missed] = n_own[nth]
        # A text's ids are those of its pieces and its end id.
        of_text = np.searchsorted(starts, bounds)
        ends = np.arange(len(texts) + 1) * (self.end_id is not None)
        before = np.concatenate([[0], np.cumsum(n_ids)])
        first = before[of_text] + ends
        out = np.empty(first[-1], dtype=self.kind)
        known = np.ones(len(out), dtype=bool)
        if len(missed):
            flat = np.concatenate(own)
            at, n = (np.cumsum(n_own) - n_own)[nth], n_own[nth]
            step = np.arange(n.sum()) - np.repeat(np.cumsum(n) - n, n)
            place = before[missed] + ends[np.searchsorted(of_text, missed, "right") - 1]
            place = np.repeat(place, n) + step
            out[place] = flat[np.repeat(at, n) + step]
            known[place] = False
        if self.end_id is not None:
            out[first[1:] - 1] = self.end_id
            known[first[1:] - 1] = False
        found = slot[hit]
        out[known] = self.few[found][self.n_ids[found][:, None] > np.arange(_FEW, dtype=np.uint8)]
        self._remember(slot[missed], low[missed], high[missed], lengths[missed], own, n_own, nth)
        return out, first

    def _missing(self, data, starts, lengths, low, high) -> tuple[list[np.ndarray], np.ndarray]:
        """The ids of the distinct pieces among those given, and which of them each piece is."""
        number: dict[bytes, int] = {}
        nth = np.empty(len(starts), dtype=np.int64)
        short = np.flatnonzero(lengths <= _SHORT)
        keys = np.stack([low[short], high[short]], axis=1).view(np.dtype("V16")).reshape(-1)
        _, first, same = np.unique(keys, return_index=True, return_inverse=True)
        raw = data.tobytes()
        pieces = [raw[a : a + n] for a, n in zip(starts[short[first]].tolist(), lengths[short[first]].tolist())]
        nth[short] = same.reshape(-1)
        for i in np.flatnonzero(lengths > _SHORT).tolist():
            piece = raw[starts[i] : starts[i] + lengths[i]]
            at = number.setdefault(piece, len(pieces) + len(number))
            nth[i] = at
        pieces += number
        own = []
        for at in range(0, len(pieces), 4096):
            some = [piece.decode() for piece in pieces[at : at + 4096]]
            own += [np.array(found.ids, self.kind) for found in self.tokenizer.encode_batch_fast(some, add_special_tokens=False)]
        return own, nth

    def _remember(self, slot, low, high, lengths, own, n_own, nth) -> None:
        kept = np.flatnonzero((lengths <= _SHORT) & (n_own[nth] <= _FEW)) if len(own) else []
        # One piece for each slot, as the arrays are written one after the other.
        _, one = np.unique(slot[kept], return_index=True)
        kept = np.asarray(kept)[one] if len(kept) else np.zeros(0, np.int64)
        few = np.zeros((len(kept), _FEW), dtype=self.kind)
        for row, i in enumerate(nth[kept].tolist()):
            few[row, : len(own[i])] = own[i]
        at = slot[kept]
        self.low[at], self.high[at], self.few[at], self.n_ids[at] = low[kept], high[kept], few, n_own[nth[kept]]


def _keys(data: np.ndarray, starts: np.ndarray, lengths: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """The first eight bytes of each piece, and its next seven with its length: all of a piece of up to ``_SHORT`` bytes."""
    padded = np.concatenate([data, np.zeros(16, np.uint8)])
    words = np.lib.stride_tricks.as_strided(padded[:8].view(np.uint64), (len(data) + 9,), (1,))
    short = np.minimum(lengths, _SHORT)
    low = words[starts] & _MASK[np.minimum(short, 8)]
    high = words[starts + 8 * (short > 8)] & _MASK[np.maximum(short - 8, 0)]
    return low, high | short.astype(np.uint64) << np.uint64(56)


# ---- writing -------------------------------------------------------------------


class _TokenFile:
    """A pair of files that is being written."""

    def __init__(self, folder: str, name: str, width: int):
        self.system, path = _open(folder)
        self.system.create_dir(path, recursive=True)
        self.path, self.at, self.width = f"{folder}/{name}", f"{path}/{name}", width
        self.data = self.system.open_output_stream(f"{self.at}.bin")
        self.offsets, self.ids, self.n_tokens = [np.zeros(1, np.int64)], [], 0

    def add(self, documents: list[int | None], first: np.ndarray, tokens: np.ndarray) -> None:
        """More documents, whose ids begin at the places ``first`` of ``tokens``."""
        self.data.write(tokens)
        self.offsets.append(first[1:] + self.n_tokens)
        self.ids += documents
        self.n_tokens += len(tokens)

    def full(self) -> bool:
        return self.n_tokens * self.width >= FILE_BYTES or len(self.ids) >= FILE_DOCUMENTS

    def close(self) -> tuple[str, int, int]:
        self.data.close()
        with self.system.open_output_stream(f"{self.at}.idx") as index:
            index.write(_HEAD.pack(_MAGIC, _VERSION, self.width, len(self.ids)))
            index.write(np.concatenate(self.offsets).astype("<i8").tobytes())
            index.write(np.array([x or 0 for x in self.ids], "<i8").tobytes())
            index.write(bytes(x is None for x in self.ids))
        return self.path, len(self.ids), self.n_tokens


def write_token_files(
    df: DataFrame, folder: str, tokenizer: str, id_column: str = "doc_id", text: str = "text", end_id: int | None = None
) -> DataFrame:
    """Writes the token ids of every row in ascending order of ``id_column`` and returns the table of the files (``FILES``).

    ``end_id`` is appended to every document. Null texts count as empty, so they consist of the end id alone. Null
    ids come first; rows with equal ids follow each other by the hash of their texts, and each is a document. Other
    columns are not looked at. No rows give no files. ``tokenizer`` is a file that every executor can read.

    Files are named after the task attempt that writes them, and only those of attempts that succeeded are in the
    returned table, which is written before it is returned.
    """
    rows = df.select(quoted(id_column).cast("long").alias("id"), quoted(text).cast("string").alias("text"))
    # Equal ids, even on equal texts, may be a large part of all rows: their number in the input splits them.
    keyed = rows.withColumns({"hash": F.xxhash64("text"), "nth": F.monotonically_increasing_id()})

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoder, context = _encoder(tokenizer, end_id), TaskContext.get()
        done, file = [], None
        for batch in batches:
            for piece in pieces(batch, text_bytes(batch.column(1)), _SLICE_BYTES):
                if file is None:
                    name = f"{context.partitionId():06d}-{len(done):04d}-{context.taskAttemptId()}-{uuid.uuid4().hex[:8]}"
                    file = _TokenFile(folder, name, encoder.width)
                tokens, first = encoder.encode(piece.column(1))
                file.add(piece.column(0).to_pylist(), first, tokens)
                if file.full():
                    done.append(file.close())
                    file = None
        if file is not None:
            done.append(file.close())
        n = len(done)
        paths, documents, totals = zip(*done) if done else ((), (), ())
        columns = [[context.partitionId()] * n, range(n), paths, [encoder.width] * n, documents, totals]
        kinds = (pa.int32(), pa.int32(), pa.string(), pa.int32(), pa.int64(), pa.int64())
        yield pa.RecordBatch.from_arrays([pa.array(list(c), k) for c, k in zip(columns, kinds)], FILES_WRITTEN)

    ordered = keyed.repartitionByRange("id", "hash", "nth").sortWithinPartitions("id", "hash", "nth")
    schema = ", ".join(FILES.split(", ")[: len(FILES_WRITTEN)])
    return placed(written(ordered.select("id", "text").mapInArrow(run, schema)))


FILES_WRITTEN = [field.split()[0] for field in FILES.split(", ")][:6]


def placed(files: DataFrame) -> DataFrame:
    """The files with the number of documents and ids before each: of its partition's files, and of all partitions before."""
    sums = ("n_documents", "n_tokens")
    firsts = ("first_document", "first_token")
    by_part = files.groupBy(F.col("part").alias("of")).agg(*(F.sum(name).alias(name) for name in sums))
    # One row for each partition that wrote, of which there are at most spark.sql.shuffle.partitions.
    bases = by_part.select("of", *((F.sum(name).over(W.orderBy("of")) - F.col(name)).alias(f"base_{name}") for name in sums))
    within = W.partitionBy("part").orderBy("nth")
    # The join says nothing of its size: both sides are as many rows as there are files, or fewer.
    own = files.join(bases, F.col("part") == F.col("of"))
    return own.select(
        *files.columns,
        *((F.col(f"base_{name}") + F.sum(name).over(within) - F.col(name)).alias(first) for name, first in zip(sums, firsts)),
    )


@cache
def _encoder(tokenizer: str, end_id: int | None) -> Encoder:
    """One for each worker process, whose cache later tasks use as well."""
    return Encoder(tokenizer, end_id)


# ---- reading -------------------------------------------------------------------


class TokenFile:
    """A pair of files, memory-mapped where they lie in a local or mounted folder and read by range elsewhere."""

    def __init__(self, path: str):
        self.system, self.at = _open(path)
        self.local = isinstance(self.system, fs.LocalFileSystem)
        magic, version, self.width, self.n = _HEAD.unpack(self._bytes("idx", 0, _HEAD.size))
        if magic != _MAGIC or version != _VERSION:
            raise ValueError(f"{path}.idx is no index of token ids")
        self.kind = np.dtype(f"<u{self.width}")

    def _bytes(self, suffix: str, at: int, size: int) -> bytes | memoryview:
        if not size:
            return b""
        name = f"{self.at}.{suffix}"
        if self.local:
            return np.memmap(name, np.uint8, "r", at, (size,)).data
        with self.system.open_input_file(name) as file:
            return file.read_at(size, at)

    def offsets(self) -> np.ndarray:
        return np.frombuffer(self._bytes("idx", _HEAD.size, 8 * (self.n + 1)), "<i8")

    def documents(self, first: int, stop: int) -> tuple[np.ndarray, np.ndarray]:
        """Ids of the documents ``first`` to ``stop`` - 1 of the file, and which of them are null."""
        start = _HEAD.size + 8 * (self.n + 1)
        ids = np.frombuffer(self._bytes("idx", start + 8 * first, 8 * (stop - first)), "<i8")
        return ids, np.frombuffer(self._bytes("idx", start + 8 * self.n + first, stop - first), np.uint8) > 0

    def tokens(self, start: int, stop: int) -> np.ndarray:
        """The ids from place ``start`` to ``stop`` - 1 of the file."""
        return np.frombuffer(self._bytes("bin", start * self.width, (stop - start) * self.width), self.kind)


def read_documents(files: DataFrame) -> DataFrame:
    """One row per document, from the files: ``doc_id``, ``start`` (ids of all documents before it), ``n_tokens`` and
    ``ids``, the token ids as little-endian unsigned 32-bit integers.

    A task reads parts of about ``READ_TOKENS`` ids; the parts of all files are dealt out evenly.
    """
    spark = files.sparkSession
    total = files.agg(F.sum("n_tokens")).first()[0] or 0
    tasks = max(spark.sparkContext.defaultParallelism, -(-total // TASK_TOKENS))
    # A document belongs to the part that its first id is in, or would be in if it has none.
    parts = files.select("path", "first_token", F.explode(F.sequence(F.lit(0).cast("long"), F.col("n_tokens"), F.lit(READ_TOKENS).cast("long"))).alias("at"))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        path, file, offsets = None, None, None
        for batch in batches:
            for new, base, at in zip(*(batch.column(i).to_pylist() for i in range(3))):
                if new != path:
                    path, file = new, TokenFile(new)
                    offsets = file.offsets()
                first, stop = np.searchsorted(offsets[:-1], [at, at + READ_TOKENS]).tolist()
                if first < stop:
                    yield _rows(file, offsets[first : stop + 1], base, first, stop)

    dealt = parts.repartition(tasks, "path", "at").sortWithinPartitions("path", "at")
    return dealt.mapInArrow(run, "doc_id long, start long, n_tokens long, ids binary")


def _rows(file: TokenFile, offsets: np.ndarray, base: int, first: int, stop: int) -> pa.RecordBatch:
    ids, null = file.documents(first, stop)
    tokens = file.tokens(int(offsets[0]), int(offsets[-1])).astype("<u4")
    bounds = pa.py_buffer((4 * (offsets - offsets[0])).astype(np.int64))
    values = pa.LargeBinaryArray.from_buffers(pa.large_binary(), stop - first, [None, bounds, pa.py_buffer(tokens)])
    columns = [pa.array(ids, mask=null), pa.array(offsets[:-1] + base), pa.array(np.diff(offsets)), values.cast(pa.binary())]
    return pa.RecordBatch.from_arrays(columns, ["doc_id", "start", "n_tokens", "ids"])


def _open(path: str) -> tuple[fs.FileSystem, str]:
    """The file system of a URI or a local path."""
    return fs.FileSystem.from_uri(path if "://" in path or path.startswith("file:") else f"file://{path}")
