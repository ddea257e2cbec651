"""Arrow batches inside tasks: slices of bounded size, added columns, and groups of a sorted stream."""

from __future__ import annotations

from collections.abc import Callable, Iterator, Sequence

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_schema

PIECE_BYTES = 1 << 20
HELD_BYTES = 64 << 20


def pieces(batch: pa.RecordBatch, sizes: np.ndarray, most: int = PIECE_BYTES) -> Iterator[pa.RecordBatch]:
    """Slices of a batch whose sizes add up to about ``most``; a larger row is a slice of its own."""
    total = np.cumsum(sizes)
    at = 0
    while at < len(total):
        before = total[at - 1] if at else 0
        stop = max(at + 1, int(np.searchsorted(total, before + most, "right")))
        yield batch.slice(at, stop - at)
        at = stop


def text_bytes(texts: pa.Array) -> np.ndarray:
    """UTF-8 bytes of each text, 0 for null."""
    return np.asarray(pc.fill_null(pc.binary_length(texts), 0), dtype=np.int64)


def add_columns(
    df: DataFrame,
    text: str,
    added: T.StructType,
    compute: Callable[[], Callable[[pa.Array], Sequence[pa.Array]]],
    keep: Sequence[str] | None = None,
    slice_bytes: int = PIECE_BYTES,
) -> DataFrame:
    """``df`` with the columns ``added``, computed from the text column alone.

    ``compute()`` is called once per task and returns a function from an array of
    texts to the arrays of the added columns. ``keep`` names the columns that stay
    (all by default); a column called like an added one, in any case, is replaced by it.
    """
    new = {name.lower() for name in added.names}
    kept = [name for name in (df.columns if keep is None else keep) if name.lower() not in new]
    source = [quoted(name) for name in kept]
    if text in kept and isinstance(df.schema[text].dataType, T.StringType):
        at = kept.index(text)  # sent once, if it stays
    else:
        at = len(kept)
        source.append(quoted(text).cast("string").alias("__read"))
    schema = T.StructType([df.schema[name] for name in kept] + added.fields)
    arrow = to_arrow_schema(added)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        function = compute()
        for batch in batches:
            for piece in pieces(batch, text_bytes(batch.column(at)), slice_bytes):
                values = function(piece.column(at))
                columns = [value.cast(field.type) for value, field in zip(values, arrow)]
                yield pa.RecordBatch.from_arrays([*piece.columns[: len(kept)], *columns], schema.names)

    return df.select(*source).mapInArrow(run, schema)


def add_columns_by_parts(
    df: DataFrame,
    text: str,
    added: T.StructType,
    visitor: Callable[[], object],
    parts: Sequence[str],
    keep: Sequence[str] | None = None,
    held_bytes: int = HELD_BYTES,
) -> DataFrame:
    """``add_columns`` by something too large for a task's memory, which comes in ``parts``: names of files in the shared folder.

    ``visitor()`` is called once per task. ``visitor.load(part)`` returns a part, ``visitor.begin(texts)`` the state of a slice
    of texts, ``visitor.visit(loaded, texts, state)`` takes a part into account, and ``visitor.end(texts, state)`` returns the arrays of the
    added columns. A task holds one part and about ``held_bytes`` of text. It goes through the parts once for each such lot of
    slices, so how often a part is loaded does not depend on the number of slices. A single part is loaded once.
    """
    new = {name.lower() for name in added.names}
    kept = [name for name in (df.columns if keep is None else keep) if name.lower() not in new]
    source = [quoted(name) for name in kept]
    if text in kept and isinstance(df.schema[text].dataType, T.StringType):
        at = kept.index(text)
    else:
        at = len(kept)
        source.append(quoted(text).cast("string").alias("__read"))
    schema = T.StructType([df.schema[name] for name in kept] + added.fields)
    arrow = to_arrow_schema(added)
    most = held_bytes if len(parts) > 1 else 0

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        worker = visitor()
        single = worker.load(parts[0]) if len(parts) == 1 else None
        for lot in _lots(batches, at, most):
            states = [worker.begin(piece.column(at)) for piece in lot]
            for part in parts:
                loaded = single if single is not None else worker.load(part)
                for piece, state in zip(lot, states):
                    worker.visit(loaded, piece.column(at), state)
                del loaded
            while lot:
                piece, state = lot.pop(0), states.pop(0)
                columns = [value.cast(field.type) for value, field in zip(worker.end(piece.column(at), state), arrow)]
                yield pa.RecordBatch.from_arrays([*piece.columns[: len(kept)], *columns], schema.names)

    return df.select(*source).mapInArrow(run, schema)


def _lots(batches: Iterator[pa.RecordBatch], at: int, most: int) -> Iterator[list[pa.RecordBatch]]:
    """Slices of batches, in lists of about ``most`` bytes of text."""
    lot, size = [], 0
    for batch in batches:
        for piece in pieces(batch, text_bytes(batch.column(at))):
            lot.append(piece)
            size += int(text_bytes(piece.column(at)).sum())
            if size >= most:
                yield lot
                lot, size = [], 0
    if lot:
        yield lot


def packed(df: DataFrame, text: str) -> DataFrame:
    """``__text`` and all other columns as ``__others``, so that the columns an operator adds replace none of them."""
    others = [quoted(name) for name in df.columns if name != text]
    return df.select(F.struct(F.lit(0).alias("__"), *others).alias("__others"), quoted(text).alias("__text"))


def unpacked(df: DataFrame, columns: Sequence[str], text: str) -> DataFrame:
    """The columns of a frame that was ``packed``, in their order."""
    return df.select(
        *((F.col("__text") if name == text else F.col("__others")[name]).alias(name) for name in columns)
    )


def shuffled_anew(df: DataFrame, key: str) -> DataFrame:
    """``df``, a grouped result, with its key computed once more, so that Spark shuffles it for a join on the key.

    Adaptive execution splits a hot key's rows on the other side of a join only if both sides come straight from a
    shuffle, and not if this one is still partitioned by its grouping.
    """
    column = quoted(key)
    kind = df.schema[key].dataType
    same = column.bitwiseXOR(F.lit(0).cast(kind)) if isinstance(kind, T.IntegralType) else F.concat(column, F.lit(b"").cast(kind))
    return df.withColumn(key, same)


def quoted(name: str) -> Column:
    return F.col("`" + name.replace("`", "``") + "`")


def groups(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """The runs of equal keys of a stream that is sorted by ``key``; one run is held at a time."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        if not batch.num_rows:
            continue
        keys = np.asarray(batch.column(batch.schema.get_field_index(key)).to_pandas())
        cuts = [0, *(np.flatnonzero(keys[1:] != keys[:-1]) + 1), len(keys)]
        if held and held[-1].column(key)[-1].as_py() != keys[0]:
            yield pa.Table.from_batches(held)
            held = []
        for start, stop in zip(cuts, cuts[1:]):
            held.append(batch.slice(start, stop - start))
            if stop < len(keys):
                yield pa.Table.from_batches(held)
                held = []
    if held:
        yield pa.Table.from_batches(held)
