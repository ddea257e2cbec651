"""Incremental extracts: only what the source has that no earlier snapshot has.

The watermark of a source is the largest value of a column that its snapshots hold. The next extract reads, by a filter that
is pushed into the source, the rows from the watermark on, less an ``overlap`` for late ones, and those without a value. What lies above
the watermark is new. Of the rest, the rows that earlier snapshots hold are left out by number (``missing_rows``), so that rows that
were added for the same value are found and rows that are equal to each other are all kept.

The store follows the commits of the snapshots: a commit that it has not seen, since the run broke off after it, is
taken in before the next extract. So no row is extracted twice or passed over.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from retailweave.sinks.commits import Commit, last_commit, log_of, read_commit, write_committed
from retailweave.sinks.deduplicated import missing_rows
from retailweave.sinks.records import Folder


@dataclass(frozen=True)
class Watermark:
    """The column that grows, and an SQL value such as ``INTERVAL 3 DAYS`` or ``1000`` that late rows may lie below its largest one.

    Rows that come later than that are not found. A value is never taken back: rows that change or go are another matter.
    """

    column: str
    overlap: str | None = None


@dataclass(frozen=True)
class _State:
    """``value`` is text of the column's type, None before any row had one; ``edge`` is a table of the rows that the next extract may see again."""

    commit: str | None = None
    value: str | None = None
    edge: str | None = None


def store_of(spark: SparkSession, root: str) -> Folder:
    return Folder(spark, f"{root.rstrip('/')}/_watermarks")


def extract_new(source: DataFrame, root: str, folder: str, watermark: Watermark, n_files: int | None = None) -> Commit:
    """Appends what is new in ``source`` to the snapshot ``folder`` and commits it, be it no row at all."""
    spark = source.sparkSession
    state = _advanced(spark, root, watermark, source)
    commit = write_committed(new_rows(source, spark, state, watermark), root, folder, "append", n_files)
    _advanced(spark, root, watermark, source)
    return commit


def pending(spark: SparkSession, root: str, loaded) -> list[Commit]:
    """The commits below ``root`` of which ``loaded(number)`` is false, in order."""
    log = log_of(spark, root)
    return [Commit(number, **log.get(number)) for number in log.names() if not loaded(number)]


def new_rows(source: DataFrame, spark: SparkSession, state: _State, watermark: Watermark) -> DataFrame:
    """The rows of ``source`` that the snapshots up to ``state`` do not have."""
    if state.commit is None or state.edge is None:
        return source
    edge = spark.read.parquet(state.edge)
    if state.value is None:
        return missing_rows(source, edge, source.columns)
    value, last = F.col(_quoted(watermark.column)), _last(source, state, watermark)
    newer = source.where(value > last)
    again = source.where(((value >= _floor(last, watermark)) & (value <= last)) | value.isNull())
    return newer.unionByName(missing_rows(again, edge, source.columns))


def _last(source: DataFrame, state: _State, watermark: Watermark) -> Column:
    """The watermark as a constant of the column's type."""
    return F.lit(state.value).cast(source.schema[watermark.column].dataType)


def _floor(last: Column, watermark: Watermark) -> Column:
    return last if watermark.overlap is None else last - F.expr(watermark.overlap)


def _advanced(spark: SparkSession, root: str, watermark: Watermark, source: DataFrame) -> _State:
    """The state after all commits of ``root``."""
    store = store_of(spark, root)
    record = store.last()
    state = _State(**record) if record else _State()
    newest = last_commit(spark, root)
    if newest is None or newest.number == state.commit:
        return state
    log = log_of(spark, root)
    for number in (name for name in log.names() if state.commit is None or name > state.commit):
        state = _after(spark, root, Commit(number, **log.get(number)), state, watermark, source, store)
    return state


def _after(spark: SparkSession, root: str, commit: Commit, state: _State, watermark: Watermark, source: DataFrame, store: Folder) -> _State:
    rows = read_commit(spark, root, commit)
    value = F.col(_quoted(watermark.column))
    highest = F.max(value).cast("string")
    before = F.lit(state.value).cast(source.schema[watermark.column].dataType)
    found = rows.agg(F.greatest(F.max(value), before).cast("string").alias("value"), highest.alias("own")).first()
    new = _State(commit.number, found.value, f"{store.path}/edge-{commit.number}-{commit.write_id}")
    edge = rows
    if state.edge is not None and commit.mode == "append":
        edge = spark.read.schema(rows.schema).parquet(state.edge).unionByName(rows)
    if new.value is not None:
        edge = edge.where((value >= _floor(_last(source, new, watermark), watermark)) | value.isNull())
    edge.write.mode("overwrite").parquet(new.edge)
    store.append({"commit": new.commit, "value": new.value, "edge": new.edge})
    return new


def _quoted(name: str) -> str:
    return "`" + name.replace("`", "``") + "`"
