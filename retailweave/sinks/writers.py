"""Snapshot and warehouse table writers."""

from __future__ import annotations

import uuid
from dataclasses import dataclass, field
from math import ceil

from pyspark.sql import DataFrame, SparkSession

from retailweave.sinks.records import Folder

_FILE_FORMATS = ("parquet", "orc", "csv", "json")

# Of a snapshot whose number of files is given. What is smaller is dealt out by a shuffle; what would be larger gets more files.
SHUFFLED_FILE_BYTES = 32 << 20
MAX_FILE_BYTES = 1 << 30

# Folders beside the tables, which no table is called like.
_STAGED, _REPLACED = "_staged", "_replaced"


def spread(df: DataFrame, n: int | None) -> DataFrame:
    """Round-robin over ``n`` partitions; as it is for ``None``."""
    return df if n is None else df.repartition(n)


def write_snapshot(df: DataFrame, path: str, mode: str = "errorifexists", n_files: int | None = None) -> None:
    """Write ``df`` as Parquet.

    By default every task writes its own file and nothing is shuffled.
    ``n_files`` collects the rows in that many files, or in as many more as keep each below about ``MAX_FILE_BYTES``, since
    one task writes a file. The rows are written by all tasks first, to a folder beside ``path`` that goes at the end, and the
    files are made of these: compressed columns are a fraction of the same rows in a shuffle.
    """
    present = mode not in ("append", "overwrite") and n_files is not None and Folder(df.sparkSession, path).exists()
    if n_files is None or present:
        df.write.mode(mode).parquet(path)
        return
    above, slash, _ = path.rstrip("/").rpartition("/")
    parts = Folder(df.sparkSession, f"{above}{slash}_parts-{uuid.uuid4().hex}")
    try:
        df.write.option("compression", "zstd").parquet(parts.path)
        rows = df.sparkSession.read.schema(df.schema).parquet(parts.path)
        _gathered(rows, n_files, parts.size()).write.mode(mode).parquet(path)
    finally:
        parts.delete()


def _gathered(rows: DataFrame, n_files: int, n_bytes: int) -> DataFrame:
    """``rows`` of a table of ``n_bytes`` in ``n_files`` partitions, or more of about ``MAX_FILE_BYTES``."""
    n = max(n_files, ceil(n_bytes / MAX_FILE_BYTES))
    # Where each file gets several splits of the table, these are even enough.
    if n_bytes > n * SHUFFLED_FILE_BYTES and rows.rdd.getNumPartitions() >= 2 * n:
        return rows.coalesce(n)
    return spread(rows, n)


@dataclass(frozen=True)
class Warehouse:
    """Where warehouse tables go.

    ``format`` is ``jdbc`` or any other connector that takes ``dbtable``; a file
    format, with the folder of the tables as option ``path``; or ``catalog`` for
    tables of the session's catalog. ``options`` are passed on.

    ``staged`` writes a table that is overwritten beside the old one and then puts it in its place, so that a write that
    fails leaves the old table, and a table may be made from itself. For files, and for catalog tables without a path.
    """

    format: str = "jdbc"
    options: dict[str, str] = field(default_factory=dict, repr=False)
    staged: bool = False

    def __post_init__(self):
        if self.staged and not (self.of_files() or self.format == "catalog" and "path" not in self.options):
            raise ValueError("only tables of files and catalog tables without a path can be staged")

    def write(self, df: DataFrame, table: str, mode: str) -> None:
        """Append to or overwrite a table, as ``mode`` says."""
        if self.staged and mode == "overwrite":
            self._replace(df, table)
            return
        if self.staged and self.of_files():
            self._recover(df.sparkSession, table)
        self._write(df, table, mode)

    def _replace(self, df: DataFrame, table: str) -> None:
        spark, number = df.sparkSession, uuid.uuid4().hex
        if self.format == "catalog":
            new, old = f"{table}__staged_{number}", f"{table}__replaced_{number}"
            try:
                self._write(df, new, "errorifexists")
            except BaseException:
                spark.sql(f"DROP TABLE IF EXISTS {new}")
                raise
            existed = spark.catalog.tableExists(table)
            if existed:
                spark.sql(f"ALTER TABLE {table} RENAME TO {old.rpartition('.')[2]}")
            spark.sql(f"ALTER TABLE {new} RENAME TO {table.rpartition('.')[2]}")
            if existed:
                spark.sql(f"DROP TABLE {old}")
            return
        self._recover(spark, table)
        new, old = f"{_STAGED}/{table}-{number}", f"{_REPLACED}/{table}/{number}"
        staged = Folder(spark, self.path(new))
        try:
            self._write(df, new, "errorifexists")
        except BaseException:
            staged.delete()
            raise
        # Between the two moves there is no table; whoever reads or writes next finds the old one by its name.
        present = Folder(spark, self.path(table))
        if present.exists() and not present.move(self.path(old)):
            raise RuntimeError(f"{self.path(table)} can't be moved away")
        if not staged.move(self.path(table)):
            raise RuntimeError(f"{self.path(table)} appeared while it was replaced")
        Folder(spark, self.path(f"{_REPLACED}/{table}")).delete()

    def _recover(self, spark: SparkSession, table: str) -> None:
        """Puts the old table back if a replacement broke off between its two moves."""
        replaced = Folder(spark, self.path(f"{_REPLACED}/{table}"))
        if not Folder(spark, self.path(table)).exists():
            for name in replaced.children():
                Folder(spark, f"{replaced.path}/{name}").move(self.path(table))
        replaced.delete()

    def _write(self, df: DataFrame, table: str, mode: str) -> None:
        options = dict(self.options)
        if self.format == "catalog":
            df.write.options(**options).mode(mode).saveAsTable(table)
            return
        if self.format in _FILE_FORMATS:
            folder = options.pop("path").rstrip("/")
            df.write.format(self.format).options(**options).mode(mode).save(f"{folder}/{table}")
            return
        df.write.format(self.format).options(**options).option("dbtable", table).mode(mode).save()

    def read(self, spark: SparkSession, table: str) -> DataFrame | None:
        """A table as it is; None if there is none. A database is asked by reading its table, so there it has to exist."""
        options = dict(self.options)
        if self.format == "catalog":
            return spark.table(table) if spark.catalog.tableExists(table) else None
        if self.of_files():
            path = self.path(table)
            if self.staged:
                self._recover(spark, table)
            if not any(name[0] not in "._" for name in Folder(spark, path).children()):
                return None
            return spark.read.format(self.format).options(**{k: v for k, v in options.items() if k != "path"}).load(path)
        return spark.read.format(self.format).options(**options).option("dbtable", table).load()

    def of_files(self) -> bool:
        return self.format in _FILE_FORMATS

    def path(self, table: str) -> str:
        """The folder of a table of files."""
        return f"{self.options['path'].rstrip('/')}/{table}"
