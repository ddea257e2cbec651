"""Snapshots with a manifest: a log of commits beside the dated folders of an entity and feed.

A commit lies below ``<root>/_commits``, which readers of Parquet folders pass over. It is a table of the files of one write, with
their sizes and rows, and a record with the write's folder and id, totals and schema. The record is written last and has the
next number of the log, so

* the newest snapshot is that of the last record, whatever the modification times of files;
* what a broken write left belongs to no record and is not read;
* a snapshot that lost files, or whose files changed, is refused.

Besides, every folder has a list of the numbers of its commits, so that what is read of the log does not grow with its history. An entry is
written before its record and counts only if that is there.

One writer at a time writes to a root; two that commit under one number are an error for the second.
"""

from __future__ import annotations

import json
import re
import time
from collections.abc import Iterator
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailweave.sinks.records import Folder
from retailweave.sinks.writers import write_snapshot

# Spark names the files of one write part-<task>-<write id>...
WRITE_ID = r"^part-\d+-([0-9a-f]{8}(?:-[0-9a-f]{4}){3}-[0-9a-f]{12})"
LOG = "_commits"


class TornSnapshot(ValueError):
    """The files of a committed snapshot are not those of its manifest."""


@dataclass(frozen=True)
class Commit:
    """A record of the log. ``folder`` is that of the snapshot, below the root."""

    number: str
    folder: str
    write_id: str
    mode: str
    n_files: int
    n_rows: int
    n_bytes: int
    schema: str
    committed_at: float

    def path(self, root: str) -> str:
        return f"{root.rstrip('/')}/{self.folder}"


def log_of(spark: SparkSession, root: str) -> Folder:
    return Folder(spark, f"{root.rstrip('/')}/{LOG}")


def last_commit(spark: SparkSession, root: str, folder: str | None = None) -> Commit | None:
    """The last commit below ``root``, or the last one of a folder."""
    if folder is not None:
        return next(_newest_first(spark, root, folder), None)
    log = log_of(spark, root)
    names = log.names()
    return Commit(names[-1], **log.get(names[-1])) if names else None


def commits_of(spark: SparkSession, root: str, folder: str) -> list[Commit]:
    """The commits that make up a folder's present content: the last one that replaced it and those that appended since."""
    out = []
    for commit in _newest_first(spark, root, folder):
        out.append(commit)
        if commit.mode != "append":
            break
    return out[::-1]


def _entries_of(spark: SparkSession, root: str, folder: str) -> Folder:
    """The list of a folder's commits: records called ``<number>-<write id>``."""
    return Folder(spark, f"{log_of(spark, root).path}/folders/{folder}")


def _newest_first(spark: SparkSession, root: str, folder: str) -> Iterator[Commit]:
    """The commits of a folder, each read when it is asked for."""
    log = log_of(spark, root)
    # A write that broke off leaves an entry, and the next one may have the same number.
    for number in dict.fromkeys(name.partition("-")[0] for name in reversed(_entries_of(spark, root, folder).names())):
        record = log.get(number)
        if record is not None and record["folder"] == folder:
            yield Commit(number, **record)


def write_committed(df: DataFrame, root: str, folder: str, mode: str = "errorifexists", n_files: int | None = None) -> Commit:
    """Writes ``df`` as the snapshot ``folder`` below ``root``, as ``write_snapshot`` does, and commits it.

    Sizes come from the listing and rows from the footers of the files that the write made, not from what it was told to write.
    """
    spark, path = df.sparkSession, f"{root.rstrip('/')}/{folder}"
    before = set(write_ids(spark, path)) if mode == "append" else set()
    schema = df.schema.json()
    write_snapshot(df, path, mode, n_files)
    new = [write_id for write_id in write_ids(spark, path) if write_id not in before]
    if len(new) != 1:
        raise RuntimeError(f"{path} has files of {len(new)} new writes: another writer, or one that does not name its files as Spark does")
    log = log_of(spark, root)
    names = log.names()
    number = f"{int(names[-1]) + 1 if names else 0:012d}"
    table = f"{log.path}/files-{number}-{new[0]}"
    _present(spark, path, new[0]).write.mode("overwrite").parquet(table)
    totals = spark.read.parquet(table).agg(F.count("*").alias("n"), F.sum("n_rows").alias("n_rows"), F.sum("n_bytes").alias("n_bytes")).first()
    record = {
        "folder": folder, "write_id": new[0], "mode": mode, "n_files": totals.n, "n_rows": totals.n_rows or 0,
        "n_bytes": totals.n_bytes or 0, "schema": schema, "committed_at": time.time(),
    }
    _entries_of(spark, root, folder).put(f"{number}-{new[0]}", {})
    log.put(number, record)
    return Commit(number, **record)


def read_commit(spark: SparkSession, root: str, commit: Commit) -> DataFrame:
    """The rows of a committed snapshot; ``TornSnapshot`` if its files are not all there as they were committed."""
    check(spark, root, commit)
    schema = T.StructType.fromJson(json.loads(commit.schema))
    return spark.read.schema(schema).option("pathGlobFilter", glob_of(commit.write_id)).parquet(commit.path(root))


def check(spark: SparkSession, root: str, commit: Commit) -> None:
    """Compares the files that are there with the manifest, by name and size, in a join of two listings."""
    listed = spark.read.parquet(f"{log_of(spark, root).path}/files-{commit.number}-{commit.write_id}").select("name", "n_bytes")
    if not Folder(spark, commit.path(root)).exists():
        raise TornSnapshot(f"{commit.path(root)} is gone")
    there = _sizes(spark, commit.path(root), commit.write_id).select(F.col("name").alias("own_name"), F.col("n_bytes").alias("own_bytes"))
    same = (F.col("name") == F.col("own_name")) & (F.col("n_bytes") == F.col("own_bytes"))
    wrong = listed.join(there, same, "full_outer").where("name is null or own_name is null")
    found = wrong.select(F.coalesce("name", "own_name").alias("name")).agg(F.count_distinct("name").alias("n"), F.min("name").alias("name")).first()
    if found.n:
        raise TornSnapshot(f"{commit.path(root)}: {found.n} files are not as they were committed, {found.name} first")


def discard(spark: SparkSession, path: str, keep: set[str]) -> int:
    """Deletes the files of writes to ``path`` that are not in ``keep``, and returns how many writes those were."""
    folder, found = Folder(spark, path), set()
    for name in folder.children():
        own = re.match(WRITE_ID, name)
        if own and own[1] not in keep:
            found.add(own[1])
            folder.delete(name)
    return len(found)


def write_ids(spark: SparkSession, path: str) -> list[str]:
    """The ids of the writes that have files in ``path``."""
    if not Folder(spark, path).exists():
        return []
    own = F.regexp_extract("name", WRITE_ID, 1)
    found = _listing(spark, path, "part-*").select(own.alias("id")).where("id <> ''").distinct()
    return sorted(row.id for row in found.collect())


def glob_of(write_id: str) -> str:
    return f"part-*-{write_id}*"


def _listing(spark: SparkSession, path: str, names: str) -> DataFrame:
    """``name`` and ``n_bytes`` of the files in ``path``, of which nothing but the listing is read."""
    # A session of its own, so that the listing is cut into as many tasks as there are cores.
    lister = spark.newSession()
    lister.conf.set("spark.sql.files.maxPartitionBytes", "1t")
    files = lister.read.format("binaryFile").option("pathGlobFilter", names).load(path)
    return files.select(F.element_at(F.split("path", "/"), -1).alias("name"), F.col("length").alias("n_bytes"))


def _sizes(spark: SparkSession, path: str, write_id: str) -> DataFrame:
    return _listing(spark, path, glob_of(write_id))


def _present(spark: SparkSession, path: str, write_id: str) -> DataFrame:
    """``name``, ``n_bytes`` and ``n_rows`` of the files of a write."""
    data = spark.read.option("pathGlobFilter", glob_of(write_id)).parquet(path)
    rows = data.groupBy(F.col("_metadata.file_name").alias("of")).agg(F.count("*").alias("n_rows"))
    sizes = _sizes(spark, path, write_id)
    return sizes.join(rows, F.col("name") == F.col("of"), "left").select("name", "n_bytes", F.coalesce("n_rows", F.lit(0)).alias("n_rows"))
