"""The dated snapshot folders of the lake: run date, layout and newest snapshot.

A snapshot is a Parquet folder ``<root>/<Entity>/<Entity>_<feed>/<yyyy-MM-dd>/``.
"""

from __future__ import annotations

import re
from functools import reduce

from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from retailweave.sinks.commits import WRITE_ID, commits_of, last_commit, read_commit

_WRITE_ID = re.compile(WRITE_ID)
_DATE = re.compile(r"^\d{4}-\d\d-\d\d$")

# Dates whose files are compared. Snapshots are made daily, and a late one is a few days late.
DAYS = 7


def run_date(spark: SparkSession, override: str | None = None) -> str:
    """Today as ``yyyy-MM-dd`` in the session's time zone, or the date given."""
    if override is not None:
        return override
    return spark.range(1).select(F.date_format(F.current_date(), "yyyy-MM-dd").alias("date")).first().date


def feed_path(root: str, entity: str, feed: str) -> str:
    """Folder that holds all dated snapshots of an entity for one feed."""
    return f"{root.rstrip('/')}/{entity}/{entity}_{feed}"


def newest_file(spark: SparkSession, root: str, days: int | None = DAYS) -> Row:
    """``(path, modificationTime)`` of the Parquet file last written below ``root``.

    Of several with the same time, the one with the smallest path. Only the file
    listing is read, and of the folders named by a date only those of the ``days`` latest dates: a
    snapshot of an earlier date that is written again is not found as the newest. ``None`` lists all
    dates, so that it is found. Marker files such as ``_SUCCESS`` do not count.
    """
    newest = None
    if folders := _recent(spark, root, days):
        newest = _files(spark, folders).orderBy(F.col("modificationTime").desc(), F.col("path")).first()
    if newest is None:
        raise FileNotFoundError(f"no Parquet snapshot below {root}")
    return newest


def _recent(spark: SparkSession, root: str, days: int | None) -> list[str]:
    """What lies directly in ``root``, without markers and all but the latest dates."""
    # The names of one folder: one for every date, not one for every file.
    path = spark._jvm.org.apache.hadoop.fs.Path(root)
    system = path.getFileSystem(spark._jsc.hadoopConfiguration())
    if not system.exists(path):
        return []
    names = {entry.getPath().getName(): entry.getPath().toString() for entry in system.listStatus(path)}
    dates = sorted((name for name in names if _DATE.match(name)), reverse=True)
    old = set(() if days is None else dates[days:])
    return [path for name, path in names.items() if name not in old and not name.startswith(("_", "."))]


def _files(spark: SparkSession, paths: list[str]) -> DataFrame:
    """``(path, modificationTime)`` of the Parquet files below ``paths``."""
    # A session of its own, so that the listing is cut into as many tasks as there
    # are cores and not into one per block of data it never reads.
    lister = spark.newSession()
    lister.conf.set("spark.sql.files.maxPartitionBytes", "1t")
    files = lister.read.format("binaryFile").option("recursiveFileLookup", "true").option("pathGlobFilter", "*.parquet")
    return files.load(paths).select("path", "modificationTime")


def read_newest(spark: SparkSession, root: str, scope: str = "write", days: int | None = DAYS) -> DataFrame:
    """The newest snapshot below ``root``.

    Where snapshots are committed (``sinks/commits.py``) it is that of the last commit: its files for ``write``, those of all
    commits that its folder consists of for ``folder``. A committed snapshot whose files are not all there is an error.

    ``scope`` says how much belongs to it, seen from the newest file:

    * ``write``: all files of the write that made it, so a snapshot of many files is read
      whole, and earlier appends to the same folder are left out. Other writers than Spark do not name
      their write; one file of theirs is a snapshot, and several are an error;
    * ``file``: that one file;
    * ``folder``: every file in its folder, appended ones included.

    ``days`` is that of ``newest_file``.
    """
    if scope not in ("write", "file", "folder"):
        raise ValueError(f"unknown snapshot scope {scope!r}")
    commit = last_commit(spark, root) if scope != "file" else None
    if commit is not None:
        parts = [commit] if scope == "write" else commits_of(spark, root, commit.folder)
        return reduce(DataFrame.unionByName, (read_commit(spark, root, part) for part in parts))
    folder, _, name = newest_file(spark, root, days).path.rpartition("/")
    if scope == "folder":
        return spark.read.parquet(folder)
    write_id = _WRITE_ID.match(name)
    if scope == "write" and write_id:
        return spark.read.option("pathGlobFilter", f"part-*-{write_id[1]}*.parquet").parquet(folder)
    if scope == "write" and _files(spark, [folder]).count() > 1:
        raise ValueError(
            f"{folder} has several files that do not say which write they belong to: "
            'read the newest one with scope="file" or all with scope="folder"'
        )
    return spark.read.parquet(f"{folder}/{name}")
