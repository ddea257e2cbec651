"""Folders for intermediate files that every executor can read."""

from __future__ import annotations

import tempfile
import uuid
from collections.abc import Iterator
from contextlib import contextmanager
from contextvars import ContextVar

from pyspark.sql import DataFrame, SparkSession

from retailweave.sinks.records import Folder

_run: ContextVar[str | None] = ContextVar("run", default=None)


def work_folder(spark: SparkSession) -> str:
    """A new folder below ``spark.checkpoint.dir``, the shared folder the session names.

    Only a local master may do without that setting: there the driver is the one
    executor, and a temporary folder serves. Elsewhere a missing setting is an error. Within ``run_folder`` it
    lies in the folder of the run.
    """
    if (run := _run.get()) is not None:
        return f"{run}/{uuid.uuid4().hex}"
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared:
        if not spark.sparkContext.master.startswith("local[") and spark.sparkContext.master != "local":
            raise ValueError("set spark.checkpoint.dir to a folder that the driver and all executors share")
        shared = tempfile.mkdtemp(prefix="retailweave-")
    return f"{shared.rstrip('/')}/retailweave-{uuid.uuid4().hex}"


@contextmanager
def run_folder(spark: SparkSession) -> Iterator[str]:
    """A folder for all intermediate files of the block, which are deleted at its end, be it by an error.

    What is made in the block has to be used or written elsewhere within it, as its rows are in those files.
    """
    path = work_folder(spark)
    token = _run.set(path)
    try:
        yield path
    finally:
        _run.reset(token)
        Folder(spark, path).delete()


def written(df: DataFrame) -> DataFrame:
    """``df`` as a Parquet table in a new work folder: its lineage ends there and lost tasks read it again."""
    path = work_folder(df.sparkSession)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)
