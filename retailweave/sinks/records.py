"""Small JSON records in a folder of any file system that Spark can write to.

A record is written under another name and renamed, so that a reader sees all of it or nothing, and it is never
changed: what is new gets a name of its own. Names sort in the order of time where the caller numbers them.
"""

from __future__ import annotations

import json
import uuid

from pyspark.sql import SparkSession


class Folder:
    """A folder of records. ``path`` is a URI or a path of the session's default file system."""

    def __init__(self, spark: SparkSession, path: str):
        self.spark, self.path = spark, path.rstrip("/")
        self._hadoop = spark._jvm.org.apache.hadoop.fs
        self._system = self._at().getFileSystem(spark._jsc.hadoopConfiguration())

    def _at(self, name: str = ""):
        return self._hadoop.Path(f"{self.path}/{name}" if name else self.path)

    def names(self) -> list[str]:
        """Names of the records, sorted."""
        if not self._system.exists(self._at()):
            return []
        names = (entry.getPath().getName() for entry in self._system.listStatus(self._at()))
        return sorted(name.removesuffix(".json") for name in names if name.endswith(".json") and not name.startswith((".", "_")))

    def get(self, name: str) -> dict | None:
        at = self._at(f"{name}.json")
        if not self._system.exists(at):
            return None
        stream = self._system.open(at)
        try:
            return json.loads(bytes(stream.readAllBytes()).decode())
        finally:
            stream.close()

    def put(self, name: str, record: dict) -> None:
        """A new record; one of that name that is there already is an error."""
        at, held = self._at(f"{name}.json"), self._at(f".{name}-{uuid.uuid4().hex}")
        if self._system.exists(at):
            raise FileExistsError(f"{self.path}/{name}.json")
        stream = self._system.create(held, False)
        try:
            stream.write(json.dumps(record).encode())
        finally:
            stream.close()
        if not self._system.rename(held, at):
            self._system.delete(held, False)
            raise FileExistsError(f"{self.path}/{name}.json")

    def append(self, record: dict) -> str:
        """A record under the next number."""
        names = self.names()
        name = f"{int(names[-1]) + 1 if names else 0:012d}"
        self.put(name, record)
        return name

    def last(self) -> dict | None:
        """The record with the highest name."""
        names = self.names()
        return self.get(names[-1]) if names else None

    # Whole files and folders, for what lies beside the records.

    def children(self) -> list[str]:
        """Names of the files and folders in the folder; none if it does not exist."""
        if not self._system.exists(self._at()):
            return []
        return sorted(entry.getPath().getName() for entry in self._system.listStatus(self._at()))

    def exists(self) -> bool:
        return self._system.exists(self._at())

    def size(self) -> int:
        """Bytes of all files in the folder."""
        return self._system.getContentSummary(self._at()).getLength()

    def delete(self, name: str = "") -> None:
        self._system.delete(self._at(name), True)

    def move(self, to: str) -> bool:
        """Renames the folder; False if there is something of that name."""
        target = self._hadoop.Path(to)
        if self._system.exists(target):
            return False
        self._system.mkdirs(target.getParent())
        return self._system.rename(self._at(), target)
