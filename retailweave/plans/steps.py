"""A ledger of the steps of a chain, so that a chain that broke off goes on where it stopped.

A run of a chain has a folder of records: one when a step begins and one when it is finished. The next call looks at the
last run. If that did not finish, its finished steps are passed over, and the step that broke off first takes back what it left;
else a new run begins.
"""

from __future__ import annotations

import time
from collections.abc import Callable

from pyspark.sql import SparkSession

from retailweave.sinks.commits import discard, last_commit, write_ids
from retailweave.sinks.records import Folder


class Steps:
    """Runs each step at once; of a chain without a ledger."""

    def run(self, name: str, action: Callable[[], object], target: Target | None = None) -> None:
        action()

    def finish(self) -> None:
        pass


class Target:
    """What a step writes, as far as a repetition has to know: the state before, and how to get back to it."""

    def state(self) -> dict:
        return {}

    def restore(self, state: dict) -> bool:
        """Takes back what a broken step left; True if it turns out that the step was complete."""
        return False


class FileTarget(Target):
    """A folder of files that Spark writes. Files of writes that were not there before are deleted."""

    def __init__(self, spark: SparkSession, path: str, mode: str):
        self.spark, self.path, self.mode = spark, path, mode

    def state(self) -> dict:
        return {"existed": Folder(self.spark, self.path).exists(), "writes": write_ids(self.spark, self.path) if self.mode == "append" else []}

    def restore(self, state: dict) -> bool:
        if self.mode == "append":
            discard(self.spark, self.path, set(state["writes"]))
        elif self.mode == "errorifexists" and not state["existed"]:
            Folder(self.spark, self.path).delete()
        return False


class CommittedTarget(FileTarget):
    """A snapshot with a manifest: complete if there is a commit that was not there before."""

    def __init__(self, spark: SparkSession, root: str, folder: str, mode: str):
        super().__init__(spark, f"{root.rstrip('/')}/{folder}", mode)
        self.root, self.folder = root, folder

    def state(self) -> dict:
        commit = last_commit(self.spark, self.root, self.folder)
        return super().state() | {"commit": commit.number if commit else None}

    def restore(self, state: dict) -> bool:
        commit = last_commit(self.spark, self.root, self.folder)
        if commit is not None and commit.number != state["commit"]:
            return True
        return super().restore(state)


class UnknownTarget(Target):
    """A table of another system. A broken append to it can't be taken back."""

    def __init__(self, name: str, mode: str, repeatable: bool):
        self.name, self.refused = name, mode == "append" and not repeatable

    def restore(self, state: dict) -> bool:
        if self.refused:
            raise RuntimeError(f"an append to {self.name} broke off and may have left rows there: give its keys in append_keys, or clear it up")
        return False


class Ledger(Steps):
    """The steps of the last unfinished run of a chain, or of a new one."""

    def __init__(self, spark: SparkSession, path: str):
        runs = Folder(spark, path)
        last = max((int(name) for name in runs.children() if name.isdigit()), default=None)
        unfinished = last is not None and Folder(spark, f"{path}/{last:06d}").get("finished") is None
        number = last if unfinished else 0 if last is None else last + 1
        self._records = Folder(spark, f"{path.rstrip('/')}/{number:06d}")
        self.resumed = unfinished

    def run(self, name: str, action: Callable[[], object], target: Target | None = None) -> None:
        target = target or Target()
        if self._records.get(f"done-{name}") is not None:
            return
        begun = self._records.get(f"begun-{name}")
        if begun is None:
            self._records.put(f"begun-{name}", target.state() | {"at": time.time()})
        if begun is None or not target.restore(begun):
            action()
        self._records.put(f"done-{name}", {"at": time.time()})

    def finish(self) -> None:
        self._records.put("finished", {"at": time.time()})
