"""Ledger of ingest runs: what a run has committed, so that its rerun goes on
from there.

A run owns the folder ``<runs>/<day>/<run id>/`` with its rows, its outbox of
messages and one empty marker file per committed step.  A step is repeated
until its marker stands; every step gives the same result when repeated.
Files and folders are the Hadoop file system's, so any shared store will do.
"""

from __future__ import annotations

import time
import uuid
from dataclasses import dataclass

from pyspark.sql import SparkSession

from ..session import make_folder

# Steps of a run in order: its rows and messages are written; its rows are in
# the table; its messages are in the topic.
STAGED, IN_TABLE, PUBLISHED = STEPS = ("staged", "in_table", "published")
REPLACES = "replaces_day"


@dataclass(frozen=True)
class Run:
    day: str
    run_id: str
    path: str
    marks: frozenset[str]

    @property
    def rows(self) -> str:
        return f"{self.path}/rows"

    @property
    def outbox(self) -> str:
        return f"{self.path}/outbox"

    @property
    def finished(self) -> bool:
        return PUBLISHED in self.marks


class RunLedger:
    """Runs below one folder, by day."""

    def __init__(self, spark: SparkSession, runs: str):
        self.runs = runs.rstrip("/")
        self._jvm, self._hadoop = spark.sparkContext._jvm, spark.sparkContext._jsc.hadoopConfiguration()
        self._spark = spark

    def _path(self, path: str):
        found = self._jvm.org.apache.hadoop.fs.Path(path)
        return found, found.getFileSystem(self._hadoop)

    def _names(self, path: str) -> list[str]:
        folder, fs = self._path(path)
        return sorted(s.getPath().getName() for s in fs.listStatus(folder)) if fs.exists(folder) else []

    def days(self) -> list[str]:
        return self._names(self.runs)

    def run(self, day, run_id: str) -> Run:
        path = f"{self.runs}/{day}/{run_id}"
        return Run(str(day), run_id, path, frozenset(n[1:] for n in self._names(path) if n.startswith("_")))

    def unfinished(self, day) -> list[Run]:
        """Runs of a day that did not publish, in the order they began."""
        folder, fs = self._path(f"{self.runs}/{day}")
        found = []
        for name in self._names(f"{self.runs}/{day}"):
            run = self.run(day, name)
            if "begun" in run.marks and not run.finished:
                began = self._path(f"{run.path}/_begun")[0]
                found.append((fs.getFileStatus(began).getModificationTime(), name, run))
        return [run for _, _, run in sorted(found, key=lambda x: x[:2])]

    def begin(self, day, run_id: str | None, replaces: bool) -> Run:
        run = self.run(day, run_id or uuid.uuid4().hex)
        if "begun" not in run.marks:
            make_folder(self._spark, run.path)
            if replaces:
                self._touch(f"{run.path}/_{REPLACES}")
            self._touch(f"{run.path}/_begun")
        return self.run(day, run.run_id)

    def mark(self, run: Run, step: str) -> Run:
        self._touch(f"{run.path}/_{step}")
        return self.run(run.day, run.run_id)

    def _touch(self, path: str) -> None:
        file, fs = self._path(path)
        fs.create(file, True).close()

    def move(self, source: str, target: str) -> None:
        """Make a folder appear at ``target`` at once; done before: nothing.
        Its files count as written now, so a reader that orders by time sees
        a late recovery as the latest."""
        (src, fs), (dst, _) = self._path(source), self._path(target)
        if fs.exists(dst):
            return
        now = int(time.time() * 1000)
        for status in fs.listStatus(src):
            fs.setTimes(status.getPath(), now, -1)
        make_folder(self._spark, target.rsplit("/", 1)[0])
        if not fs.rename(src, dst):
            raise OSError(f"{source} could not be moved to {target}")
