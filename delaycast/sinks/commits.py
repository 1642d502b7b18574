"""Numbered commits on a shared file system, and tables whose versions they name.

A commit is a small JSON file named by its number. It is written aside and moved to its name only if
no file has it, so of two writers that take one number a single one succeeds, and readers never
meet half a commit. Local file systems link the file (an existing name refuses that); others rename
it, which HDFS refuses when the name exists. Object stores without such a rename are not suited.
"""

from __future__ import annotations

import json
import os
import time
import uuid
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T


class CommitLog:
    """Commits 1, 2, ... below ``root``; old ones may have been removed, the numbers go on."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.root = root.rstrip("/")
        jvm = spark.sparkContext._jvm
        self._jvm = jvm
        self._path = jvm.org.apache.hadoop.fs.Path
        self._files = self._path(self.root).getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())

    @property
    def _local(self) -> bool:
        return self._files.getScheme() == "file"

    def _name(self, number: int) -> str:
        return f"{self.root}/{number:012d}.json"

    def numbers(self) -> list[int]:
        """The numbers that have a commit, ascending."""
        folder = self._path(self.root)
        if not self._files.exists(folder):
            return []
        names = [status.getPath().getName() for status in self._files.listStatus(folder)]
        return sorted(int(name[:-5]) for name in names if name.endswith(".json") and name[:-5].isdigit())

    def read(self, number: int) -> dict:
        stream = self._files.open(self._path(self._name(number)))
        try:
            return json.loads(self._jvm.org.apache.commons.io.IOUtils.toString(stream, "UTF-8"))
        finally:
            stream.close()

    def latest(self) -> tuple[int, dict] | None:
        numbers = self.numbers()
        return (numbers[-1], self.read(numbers[-1])) if numbers else None

    def put(self, number: int, record: dict) -> bool:
        """Commit ``record`` as ``number``; false, and nothing changed, when that number is taken."""
        aside, name = f"{self.root}/.{uuid.uuid4().hex}", self._name(number)
        self._files.mkdirs(self._path(self.root))
        if self._local:
            return _link(self._local_path(aside), self._local_path(name), record)
        stream = self._files.create(self._path(aside), False)
        stream.write(bytearray(json.dumps(record).encode()))
        stream.close()
        taken = self._files.exists(self._path(name)) or not self._files.rename(self._path(aside), self._path(name))
        if taken:
            self._files.delete(self._path(aside), False)
        return not taken

    def _local_path(self, path: str) -> Path:
        return Path(self._path(path).toUri().getPath())

    def append(self, record: dict) -> int:
        """Commit ``record`` under the next free number."""
        while True:
            numbers = self.numbers()
            number = numbers[-1] + 1 if numbers else 1
            if self.put(number, record):
                return number

    def remove(self, number: int) -> None:
        self._files.delete(self._path(self._name(number)), False)

    def remove_folder(self, path: str) -> None:
        self._files.delete(self._path(path), True)


def _link(aside: Path, name: Path, record: dict) -> bool:
    aside.write_text(json.dumps(record))
    try:
        os.link(aside, name)
    except FileExistsError:
        return False
    finally:
        aside.unlink()
    return True


def swap_folder(spark: SparkSession, written: str, path: str) -> None:
    """Put the complete folder ``written`` in the place of ``path``, whose old content goes last.

    Between two renames ``path`` is missing for a moment. If the second fails, the old folder comes back.
    """
    jvm = spark.sparkContext._jvm
    new, target = jvm.org.apache.hadoop.fs.Path(written), jvm.org.apache.hadoop.fs.Path(path)
    old = jvm.org.apache.hadoop.fs.Path(f"{written}-old")
    files = target.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    replaces = files.exists(target)
    if replaces and not files.rename(target, old):
        raise OSError(f"{path} cannot be moved")
    if not files.rename(new, target):
        if replaces:
            files.rename(old, target)
        raise OSError(f"{written} cannot be moved to {path}")
    if replaces:
        files.delete(old, True)


class Conflict(RuntimeError):
    """Another writer committed the version that this one was to follow."""


class SnapshotTable:
    """A table below ``root`` whose content is replaced whole; readers may ask for earlier versions."""

    def __init__(self, spark: SparkSession, root: str) -> None:
        self.spark, self.root = spark, root.rstrip("/")
        self.log = CommitLog(spark, f"{self.root}/log")

    def replace(self, df: DataFrame, after: int | None = None) -> int:
        """Commit ``df`` as the next version, which it returns.

        The rows go to a folder of their own first, so ``df`` may read the table itself and a failed
        write changes nothing. With ``after``, that must still be the newest version (0: there is none).
        """
        path = f"{self.root}/data/{uuid.uuid4().hex}"
        df.write.parquet(path)
        record = {"path": path, "schema": df.schema.json(), "at": time.time()}
        if after is None:
            return self.log.append(record)
        newest = max(self.log.numbers(), default=0)
        if newest != after or not self.log.put(after + 1, record):
            self.log.remove_folder(path)
            raise Conflict(f"version {after} of {self.root} is not the newest any more")
        return after + 1

    def record(self, version: int | None = None) -> dict:
        numbers = self.log.numbers()
        wanted = version if version is not None else (numbers[-1] if numbers else None)
        if wanted not in numbers:
            raise LookupError(f"no version {wanted} of {self.root}")
        return self.log.read(wanted)

    def read(self, version: int | None = None) -> DataFrame:
        """The newest content, or that of a version."""
        found = self.record(version)
        return self.spark.read.schema(T.StructType.fromJson(json.loads(found["schema"]))).parquet(found["path"])

    def version_at(self, moment: float) -> int:
        """The version that was the newest at a moment in seconds since 1970."""
        for number in reversed(self.log.numbers()):
            if self.log.read(number)["at"] <= moment:
                return number
        raise LookupError(f"no version of {self.root} is that old")

    def expire(self, keep: int) -> list[int]:
        """Remove all versions but the newest ``keep``, first their commits, then their files."""
        old = self.log.numbers()[: -max(keep, 1)]
        records = [self.log.read(number) for number in old]
        for number, record in zip(old, records):
            self.log.remove(number)
            self.log.remove_folder(record["path"])
        return old
