"""A streaming source over polled answers: each poll lands a snapshot, each snapshot is read once.

A snapshot is a file or a folder of files below one path, and its name grows with time. Folders
count once their ``_SUCCESS`` file is there, files once they have their name (write aside, then
rename); names that begin with a dot or an underscore are not looked at. The offset is the name of
the last snapshot, so a restarted query goes on behind it.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import pyarrow as pa
from pyarrow import fs
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.datasource import DataSource, DataSourceStreamReader, InputPartition

FORMAT = "polled_snapshots"
# Bytes of a snapshot's file that one task reads, and lines of an output batch.
SPLIT_BYTES, BATCH_LINES = 32 << 20, 2000


@dataclass
class Part(InputPartition):
    """The lines that begin within [start, end) of a file."""

    snapshot: str
    path: str
    start: int
    end: int


def _open_path(path: str) -> tuple[fs.FileSystem, str]:
    return fs.FileSystem.from_uri(path) if "://" in path or path.startswith("file:") else (fs.LocalFileSystem(), path)


def lines_of(path: str, start: int, end: int) -> Iterator[bytes]:
    """Lines that begin within [start, end); whoever cuts a file into such parts gets each line once."""
    files, inner = _open_path(path)
    with files.open_input_file(inner) as file:
        rest, at = b"", start
        if start:
            at = start - 1
            file.seek(at)
        skip = start > 0  # up to the first line break: that line begins in the part before
        while True:
            chunk = file.read(1 << 20)
            if not chunk:
                if rest and not skip and at < end:
                    yield rest
                return
            rest += chunk
            *whole, rest = rest.split(b"\n")
            for line in whole:
                if skip:
                    skip = False
                elif at >= end:
                    return
                else:
                    yield line
                at += len(line) + 1
            if not skip and at >= end:
                return


class SnapshotReader(DataSourceStreamReader):
    def __init__(self, path: str, split_bytes: int) -> None:
        self.path, self.split_bytes = path.rstrip("/"), split_bytes

    def _landed(self) -> list[fs.FileInfo]:
        files, inner = _open_path(self.path)
        found = files.get_file_info(fs.FileSelector(inner, allow_not_found=True))
        names = [info for info in found if info.base_name[0] not in "._"]
        done = [
            info
            for info in names
            if info.type == fs.FileType.File
            or files.get_file_info(f"{info.path}/_SUCCESS").type == fs.FileType.File
        ]
        return sorted(done, key=lambda info: info.base_name)

    def initialOffset(self) -> dict:
        return {"after": ""}

    def latestOffset(self) -> dict:
        landed = self._landed()
        return {"after": landed[-1].base_name if landed else ""}

    def partitions(self, start: dict, end: dict) -> list[Part]:
        files, _ = _open_path(self.path)
        parts = []
        for info in self._landed():
            if not start["after"] < info.base_name <= end["after"]:
                continue
            inside = [info]
            if info.type == fs.FileType.Directory:
                inside = [f for f in files.get_file_info(fs.FileSelector(info.path)) if f.base_name[0] not in "._"]
            for file in sorted(inside, key=lambda f: f.path):
                where = f"{self.path}/{info.base_name}"
                where += "" if file is info else f"/{file.base_name}"
                for at in range(0, file.size, self.split_bytes):
                    parts.append(Part(info.base_name, where, at, min(at + self.split_bytes, file.size)))
        return parts

    def read(self, partition: Part) -> Iterator[pa.RecordBatch]:
        held: list[str] = []

        def batch() -> pa.RecordBatch:
            names = pa.array([partition.snapshot] * len(held), pa.string())
            return pa.RecordBatch.from_arrays([names, pa.array(held, pa.string())], ["snapshot", "value"])

        for line in lines_of(partition.path, partition.start, partition.end):
            if line.strip():
                held.append(line.decode("utf-8", "replace").rstrip("\r"))
                if len(held) >= BATCH_LINES:
                    yield batch()
                    held = []
        if held:
            yield batch()


class PolledSnapshots(DataSource):
    """Columns ``snapshot`` (its name) and ``value`` (one line)."""

    @classmethod
    def name(cls) -> str:
        return FORMAT

    def schema(self) -> str:
        return "snapshot string, value string"

    def streamReader(self, schema) -> SnapshotReader:
        return SnapshotReader(self.options["path"], int(self.options.get("splitBytes", SPLIT_BYTES)))


def read_snapshots(spark: SparkSession, path: str, split_bytes: int = SPLIT_BYTES) -> DataFrame:
    """Stream of the lines of all snapshots below ``path``, which driver and executors must share."""
    spark.dataSource.register(PolledSnapshots)
    return spark.readStream.format(FORMAT).option("splitBytes", str(split_bytes)).load(path)
