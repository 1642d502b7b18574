"""CSV and replaceable tables."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame

from delaycast.sinks.commits import SnapshotTable, swap_folder

# Versions of a replaced table that stay readable.
KEPT_VERSIONS = 5


def write_csv(df: DataFrame, path: str) -> None:
    """CSV with header and doubled quotes, replacing what was there.

    The rows are written beside ``path`` and take its place when they are complete, so a failed write
    leaves the old files as they were, and ``df`` may itself read them.
    """
    folder, _, name = path.rstrip("/").rpartition("/")
    aside = f"{folder}/_{name}-{uuid.uuid4().hex}" if folder else f"_{name}-{uuid.uuid4().hex}"
    df.write.option("header", True).option("escape", '"').csv(aside)
    swap_folder(df.sparkSession, aside, path)


def replace_table(df: DataFrame, name: str, root: str, keep: int = KEPT_VERSIONS) -> str:
    """Create or replace the table ``name`` with ``df``; returns the path of its files.

    The rows become the next version of a snapshot table and the name is then pointed at it, so
    readers see the old or the new content, ``df`` may itself read the old one, and a failed write
    changes nothing. The newest ``keep`` versions stay for those who still read them.
    """
    table = SnapshotTable(df.sparkSession, f"{root.rstrip('/')}/{name}")
    path = table.record(table.replace(df))["path"]
    df.sparkSession.sql(f"CREATE OR REPLACE VIEW {name} AS SELECT * FROM parquet.`{path}`")
    table.expire(keep)
    return path
