"""Where a workload module lists its queries and their oracles."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

Build = Callable[[SparkSession, str], DataFrame]


class Registry:
    def __init__(self) -> None:
        self.queries: dict[str, Build] = {}
        self.oracle: dict[str, str] = {}

    def query(self, name: str, sql: str | None = None) -> Callable[[Build], Build]:
        """Register the decorated function under ``name``; without ``sql`` only rows are checked."""

        def add(build: Build) -> Build:
            self.queries[name] = build
            if sql is not None:
                self.oracle[name] = sql
            return build

        return add
