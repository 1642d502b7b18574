"""Projections that shape a table: select, sort, add, prefix and cast columns."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

from delaycast.functions.missing import replace_columns


def select_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """The configured columns, in the configured order."""
    return df.select(*columns)


def sort_columns(df: DataFrame) -> DataFrame:
    """All columns in alphabetical order."""
    return df.select(*sorted(df.columns))


def ensure_columns(df: DataFrame, columns: list[str]) -> DataFrame:
    """Add each named column that is absent, as an empty text; leave the others alone."""
    absent = [c for c in columns if c not in df.columns]
    return replace_columns(df, {c: "''" for c in absent}) if absent else df


def conform(df: DataFrame, schema: T.StructType) -> DataFrame:
    """Exactly the schema's columns, cast to its types; absent ones become NULL."""
    present = set(df.columns)
    return df.selectExpr(
        *[
            f"CAST({f'`{f.name}`' if f.name in present else 'NULL'} AS {f.dataType.simpleString()}) AS `{f.name}`"
            for f in schema
        ]
    )


def prefix_columns(df: DataFrame, prefix: str, columns: list[str]) -> DataFrame:
    """Rename the named columns to ``prefix`` + name."""
    return df.selectExpr(*[f"`{c}` AS `{prefix}{c}`" if c in columns else f"`{c}`" for c in df.columns])


def to_numeric(df: DataFrame, columns: list[str] | None = None) -> DataFrame:
    """Cast columns (default: all) to double; text that is no number becomes NULL."""
    chosen = df.columns if columns is None else columns
    return replace_columns(df, {c: f"TRY_CAST(`{c}` AS DOUBLE)" for c in chosen})
