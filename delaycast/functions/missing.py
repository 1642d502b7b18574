"""The several spellings of "missing" and how each is normalised.

Expressions are built as SQL text of column names: one parse instead of a call per operator.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import types as T

# The token that stands for a missing category in training and serving alike,
# and what a bare JSON NaN becomes when it is read into a string field.
NULL_TOKEN = "null"
JSON_NAN_AS_TEXT = '"NaN"'

_FLOATING = (T.DoubleType, T.FloatType)


def is_missing(df: DataFrame, name: str) -> str:
    """SQL test for NULL and, on floating types, for NaN."""
    floating = isinstance(df.schema[name].dataType, _FLOATING)
    return f"(`{name}` IS NULL OR isnan(`{name}`))" if floating else f"(`{name}` IS NULL)"


def nan_to_null(name: str) -> str:
    """NaN -> NULL; Spark orders NaN above every number, so it must not reach an aggregate."""
    return f"nullif(CAST(`{name}` AS DOUBLE), DOUBLE('NaN'))"


def filled(df: DataFrame, name: str, token: str = NULL_TOKEN, number: float = 0.0) -> str:
    """A column without missing values: the token in text, the number in numeric columns."""
    dtype = df.schema[name].dataType
    if isinstance(dtype, T.StringType):
        return f"coalesce(`{name}`, '{token}')"
    value = nan_to_null(name) if isinstance(dtype, T.DoubleType) else f"`{name}`"
    return f"coalesce({value}, CAST({number} AS {dtype.simpleString()}))"


def replace_columns(df: DataFrame, expressions: dict[str, str]) -> DataFrame:
    """``df`` with the named columns replaced in place and new ones appended, in one projection."""
    kept = [f"{expressions[c]} AS `{c}`" if c in expressions else f"`{c}`" for c in df.columns]
    added = [f"{e} AS `{c}`" for c, e in expressions.items() if c not in df.columns]
    return df.selectExpr(*kept, *added)


def fill_missing(df: DataFrame, columns: list[str], token: str = NULL_TOKEN, number: float = 0.0) -> DataFrame:
    """NULL -> token in string columns, NULL or NaN -> number in numeric ones."""
    return replace_columns(df, {c: filled(df, c, token, number) for c in columns})


def clean_decoded_json(df: DataFrame, description_columns: list[str]) -> DataFrame:
    """Undo bare NaN tokens in rows decoded from JSON.

    A bare NaN arrives as a quoted 5-character text in string fields and as NaN in doubles; both
    become NULL. The unquoted text ``NaN`` is treated as missing in description columns only:
    ``NAN`` is a real airport code, so code columns are never matched against it.
    """
    cleaned = {}
    for field in df.schema:
        if isinstance(field.dataType, T.DoubleType):
            cleaned[field.name] = nan_to_null(field.name)
        elif isinstance(field.dataType, T.StringType):
            value = f"nullif(`{field.name}`, '{JSON_NAN_AS_TEXT}')"
            cleaned[field.name] = f"nullif({value}, 'NaN')" if field.name in description_columns else value
    return replace_columns(df, cleaned)
