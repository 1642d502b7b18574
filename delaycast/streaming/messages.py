"""Messages of flight rows. All steps are row-wise, so they serve streams and tables alike."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from delaycast.functions.missing import clean_decoded_json
from delaycast.schemas import MESSAGE_RECORD

# Message fields in which the text NaN can only mean "missing".
DESCRIPTION_FIELDS = ["arr_weather_description", "dep_weather_description"]


def decode_messages(messages: DataFrame, record: T.StructType = MESSAGE_RECORD, *carry: str) -> DataFrame:
    """``value`` -> carried columns, ``value, rows``; a message is a JSON array of rows or a single row object.

    ``rows`` is NULL when the message cannot be decoded.
    """
    return messages.select(*carry, "value", F.from_json("value", T.ArrayType(record)).alias("rows"))


def message_rows(messages: DataFrame, record: T.StructType = MESSAGE_RECORD) -> DataFrame:
    """The rows of all messages, missing values normalised."""
    rows = decode_messages(messages, record).select(F.inline("rows"))
    return clean_decoded_json(rows, DESCRIPTION_FIELDS)


def message_counts(messages: DataFrame, record: T.StructType = MESSAGE_RECORD) -> DataFrame:
    """One row: messages read, messages rejected, rows delivered."""
    decoded = decode_messages(messages, record)
    return decoded.selectExpr(
        "count(*) AS messages",
        "count_if(rows IS NULL) AS rejected",
        "coalesce(sum(array_size(rows)), 0) AS rows",
    )
