"""Hashed surrogate keys."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

# Fixed value: text standing in for a NULL key part.
NULL_PART = "_dbt_utils_surrogate_key_null_"


def surrogate_key(df: DataFrame, columns: Sequence[str]) -> Column:
    """MD5 over the text of ``columns`` joined by ``-``.

    Instants are rendered as zone-less UTC, so that the session zone cannot change a key;
    this is why the frame, not just the names, is needed.
    """
    parts = [F.coalesce(_key_text(df, name), F.lit(NULL_PART)) for name in columns]
    return F.md5(F.concat_ws("-", *parts))


def _key_text(df: DataFrame, name: str) -> Column:
    column = F.col(name)
    if isinstance(df.schema[name].dataType, T.TimestampType):
        column = F.convert_timezone(None, F.lit("UTC"), column.cast("timestamp_ntz"))
    return column.cast("string")
