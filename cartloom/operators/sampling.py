"""Month-weighted row sampling."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from ..functions.lookups import MONTH_WEIGHTS, lookup_constant


def uniform_of(key: Column | str) -> Column:
    """A number in [0, 1) fixed by the key: the first 32 bits of its MD5.

    Unlike ``rand()`` it survives task retries and repeats from run to run.
    """
    key = F.col(key) if isinstance(key, str) else key
    bits = F.conv(F.substring(F.md5(key.cast("string")), 1, 8), 16, 10).cast("bigint")
    return bits / F.lit(4294967296.0)


def month_weighted_sample(df: DataFrame, key: str, day: str) -> DataFrame:
    """Keep a row when its uniform number exceeds ``1 / weight`` of its month.

    The keep rate is ``max(0, 1 - 1 / weight)``: months weighing 1 or less keep nothing.
    """
    weight = lookup_constant(F.month(day), MONTH_WEIGHTS, default=1.0)
    return df.filter(uniform_of(key) > F.lit(1.0) / weight)
