"""Latest row per key."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

_RANK = "__rank"


def latest_per_key(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """Keep the first row of every key under ``order``.

    ``order`` must be total (end it with tie-break columns) and spell out where NULLs go.
    Catalyst turns the rank filter into a partial group limit below the exchange: each map
    task ships at most one row per key, so one hot key costs one row per task.
    """
    if len(order) < 2:
        raise ValueError("order needs at least one tie-break column after the load time")
    ranking = Window.partitionBy(*keys).orderBy(*order)
    return (
        df.withColumn(_RANK, F.row_number().over(ranking)).filter(F.col(_RANK) == 1).drop(_RANK)
    )


def bronze_order() -> list[Column]:
    """Newest load first; ties go to the later file, then to the later row of that file."""
    return [
        F.col("_loaded_at").desc_nulls_first(),
        F.col("_file").desc_nulls_last(),
        F.col("_row_tag").desc_nulls_last(),
    ]


def merge_latest(
    current: DataFrame, arrived: DataFrame, keys: Sequence[str], order: Sequence[Column]
) -> DataFrame:
    """Incremental form: fold new rows into an already deduplicated table.

    Equal to ``latest_per_key`` over everything ever loaded, because the maximum is associative.
    """
    return latest_per_key(current.unionByName(arrived), keys, order)
