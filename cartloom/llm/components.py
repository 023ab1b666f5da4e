"""Connected components of an edge table by alternating large-star and small-star steps."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .store import dropped, written


def _large_star(edges: DataFrame) -> DataFrame:
    both = edges.unionByName(edges.select(F.col("low").alias("high"), F.col("high").alias("low")))
    least = both.groupBy("high").agg(F.min("low").alias("least"))
    moved = both.where("low > high").join(least, "high")
    return moved.select(F.col("low").alias("high"), F.least("high", "least").alias("low")).distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    least = edges.groupBy("high").agg(F.min("low").alias("least"))
    moved = edges.join(least, "high").where("low <> least").select(F.col("low").alias("high"), F.col("least").alias("low"))
    return moved.unionByName(least.withColumnRenamed("least", "low")).distinct()


def components(pairs: DataFrame, a: str, b: str) -> DataFrame:
    """(id, component): every id of a pair, with the smallest id it reaches. Ids in no pair are absent.

    Loops and repeated pairs are harmless; rows with a null end are ignored; no pairs give no rows.
    Each step combines map-side and is written to the shared folder.
    """
    edges = written(
        pairs.where(F.col(a) != F.col(b))
        .select(F.greatest(a, b).alias("high"), F.least(a, b).alias("low"))
        .distinct()
    )
    while True:
        lows = edges.select(F.col("low").alias("high")).distinct()
        several = edges.groupBy("high").count().where("count > 1").select("high")
        if edges.select("high").join(lows, "high", "left_semi").unionByName(several).isEmpty():
            break
        last, edges = edges, written(_small_star(_large_star(edges)))
        dropped(last)
    roots = edges.select("low").distinct()
    return edges.select(F.col("high").alias("id"), F.col("low").alias("component")).unionByName(
        roots.select(F.col("low").alias("id"), F.col("low").alias("component"))
    )
