"""Seed order items as CSV with a header."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from ..schemas import SEED_ORDER_ITEMS


def read_seed(spark: SparkSession, path: str) -> DataFrame:
    return (
        spark.read.schema(SEED_ORDER_ITEMS)
        .option("header", True)
        .option("mode", "FAILFAST")
        .csv(path)
    )


def write_seed(df: DataFrame, path: str) -> None:
    df.select(*SEED_ORDER_ITEMS.fieldNames()).write.mode("overwrite").option("header", True).csv(
        path
    )
