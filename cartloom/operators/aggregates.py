"""Run summaries and the business questions asked of the star."""

from __future__ import annotations

from collections.abc import Mapping
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


def batch_counts(frames: Mapping[str, DataFrame]) -> DataFrame:
    """Records per entity, 0 for an empty one, and a ``total`` row."""
    counted = [
        df.agg(F.count("*").alias("records")).select(F.lit(name).alias("entity"), "records")
        for name, df in frames.items()
    ]
    # One row per entity from here on.
    return (
        reduce(DataFrame.unionAll, counted)
        .rollup("entity")
        .agg(F.sum("records").alias("records"))
        .select(F.coalesce("entity", F.lit("total")).alias("entity"), "records")
    )


def load_summary(bound: DataFrame, by: str = "_file", rejected: str = "_rejected") -> DataFrame:
    """Rows parsed, loaded and rejected per file of a bound load; counts are never NULL."""
    bad = F.count_if(F.col(rejected))
    return bound.groupBy(by).agg(
        F.count("*").alias("parsed"),
        (F.count("*") - bad).alias("loaded"),
        bad.alias("rejected"),
    )


def order_summary(
    df: DataFrame, amount: str, distinct: str, day: str, position: str
) -> DataFrame:
    """Global revenue, distinct count, and the first and last day in row order."""
    return df.agg(
        F.sum(F.col(amount).cast("decimal(18,2)")).cast("decimal(38,2)").alias("total_amount"),
        F.countDistinct(distinct).alias("distinct_count"),
        F.min_by(day, position).alias("first_date"),
        F.max_by(day, position).alias("last_date"),
    )


def units_by_category_month(
    fact: DataFrame,
    products: DataFrame | None = None,
    key: str = "product_key",
    category: str = "category",
    quantity: str = "quantity",
    day: str = "order_date",
) -> DataFrame:
    """Units sold per category and calendar month.

    Units are summed per product and month first. The join to the dimension then moves one row
    per product and month instead of every order item, which also flattens hot products. Without
    ``products`` the fact carries the category already, as an as-of join can take it along.
    """
    month = F.date_format(day, "yyyy-MM")
    if products is None:
        sold = F.sum(F.col(quantity).cast("decimal(18,2)")).cast("decimal(38,2)")
        known = fact.filter(F.col(key).isNotNull())
        return known.groupBy(F.col(category).alias("category"), month.alias("month")).agg(sold.alias("units"))
    per_product = (
        fact.filter(F.col(key).isNotNull())
        .groupBy(key, month.alias("month"))
        .agg(F.sum(F.col(quantity).cast("decimal(18,2)")).alias("units"))
    )
    return (
        per_product.join(products.select(key, category), key)
        .groupBy(F.col(category).alias("category"), "month")
        .agg(F.sum("units").cast("decimal(38,2)").alias("units"))
    )


def price_at_order(fact: DataFrame) -> DataFrame:
    """The price in force when each order item was placed."""
    return fact.select("order_item_key", "order_id", "product_id", "order_date", "unit_price")


def first_n(df: DataFrame, n: int, *key: str) -> DataFrame:
    """The first ``n`` rows in key order; each task keeps only its own first ``n``."""
    return df.orderBy(*key).limit(n)
