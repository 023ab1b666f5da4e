"""The star: three dimensions and the order-item fact."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import date_key, date_spine
from ..functions.keys import surrogate_key
from ..operators.asof import asof_left
from ..operators.unions import union_sources

FACT_COLUMNS = (
    "order_item_key", "order_id", "customer_key", "product_key", "date_key", "product_id",
    "user_id", "quantity", "unit_price", "total_price", "order_date", "loaded_at", "run_id",
)


def dim_date(spark: SparkSession, start: str = "2024-01-01", days: int = 730) -> DataFrame:
    """Calendar dimension over a spine of consecutive days; weekdays count from Sunday = 0."""
    weekday = F.dayofweek("full_date") - 1
    return date_spine(spark, start, days).select(
        date_key("full_date").alias("date_key"),
        "full_date",
        weekday.alias("day_of_week"),
        F.dayname("full_date").alias("day_name"),
        F.month("full_date").alias("month"),
        F.monthname("full_date").alias("month_name"),
        F.quarter("full_date").alias("quarter"),
        F.year("full_date").alias("year"),
        weekday.isin(0, 6).alias("is_weekend"),
    )


def dim_product(history: DataFrame) -> DataFrame:
    """Every product version with its key and validity."""
    return history.select(
        surrogate_key(history, ["product_id", "valid_from"]).alias("product_key"),
        "product_id",
        "product_name",
        "category",
        "price",
        "description",
        "image_url",
        "rating_score",
        "rating_count",
        F.col("valid_from").alias("effective_from"),
        F.col("valid_to").alias("effective_to"),
        "loaded_at",
        "load_date",
    )


def dim_customer(history: DataFrame) -> DataFrame:
    """Every customer version; the full name is NULL when either part is."""
    return history.select(
        surrogate_key(history, ["user_id", "valid_from"]).alias("customer_key"),
        "user_id",
        "first_name",
        "last_name",
        F.concat("first_name", F.lit(" "), "last_name").alias("full_name"),
        "email",
        "username",
        "city",
        "street",
        "zipcode",
        "phone",
        F.col("valid_from").alias("effective_from"),
        F.col("valid_to").alias("effective_to"),
        "loaded_at",
        "load_date",
    )


def _instant_type(products: DataFrame) -> str:
    return products.schema["effective_from"].dataType.simpleString()


def cart_lines(carts: DataFrame, instant: str = "timestamp") -> DataFrame:
    """Cart items in the grain shared by both order sources; they carry no price."""
    return carts.select(
        F.lit(False).alias("is_seed"),
        F.lit(None).cast("bigint").alias("order_item_id"),
        F.col("cart_id").alias("order_id"),
        "product_id",
        "user_id",
        "quantity",
        F.lit(None).cast("double").alias("own_price"),
        F.lit(None).cast("double").alias("own_total"),
        F.col("cart_date").cast(instant).alias("order_date"),
        F.col("loaded_at").cast(instant).alias("loaded_at"),
    )


def seed_lines(seed: DataFrame, instant: str = "timestamp") -> DataFrame:
    """Seed order items in the shared grain; they keep their own price and total."""
    return seed.select(
        F.lit(True).alias("is_seed"),
        "order_item_id",
        "order_id",
        "product_id",
        "user_id",
        "quantity",
        F.col("unit_price").alias("own_price"),
        F.col("total_price").alias("own_total"),
        F.col("order_date").cast(instant).alias("order_date"),
        F.lit(None).cast(instant).alias("loaded_at"),
    )


def date_key_join(
    df: DataFrame, dates: DataFrame, day: str, name: str = "date_key"
) -> DataFrame:
    """Add the key of the calendar row of ``day``; NULL outside the calendar."""
    keys = dates.select(F.col("date_key").alias("__date_key"))
    joined = df.join(keys, date_key(day) == F.col("__date_key"), "left")
    return joined.withColumnRenamed("__date_key", name)


def _late_keyed(dim: DataFrame, lines: DataFrame, key: str, natural: str) -> DataFrame:
    """``dim`` in a form whose surrogate keys can be hashed again from the lines that matched it.

    ``__from_of_key`` is the start of a version whose key is the hash of its natural key and start, as the dimensions
    of this module have it; ``__given_key`` is any other key, to be carried as it is.
    """
    kind = dim.schema[natural].dataType
    # Equal numbers of one whole type have one text, which other types do not promise.
    hashed = F.lit(False)
    if isinstance(kind, T.IntegralType) and lines.schema[natural].dataType == kind:
        hashed = F.coalesce(F.col(key) == surrogate_key(dim, [natural, "effective_from"]), hashed)
    return dim.withColumns(
        {
            "__from_of_key": F.when(hashed, F.col("effective_from")),
            "__given_key": F.when(~hashed, F.col(key)),
        }
    )


def build_fact(
    carts: DataFrame,
    seed: DataFrame,
    products: DataFrame,
    customers: DataFrame,
    dates: DataFrame,
    hot_products: list | None = None,
    hot_customers: list | None = None,
) -> DataFrame:
    """Order items of both sources, priced and keyed as of their own order date.

    The sources are stacked before the star joins, so each dimension is joined once instead of
    once per source. Constants of one branch still prune it: a reader that filters on
    ``loaded_at IS NOT NULL`` never scans the seed. Customers are met first, as their versions leave
    less to carry into the second join than prices would. Item and customer keys are hashed after
    the joins, which keeps their text out of the shuffles.
    """
    instant = _instant_type(products)
    lines = union_sources(cart_lines(carts, instant), seed_lines(seed, instant))
    keyed = asof_left(
        lines, _late_keyed(customers, lines, "customer_key", "user_id"), "user_id", "order_date",
        {"customer_from": "__from_of_key", "given_customer_key": "__given_key"}, hot_keys=hot_customers,
    )
    priced = asof_left(
        keyed, products, "product_id", "order_date",
        {"product_key": "product_key", "valid_price": "price"}, hot_keys=hot_products,
    )
    starred = date_key_join(priced, dates, "order_date")
    own = F.col("is_seed")
    item_key = F.when(own, surrogate_key(starred, ["order_item_id"])).otherwise(
        surrogate_key(starred, ["order_id", "product_id"])
    )
    customer_key = F.when(
        F.col("customer_from").isNotNull(), surrogate_key(starred, ["user_id", "customer_from"])
    ).otherwise(F.col("given_customer_key"))
    valid_total = F.col("quantity") * F.col("valid_price")
    return starred.withColumns(
        {
            "order_item_key": item_key,
            "customer_key": customer_key,
            "unit_price": F.when(own, F.col("own_price")).otherwise(F.col("valid_price")),
            "total_price": F.when(own, F.col("own_total")).otherwise(valid_total),
            "run_id": F.lit(None).cast("string"),
        }
    ).select(*FACT_COLUMNS)
