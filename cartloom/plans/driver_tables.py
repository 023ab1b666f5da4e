"""The given order tables in the roles the engine works on.

Everything here is derived row by row (or by the join named in the docstring) from whole
tables, so each role grows with them.
"""

from __future__ import annotations

import uuid

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from ..operators.bronze import RECORD, bind_entity, bind_fields, split_rejects
from ..operators.dedup import latest_per_key
from ..schemas import ENTITY_SPECS, Field
from ..session import ensure_checkpoint_dir
from ..sources.json_scan import listed_files

SPINE_START, SPINE_DAYS = "1995-01-01", 2000
FIRST_VERSION = "1996-01-01"
SECOND_VERSION = "1998-01-01"
SOURCE = "order-tables"


# Declared, so that opening a table does not start a job to read file footers.
SCHEMAS = {
    "nation": "n_nationkey int, n_name string, n_regionkey int",
    "customer": (
        "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string"
    ),
    "part": (
        "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, "
        "p_retailprice double"
    ),
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}


def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf}/{name}.parquet")


def _dealt(rows: DataFrame, key: str) -> DataFrame:
    """Narrow rows dealt out by their unique key before they are made into records.

    Records of all loads are many times as large as the compressed row group that one task reads them from.
    """
    return rows.repartition(key)


def _spread(rows: DataFrame, *keys: str) -> DataFrame:
    """Narrow rows dealt out over all shuffle partitions, which stay apart.

    Merged again by the bytes of the narrow rows, they would leave a task more records to sort than it can hold.
    """
    return rows.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *keys)


def ntz(text: str) -> Column:
    return F.lit(text).cast("timestamp_ntz")


def as_ntz(column: str) -> Column:
    """UTC instant without a zone (sessions of this package run in UTC)."""
    return F.col(column).cast("timestamp_ntz").alias(column)


def _loads(*runs: tuple[str, str, int]) -> Column:
    """Several loads of every row: run id, day and a number that changes the payload."""
    return F.explode(
        F.array(
            *[
                F.struct(
                    F.lit(run).alias("run"), F.lit(day).alias("day"), F.lit(step).alias("step")
                )
                for run, day, step in runs
            ]
        )
    ).alias("load")


def _stamp(entity: str) -> list[Column]:
    return [
        F.concat(F.col("load.day"), F.lit("T06:00:00+00:00")).alias("_loaded_at"),
        F.lit(SOURCE).alias("_source"),
        F.lit(entity).alias("_entity"),
        F.col("load.day").alias("_load_date"),
        F.col("load.run").alias("_run_id"),
    ]


def _once(record: Column) -> Column:
    """Pass a record through a generator, as a file scan would, so that it is built once."""
    return F.explode(F.array(record)).alias(RECORD)


def _bronze(rows: DataFrame, entity: str, record: Column) -> DataFrame:
    """Each row as a semi-structured record, bound like a landed one."""
    records = rows.select(
        F.concat(F.lit(f"raw/{entity}/"), F.col("load.day")).alias("_file"),
        F.col("load.step").cast("bigint").alias("_row_tag"),
        _once(F.to_variant_object(record)),
    )
    return split_rejects(bind_entity(records, ENTITY_SPECS[entity]))[0]


def product_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """``part`` loaded twice; the second load raises every price by 10."""
    rows = _dealt(table(spark, sf, "part"), "p_partkey").select(
        "*", _loads(("run-1", "2024-01-01", 0), ("run-2", "2024-01-02", 1))
    )
    record = F.struct(
        F.col("p_partkey").alias("id"),
        F.col("p_name").alias("title"),
        (F.col("p_retailprice") + F.col("load.step") * 10).alias("price"),
        F.col("p_brand").alias("description"),
        F.col("p_type").alias("category"),
        F.concat(F.lit("img/"), F.col("p_partkey"), F.lit(".jpg")).alias("image"),
        F.struct(
            (F.col("p_size") / 10).alias("rate"), F.col("p_size").alias("count")
        ).alias("rating"),
        *_stamp("products"),
    )
    return _bronze(rows, "products", record)


def user_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """``customer`` with the name of its nation, loaded twice; the second load changes phones."""
    nation = table(spark, sf, "nation").select("n_nationkey", "n_name")
    rows = (
        _dealt(table(spark, sf, "customer"), "c_custkey")
        .join(nation, F.col("c_nationkey") == F.col("n_nationkey"), "left")
        .select("*", _loads(("run-1", "2024-01-01", 0), ("run-2", "2024-01-02", 1)))
    )
    name = F.split("c_name", "#")
    record = F.struct(
        F.col("c_custkey").alias("id"),
        F.concat(F.col("c_name"), F.lit("@mail.test")).alias("email"),
        F.col("c_name").alias("username"),
        F.lit("secret").alias("password"),
        F.struct(name[0].alias("firstname"), name[1].alias("lastname")).alias("name"),
        F.struct(
            F.col("n_name").alias("city"),
            F.concat(F.col("c_mktsegment"), F.lit(" street")).alias("street"),
            (F.col("c_custkey") % 100).alias("number"),
            F.lpad((F.col("c_custkey") % 10000).cast("string"), 4, "0").alias("zipcode"),
            F.struct(
                F.col("c_acctbal").cast("string").alias("lat"),
                (-F.col("c_acctbal")).cast("string").alias("long"),
            ).alias("geolocation"),
        ).alias("address"),
        F.concat(F.lit("555-"), F.col("c_custkey"), F.lit("-"), F.col("load.step")).alias("phone"),
        *_stamp("users"),
    )
    return _bronze(rows, "users", record)


def cart_bronze(spark: SparkSession, sf: str) -> DataFrame:
    """Each order as a cart document, loaded in two runs, the second one twice.

    A cart holds ``o_orderkey % 4`` items made from the order itself (none, or no array at all
    for some), so a document has a fixed upper size and no rows are gathered to build it.
    """
    # What the loads of an order share is made before they are told apart, so once.
    orders = _spread(table(spark, sf, "orders"), "o_orderkey", "o_custkey").select(
        "o_orderkey",
        "o_custkey",
        F.date_format("o_orderdate", "yyyy-MM-dd'T'HH:mm:ss.SSS'Z'").alias("date"),
        cart_items().alias("products"),
    )
    rows = orders.select(
        "*",
        _loads(
            ("run-1", "2024-01-01", 0), ("run-2", "2024-01-02", 1), ("run-2", "2024-01-03", 2)
        ),
    )
    record = F.struct(
        F.col("o_orderkey").alias("id"),
        F.col("o_custkey").alias("userId"),
        "date",
        "products",
        *_stamp("carts"),
    )
    return _bronze(rows, "carts", record)


def cart_items() -> Column:
    """Item array of an order: empty for keys divisible by 4, NULL for every 11th key."""
    slots = F.array(*[F.lit(i) for i in range(3)])
    items = F.transform(
        F.slice(slots, F.lit(1), (F.col("o_orderkey") % 4).cast("int")),
        lambda i: F.struct(
            (F.col("o_custkey") + i).alias("productId"),
            ((F.col("o_orderkey") + i) % 5 + 1).cast("int").alias("quantity"),
        ),
    )
    return F.when(F.col("o_orderkey") % 11 != 10, items)


EVENT_FIELDS = (
    Field("id", "number"),
    Field("v", "double"),
    Field("kind", "string"),
    Field("at", "timestamp"),
    Field("day", "date"),
    Field("props", "variant"),
)


def event_records(spark: SparkSession, sf: str) -> DataFrame:
    """``events`` as JSON text bound to bronze; every seventh value is not a number."""
    events = table(spark, sf, "events")
    value = F.when(F.col("event_id") % 7 == 0, F.lit("x")).otherwise(F.col("value").cast("string"))
    record = F.struct(
        F.col("event_id").alias("id"),
        value.alias("v"),
        F.col("event_type").alias("kind"),
        F.date_format("ts", "yyyy-MM-dd'T'HH:mm:ss.SSSSSS'Z'").alias("at"),
        F.date_format("ts", "yyyy-MM-dd").alias("day"),
        F.struct(F.col("user_id").alias("user")).alias("props"),
    )
    landed = events.select(
        "event_id",
        F.concat(F.lit("raw/events/"), F.col("event_type"), F.lit(".json")).alias("_file"),
        _once(F.parse_json(F.to_json(record))),
    )
    return bind_fields(landed, EVENT_FIELDS, keep=("event_id", "_file"))


def _two_versions(df: DataFrame, key: str) -> DataFrame:
    """Version 1 ends and version 2 starts on a day that depends on the key."""
    switch = F.date_add(F.lit(SECOND_VERSION).cast("date"), (F.col(key) % 4 * 100).cast("int"))
    switch = switch.cast("timestamp_ntz")
    open_end = F.lit(None).cast("timestamp_ntz")
    versions = F.array(
        F.struct(
            F.lit(1).alias("version"), ntz(FIRST_VERSION).alias("valid_from"),
            switch.alias("valid_to"),
        ),
        F.struct(
            F.lit(2).alias("version"), switch.alias("valid_from"), open_end.alias("valid_to")
        ),
    )
    return df.select("*", F.inline(versions))


def product_history(spark: SparkSession, sf: str) -> DataFrame:
    """Two versions of each ``part``; the second costs ten percent more."""
    parts = _two_versions(table(spark, sf, "part"), "p_partkey")
    price = F.when(F.col("version") == 1, F.col("p_retailprice")).otherwise(
        F.col("p_retailprice") * F.lit(1.1)
    )
    return parts.select(
        F.col("p_partkey").alias("product_id"),
        F.col("p_name").alias("product_name"),
        F.col("p_type").alias("category"),
        price.alias("price"),
        F.col("p_brand").alias("description"),
        F.concat(F.lit("img/"), F.col("p_partkey"), F.lit(".jpg")).alias("image_url"),
        (F.col("p_size") / 10).alias("rating_score"),
        F.col("p_size").alias("rating_count"),
        "valid_from",
        "valid_to",
        F.col("valid_from").alias("loaded_at"),
        F.to_date("valid_from").alias("load_date"),
    )


def customer_history(spark: SparkSession, sf: str) -> DataFrame:
    """Two versions of each ``customer``; every fifth one has no first name."""
    customers = _two_versions(table(spark, sf, "customer"), "c_custkey")
    name = F.split("c_name", "#")
    first = F.when(F.col("c_custkey") % 5 != 0, name[0])
    return customers.select(
        F.col("c_custkey").alias("user_id"),
        first.alias("first_name"),
        name[1].alias("last_name"),
        F.concat("c_name", F.lit("@v"), "version").alias("email"),
        F.col("c_name").alias("username"),
        F.col("c_nationkey").cast("string").alias("city"),
        F.col("c_mktsegment").alias("street"),
        F.lit("0000").alias("zipcode"),
        F.lit(None).cast("string").alias("phone"),
        "valid_from",
        "valid_to",
        F.col("valid_from").alias("loaded_at"),
        F.to_date("valid_from").alias("load_date"),
    )


def order_items(spark: SparkSession, sf: str) -> DataFrame:
    """``lineitem`` joined to its order, in the shape of the seed order items."""
    items = table(spark, sf, "lineitem").select(
        "l_orderkey", "l_partkey", "l_linenumber", "l_quantity", "l_extendedprice"
    )
    orders = table(spark, sf, "orders").select("o_orderkey", "o_custkey", "o_orderdate")
    # An order is one row, so a task hashes a few orders and sorts no items.
    return items.join(orders.hint("shuffle_hash"), F.col("l_orderkey") == F.col("o_orderkey")).select(
        (F.col("l_orderkey") * 10 + F.col("l_linenumber")).alias("order_item_id"),
        F.col("l_orderkey").alias("order_id"),
        F.col("o_custkey").alias("user_id"),
        F.col("l_partkey").alias("product_id"),
        F.col("l_quantity").cast("int").alias("quantity"),
        F.col("l_extendedprice").alias("unit_price"),
        (F.col("l_quantity") * F.col("l_extendedprice")).alias("total_price"),
        F.col("o_orderdate").alias("order_date"),
    )


def landed_paths(spark: SparkSession, sf: str) -> DataFrame:
    """The landing folder of each order's day."""
    folder = F.date_format("o_orderdate", "'raw/orders/year='yyyy'/month='MM'/day='dd")
    return table(spark, sf, "orders").select("o_orderkey", "o_orderdate", folder.alias("path"))


CUSTOMER_CHECKS = ("status", "large")


def landed_orders(spark: SparkSession, sf: str) -> list[str]:
    """Orders landed as JSON arrays, one a file and the text of some across lines, in the shared scratch folder."""
    folder = f"{ensure_checkpoint_dir(spark).rstrip('/')}/landed-{uuid.uuid4().hex}"
    orders = table(spark, sf, "orders").withColumn("file", F.pmod("o_custkey", F.lit(8)))
    members = F.struct("o_orderkey", "o_custkey", "o_orderstatus", "o_totalprice", F.concat(F.lit('}"],\n{ "'), "o_orderstatus").alias("note"))
    line = Window.partitionBy("file").orderBy("o_orderkey")
    lead = F.when(F.row_number().over(line) == 1, "[").otherwise(",")
    last = F.when(F.lead("o_orderkey").over(line).isNull(), "\n]").otherwise("")
    # Every third record goes over several lines.
    record = F.to_json(members)
    record = F.when(F.col("o_orderkey") % 3 == 0, F.replace(record, F.lit(',"o_'), F.lit(',\n  "o_'))).otherwise(record)
    orders.select("file", F.concat(lead, record, last).alias("value")).write.partitionBy("file").text(folder)
    return [row[0] for row in listed_files(spark.read, folder).collect()]


def order_log(spark: SparkSession, sf: str, run_time: Column) -> DataFrame:
    """``orders`` as customer state, with the time of the run that first sees each order."""
    return table(spark, sf, "orders").select(
        F.col("o_custkey").alias("customer_id"),
        F.expr("nullif(o_orderstatus, 'P')").alias("status"),
        (F.col("o_totalprice") > 250000).alias("large"),
        F.col("o_orderkey").alias("last_order"),
        F.col("o_orderdate").alias("ordered"),
        run_time.alias("run_at"),
    )


def newest_order() -> list[Column]:
    return [F.col("ordered").desc_nulls_last(), F.col("last_order").desc()]


def customer_log(log: DataFrame) -> DataFrame:
    """Customer state per run: the newest order of each customer within the run's span.

    Customers without an order in a span are missing from that run. Every order belongs to
    exactly one span.
    """
    return latest_per_key(log, ["customer_id", "run_at"], newest_order()).drop("ordered")


def customer_batch(log: DataFrame, end: str) -> DataFrame:
    """One run of the log. Filtered before the dedup, so the rows leave it hashed by customer."""
    span = log.filter(F.col("run_at") == ntz(end)).drop("run_at")
    return latest_per_key(span, ["customer_id"], newest_order()).drop("ordered")


def span_end(*ends: str) -> Column:
    """Run time of an order: the first listed span end after its date, else the last one."""
    day = F.col("o_orderdate")
    chosen = ntz(ends[-1])
    for end in reversed(ends[:-1]):
        chosen = F.when(day < ntz(end), ntz(end)).otherwise(chosen)
    return chosen


def year_end() -> Column:
    return F.make_date(F.year("o_orderdate") + 1, F.lit(1), F.lit(1)).cast("timestamp_ntz")
