"""Every operator as a query over the given tables: name -> (spark, folder) -> DataFrame."""

from __future__ import annotations

from collections.abc import Callable
from datetime import datetime, timezone
from functools import wraps

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import date_key, partition_values
from ..functions.keys import surrogate_key
from ..functions.lookups import MONTH_WEIGHTS, lookup_constant
from ..functions.text import strip_prefix
from ..functions.variants import vget
from ..operators import aggregates as agg
from ..operators import quality as dq
from ..operators import sampling
from ..operators.asof import asof_left, asof_left_bucketed, find_hot_keys
from ..operators.bronze import split_rejects
from ..operators.dedup import latest_per_key, merge_latest
from ..operators.explode import explode_items
from ..operators.scd2 import as_of, current, scd2_fold, scd2_from_history
from ..operators.stamp import enrich
from ..schemas import HISTORY_SPECS
from ..sources.json_scan import scan_files
from ..sources.ledger import unseen_files
from . import driver_tables as given
from . import marts, staging
from .chain import history_of_runs, star_of_histories

# What the runs of the chain had loaded, and when they took their snapshots; the second finds nothing new.
CHAIN_RUNS = (
    ("2024-01-01 06:00:00", "1996-01-01"),
    ("2024-01-01 18:00:00", "1997-01-01"),
    ("2024-01-02 06:00:00", "1998-01-01"),
)

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}

# Run times of the customer state log; spans cover all order dates.
HALVES = ("1998-05-01", "2002-01-01")
THIRDS = ("1997-03-15", "1999-05-20", "2002-01-01")


def query(build: Query) -> Query:
    @wraps(build)
    def in_utc(spark: SparkSession, sf: str) -> DataFrame:
        spark.conf.set("spark.sql.session.timeZone", "UTC")
        return build(spark, sf)

    QUERIES[build.__name__] = in_utc
    return in_utc


# --- projections and bronze ------------------------------------------------------------


@query
def enrich_customer(spark, sf):
    now = datetime(2024, 3, 1, 6, 30, 15, tzinfo=timezone.utc)
    stamped = enrich(given.table(spark, sf, "customer"), "users", given.SOURCE, "run-7", now)
    return stamped.withColumn("_loaded_at", given.as_ntz("_loaded_at"))


@query
def bronze_events(spark, sf):
    good, _ = split_rejects(given.event_records(spark, sf))
    return good.select(
        "id", "v", "kind", given.as_ntz("at"), "day", vget("props", "$.user", "bigint").alias("user")
    )


@query
def bronze_rejects(spark, sf):
    _, bad = split_rejects(given.event_records(spark, sf))
    return bad.select("event_id", "_file")


@query
def load_summary(spark, sf):
    return agg.load_summary(given.event_records(spark, sf))


@query
def path_extract_cast(spark, sf):
    events = given.table(spark, sf, "events").select(
        "event_id", F.parse_json("props").alias("props")
    )
    return events.select("event_id", vget("props", "$.k", "bigint").alias("k"))


@query
def partition_columns(spark, sf):
    parts = partition_values("o_orderdate")
    return given.table(spark, sf, "orders").select(
        "o_orderkey", *[column.alias(name) for name, column in parts.items()]
    )


@query
def path_suffix(spark, sf):
    suffix = strip_prefix("path", "raw/orders/")
    return given.landed_paths(spark, sf).select("o_orderkey", suffix.alias("suffix"))


@query
def new_files_anti(spark, sf):
    listed = given.landed_paths(spark, sf)
    ledger = listed.filter(F.col("o_orderdate") < given.ntz("2000-01-01"))
    return unseen_files(listed, ledger)


@query
def json_array_scan(spark, sf):
    """Orders landed as JSON arrays and read back, cut into elements over all blocks of the files."""
    records = scan_files(spark, given.landed_orders(spark, sf), "array")
    kinds = {"o_orderkey": "bigint", "o_custkey": "bigint", "o_orderstatus": "string", "o_totalprice": "double", "note": "string"}
    return records.select(*[vget("_record", f"$.{name}", kind).alias(name) for name, kind in kinds.items()])


@query
def line_totals_rounded(spark, sf):
    quantity = F.col("l_quantity").cast("decimal(18,2)")
    price = F.col("l_extendedprice").cast("decimal(18,2)")
    total = F.round(quantity * price, 2).cast("decimal(18,2)")
    return given.table(spark, sf, "lineitem").select(
        "l_orderkey", "l_linenumber", "l_partkey", total.alias("line_total")
    )


# --- staging ---------------------------------------------------------------------------


def _newest_event():
    return [F.col("ts").desc_nulls_first(), F.col("event_id").desc_nulls_last()]


@query
def dedup_latest(spark, sf):
    return latest_per_key(given.table(spark, sf, "events"), ["user_id"], _newest_event())


@query
def dedup_per_run(spark, sf):
    return latest_per_key(
        given.table(spark, sf, "events"), ["user_id", "event_type"], _newest_event()
    )


@query
def dedup_incremental(spark, sf):
    """The newest row per user, reached by folding late events into the earlier result."""
    events = given.table(spark, sf, "events")
    late = F.coalesce(F.col("ts") >= given.ntz("2024-01-15"), F.lit(False))  # no time: not late
    before = latest_per_key(events.filter(~late), ["user_id"], _newest_event())
    return merge_latest(before, events.filter(late), ["user_id"], _newest_event())


@query
def stg_products(spark, sf):
    staged = staging.stg_products(given.product_bronze(spark, sf))
    return staged.withColumn("loaded_at", given.as_ntz("loaded_at"))


@query
def stg_users(spark, sf):
    staged = staging.stg_users(given.user_bronze(spark, sf))
    return staged.withColumn("loaded_at", given.as_ntz("loaded_at"))


@query
def cart_items_explode(spark, sf):
    orders = given.table(spark, sf, "orders").select("o_orderkey", "o_custkey")
    carts = orders.select(
        "o_orderkey", F.parse_json(F.to_json(given.cart_items())).alias("products")
    )
    return explode_items(carts, "products").select(
        "o_orderkey",
        vget("item", "$.productId", "bigint").alias("product_id"),
        vget("item", "$.quantity", "int").alias("quantity"),
    )


@query
def stg_carts(spark, sf):
    staged = staging.stg_carts(given.cart_bronze(spark, sf))
    return staged.withColumns(
        {"cart_date": given.as_ntz("cart_date"), "loaded_at": given.as_ntz("loaded_at")}
    )


# --- history ---------------------------------------------------------------------------


def _customer_fold(spark, sf, ends, hard_deletes):
    log = given.order_log(spark, sf, given.span_end(*ends))
    runs = [(given.ntz(end), given.customer_batch(log, end)) for end in ends]
    return scd2_fold(runs, "customer_id", given.CUSTOMER_CHECKS, hard_deletes)


def _customer_history(spark, sf, hard_deletes):
    log = given.order_log(spark, sf, given.year_end())
    return scd2_from_history(
        given.customer_log(log),
        "customer_id",
        "run_at",
        given.CUSTOMER_CHECKS,
        hard_deletes,
        batches=log.select("run_at"),
    )


@query
def scd2_initial(spark, sf):
    return _customer_fold(spark, sf, ("2002-01-01",), True)


@query
def scd2_two_batches(spark, sf):
    return _customer_fold(spark, sf, HALVES, False)


@query
def scd2_hard_deletes(spark, sf):
    return _customer_fold(spark, sf, HALVES, True)


@query
def scd2_reappear(spark, sf):
    return _customer_fold(spark, sf, THIRDS, True)


@query
def scd2_history(spark, sf):
    return _customer_history(spark, sf, True)


@query
def scd2_history_keep(spark, sf):
    """The same log when vanished keys stay open."""
    return _customer_history(spark, sf, False)


# --- dimensions ------------------------------------------------------------------------


def _products(spark, sf):
    return _growing(marts.dim_product(given.product_history(spark, sf)))


def _customers(spark, sf):
    return _growing(marts.dim_customer(given.customer_history(spark, sf)))


def _growing(dim):
    """A dimension that grows with the tables: shuffled and hashed in joins, not sent to the driver.

    Its size is estimated from compressed files, which hold neither the second version nor the keys of its rows.
    """
    return dim.hint("shuffle_hash")


def _sorting(dim):
    """A dimension that grows with the tables and is joined by sorting: lines leave the join with those of a key together.

    What is shuffled or written next compresses better, as keys of one member or version stand side by side.
    """
    return dim.hint("merge")


def _dates(spark):
    return marts.dim_date(spark, given.SPINE_START, given.SPINE_DAYS)


@query
def dim_product(spark, sf):
    return _products(spark, sf)


@query
def dim_customer(spark, sf):
    return _customers(spark, sf)


@query
def dim_current(spark, sf):
    return current(_products(spark, sf))


@query
def dim_as_of(spark, sf):
    return as_of(_products(spark, sf), given.ntz("1998-06-01"))


@query
def dim_date(spark, sf):
    """Calendar attributes of each order's day; NULL past the end of the spine."""
    orders = given.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    calendar = _dates(spark)
    return orders.join(calendar, date_key("o_orderdate") == F.col("date_key"), "left").select(
        "o_orderkey", *calendar.columns
    )


@query
def surrogate_keys(spark, sf):
    orders = given.table(spark, sf, "orders").select(
        "o_orderkey", "o_orderdate", F.expr("nullif(o_orderstatus, 'P')").alias("status")
    )
    key = surrogate_key(orders, ["o_orderkey", "status", "o_orderdate"])
    return orders.select("o_orderkey", key.alias("order_sk"))


# --- joins -----------------------------------------------------------------------------

_PRODUCT_TAKE = {"product_key": "product_key", "price_then": "price", "version_from": "effective_from"}


def _dated_items(spark, sf):
    return given.order_items(spark, sf).select(
        "order_item_id", "order_id", "user_id", "product_id", "quantity", "order_date"
    )


@query
def asof_product(spark, sf):
    return asof_left(
        _dated_items(spark, sf), _products(spark, sf), "product_id", "order_date", _PRODUCT_TAKE
    )


@query
def asof_customer(spark, sf):
    return asof_left(
        _dated_items(spark, sf), _customers(spark, sf), "user_id", "order_date",
        {"customer_key": "customer_key", "email": "email"},
    )


@query
def asof_product_hot(spark, sf):
    """The product join with the busiest products dealt out over several tasks."""
    items = _dated_items(spark, sf)
    hot = find_hot_keys(given.table(spark, sf, "lineitem"), "l_partkey", times=1.5)
    return asof_left(
        items, _products(spark, sf), "product_id", "order_date", _PRODUCT_TAKE, hot_keys=hot
    )


@query
def asof_product_bucketed(spark, sf):
    return asof_left_bucketed(
        _dated_items(spark, sf), _products(spark, sf), "product_id", "order_date", _PRODUCT_TAKE
    )


@query
def price_at_order(spark, sf):
    items = _dated_items(spark, sf)
    priced = asof_left(
        items, _products(spark, sf), "product_id", "order_date", {"unit_price": "price"}
    )
    keyed = priced.withColumn("order_item_key", surrogate_key(priced, ["order_item_id"]))
    return agg.price_at_order(keyed)


@query
def date_key_join(spark, sf):
    orders = given.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return marts.date_key_join(orders, _dates(spark), "o_orderdate")


@query
def fact_order_items(spark, sf):
    """The star fact over staged carts and seed items, both from whole tables."""
    carts = staging.stg_carts(given.cart_bronze(spark, sf))
    return marts.build_fact(
        carts,
        given.order_items(spark, sf),
        _sorting(marts.dim_product(given.product_history(spark, sf))),
        _sorting(marts.dim_customer(given.customer_history(spark, sf))),
        _dates(spark),
    )


# --- the chain: bronze, staging, snapshots, dimensions, fact -----------------------------


def _chain_runs():
    return [(F.lit(until).cast("timestamp"), given.ntz(now)) for until, now in CHAIN_RUNS]


def _product_runs(spark, sf):
    bronze = given.product_bronze(spark, sf)
    return history_of_runs(bronze, staging.stg_products, HISTORY_SPECS["products"], _chain_runs())


def _customer_runs(spark, sf):
    bronze = given.user_bronze(spark, sf)
    return history_of_runs(bronze, staging.stg_users, HISTORY_SPECS["customers"], _chain_runs())


@query
def chain_products(spark, sf):
    dim = marts.dim_product(_product_runs(spark, sf))
    return dim.withColumn("loaded_at", given.as_ntz("loaded_at"))


@query
def chain_customers(spark, sf):
    dim = marts.dim_customer(_customer_runs(spark, sf))
    return dim.withColumn("loaded_at", given.as_ntz("loaded_at"))


@query
def chain_fact(spark, sf):
    """The fact over what three runs left: every step from the loads on."""
    return star_of_histories(
        staging.stg_carts(given.cart_bronze(spark, sf)),
        given.order_items(spark, sf),
        _product_runs(spark, sf),
        _customer_runs(spark, sf),
        _dates(spark),
    )


# --- aggregates ------------------------------------------------------------------------


@query
def entity_counts(spark, sf):
    roles = {"products": "part", "users": "customer", "carts": "orders"}
    return agg.batch_counts({e: given.table(spark, sf, t) for e, t in roles.items()})


@query
def seed_summary(spark, sf):
    orders = given.table(spark, sf, "orders")
    return agg.order_summary(orders, "o_totalprice", "o_custkey", "o_orderdate", "o_orderkey")


@query
def units_by_category_month(spark, sf):
    items = asof_left(
        _dated_items(spark, sf), _products(spark, sf), "product_id", "order_date",
        {"product_key": "product_key", "category": "category"},
    )
    return agg.units_by_category_month(items)


@query
def first_n_items(spark, sf):
    return agg.first_n(given.table(spark, sf, "orders"), 100, "o_orderkey")


@query
def month_weight_lookup(spark, sf):
    weight = lookup_constant(F.month("o_orderdate"), MONTH_WEIGHTS, default=1.0)
    return given.table(spark, sf, "orders").select("o_orderkey", weight.alias("weight"))


@query
def month_weighted_sample(spark, sf):
    orders = given.table(spark, sf, "orders").select("o_orderkey", "o_orderdate")
    return sampling.month_weighted_sample(orders, "o_orderkey", "o_orderdate")


# --- checks ----------------------------------------------------------------------------


@query
def dq_not_null(spark, sf):
    return dq.check_not_null(
        asof_product(spark, sf), ["order_id", "product_id", "product_key", "price_then"], "items."
    )


@query
def dq_unique(spark, sf):
    items = given.table(spark, sf, "lineitem")
    orders = given.table(spark, sf, "orders")
    return dq.check_unique(items, ["l_orderkey", "l_linenumber"], "lineitem unique").unionAll(
        dq.check_unique(orders, ["o_orderkey"], "orders unique")
    )


@query
def dq_foreign_key(spark, sf):
    items = given.table(spark, sf, "lineitem")
    orders = given.table(spark, sf, "orders")
    return dq.check_fk(items, "l_orderkey", orders, "o_orderkey", "lineitem has order").unionAll(
        dq.check_fk(orders, "o_orderkey", items, "l_orderkey", "order has lineitem")
    )


@query
def dq_accepted_values(spark, sf):
    orders = given.table(spark, sf, "orders")
    return dq.check_accepted(orders, "o_orderstatus", ["F", "O"], "orderstatus accepted")


@query
def dq_no_overlap(spark, sf):
    """Every fifth part keeps its first version open ten days too long."""
    late = F.when(F.col("product_id") % 5 == 0, F.lit(10)).otherwise(F.lit(0))
    end = F.col("effective_to") + F.make_dt_interval(days=late)
    broken = _products(spark, sf).withColumn("effective_to", end)
    return dq.check_no_overlap(_products(spark, sf), "product_id", "products no overlap").unionAll(
        dq.check_no_overlap(broken, "product_id", "late products no overlap")
    )


@query
def dq_fields(spark, sf):
    """Members missing from the event records; ``z`` never occurs."""
    events = given.table(spark, sf, "events").select(F.parse_json("props").alias("record"))
    return dq.check_fields(events, "record", ["k", "z"], "events.")
