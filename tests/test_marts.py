from datetime import date, datetime

import pytest
from pyspark.sql import functions as F

from cartloom.functions.keys import surrogate_key
from cartloom.operators.aggregates import (
    batch_counts,
    first_n,
    load_summary,
    order_summary,
    price_at_order,
    units_by_category_month,
)
from cartloom.operators.unions import union_sources
from cartloom.plans.marts import FACT_COLUMNS, _late_keyed, build_fact, dim_customer, dim_date, dim_product
from cartloom.schemas import SEED_ORDER_ITEMS
from cartloom.sources.seed_csv import read_seed, write_seed

from .conftest import plan, rows

V1, V2 = "2024-02-01T00:00:00Z", "2024-06-01T00:00:00Z"


def ts(text):
    return None if text is None else datetime.fromisoformat(text)


@pytest.fixture(scope="module")
def star(spark):
    product = spark.createDataFrame(
        [
            (1, "bag", "bags", 10.0, ts(V1), ts(V2)),
            (1, "bag", "bags", 12.0, ts(V2), None),
            (2, "ring", "jewels", 5.5, ts(V1), None),
        ],
        "product_id long, product_name string, category string, price double, "
        "valid_from timestamp, valid_to timestamp",
    ).selectExpr(
        "*", "'d' AS description", "'i' AS image_url", "4.0D AS rating_score",
        "3 AS rating_count", "valid_from AS loaded_at", "to_date(valid_from) AS load_date",
    )
    customer = spark.createDataFrame(
        [(7, "Ann", "Lee", ts(V1), None), (8, None, "Ray", ts(V1), None)],
        "user_id long, first_name string, last_name string, valid_from timestamp, valid_to timestamp",
    ).selectExpr(
        "*", "'e' AS email", "'u' AS username", "'c' AS city", "'s' AS street", "'z' AS zipcode",
        "'p' AS phone", "valid_from AS loaded_at", "to_date(valid_from) AS load_date",
    )
    return dim_product(product), dim_customer(customer), dim_date(spark)


def carts(spark, *data):
    schema = (
        "cart_id long, user_id long, cart_date timestamp, product_id long, quantity int, "
        "loaded_at timestamp"
    )
    return spark.createDataFrame([(*d[:2], ts(d[2]), *d[3:], ts(V2)) for d in data], schema)


def seed(spark, *data):
    return spark.createDataFrame(list(data), SEED_ORDER_ITEMS)


def by_order(fact):
    return {r.order_id: r for r in fact.collect()}


def test_dimensions(spark, star):
    products, customers, _ = star
    assert products.columns == [
        "product_key", "product_id", "product_name", "category", "price", "description", "image_url",
        "rating_score", "rating_count", "effective_from", "effective_to", "loaded_at", "load_date",
    ]
    assert rows(customers, "user_id", "full_name") == [(7, "Ann Lee"), (8, None)]
    assert products.select("product_key").distinct().count() == 3


def test_fact_prices_as_of_the_order(spark, star):
    fact = build_fact(
        carts(
            spark,
            (100, 7, "2024-03-01T00:00:00Z", 1, 2),
            (101, 7, V2, 1, 2),
            (102, 7, "2020-03-02T00:00:00Z", 1, 2),  # before the first version
            (103, 99, "2024-03-01T00:00:00Z", 99, 1),
        ),
        seed(
            spark,
            (1, 200, 8, 2, 3, 9.99, 29.97, date(2024, 3, 2)),
            (2, 201, 8, 1, 1, 1.0, 1.0, date(2026, 1, 15)),  # after the calendar
        ),
        *star,
    )
    assert tuple(fact.columns) == FACT_COLUMNS
    got = by_order(fact)
    assert len(got) == fact.count() == 6
    assert (got[100].unit_price, got[100].total_price, got[100].date_key) == (10.0, 20.0, 20240301)
    assert got[101].unit_price == 12.0
    early = got[102]
    assert (early.product_key, early.unit_price, early.total_price, early.date_key) == (None,) * 4
    assert (got[103].product_key, got[103].customer_key) == (None, None)
    own = got[200]
    assert (own.unit_price, own.total_price, own.loaded_at, own.run_id) == (9.99, 29.97, None, None)
    assert own.product_key is not None and own.customer_key is not None
    assert got[201].date_key is None and got[201].product_key is not None
    assert all(r.loaded_at is not None for o, r in got.items() if o < 200)


def test_item_keys(spark, star):
    """Cart items are keyed by order and product, seed items by their own id."""
    cart = carts(spark, (100, 7, V2, 1, 2), (100, 7, V2, 1, 5))
    fact = build_fact(cart, seed(spark, (41, 200, 8, 2, 3, 9.99, 29.97, date(2024, 3, 2))), *star)
    keys = {r.order_id: r.order_item_key for r in fact.collect()}
    parts = spark.createDataFrame([(100, 1, 41)], "a long, b long, c long")
    expected = parts.select(surrogate_key(parts, ["a", "b"]), surrogate_key(parts, ["c"])).first()
    assert (keys[100], keys[200]) == tuple(expected)
    # The same cart and product again shares its key, as the item key leaves out the run.
    assert fact.filter("order_id = 100").select("order_item_key").distinct().count() == 1
    assert fact.filter("order_id = 100").count() == 2


def test_filtering_on_load_time_prunes_the_seed(spark, star, tmp_path):
    path = str(tmp_path / "seed")
    write_seed(seed(spark, (1, 200, 8, 2, 3, 9.99, 29.97, date(2024, 3, 2))), path)
    fact = build_fact(carts(spark, (100, 7, V2, 1, 2)), read_seed(spark, path), *star)
    assert "FileScan csv" in plan(fact)
    assert "FileScan csv" not in plan(fact.filter("loaded_at IS NOT NULL"))
    assert fact.filter("loaded_at IS NOT NULL").count() == 1


def test_hot_keys_do_not_change_the_fact(spark, star):
    args = (
        carts(spark, *[(n, 7, "2024-03-01T00:00:00Z", 1, n % 5) for n in range(40)]),
        seed(spark, (1, 200, 8, 2, 3, 9.99, 29.97, date(2024, 3, 2))),
        *star,
    )
    plain = build_fact(*args)
    split = build_fact(*args, hot_products=[1], hot_customers=[7])
    assert rows(split) == rows(plain)


def test_seed_csv_round_trip(spark, tmp_path):
    data = [(1, 200, 8, 2, 3, 9.99, 29.97, date(2024, 3, 2)), (2, 200, 8, 1, 1, 10.0, 10.0, date(2024, 3, 2))]
    path = str(tmp_path / "seed")
    write_seed(seed(spark, *data), path)
    back = read_seed(spark, path)
    assert back.schema == SEED_ORDER_ITEMS
    assert rows(back) == data
    part = next(p for p in (tmp_path / "seed").iterdir() if p.name.endswith(".csv"))
    assert part.read_text().splitlines()[0] == ",".join(SEED_ORDER_ITEMS.fieldNames())


def test_union_sources(spark):
    day = spark.createDataFrame([(1, date(2024, 1, 1))], "a int, d date")
    instant = spark.sql("SELECT TIMESTAMP_NTZ '2024-01-01' AS d, 1 AS a")
    both = union_sources(day, instant)
    assert dict(both.dtypes)["d"] == "timestamp_ntz"
    assert both.count() == 2 and both.distinct().count() == 1
    with pytest.raises(ValueError, match="differ"):
        union_sources(day, instant.drop("a"))


def test_summaries(spark):
    a, empty = spark.range(3), spark.range(0)
    assert rows(batch_counts({"a": a, "b": a})) == [("a", 3), ("b", 3), ("total", 6)]
    assert rows(batch_counts({"a": a, "b": empty})) == [("a", 3), ("b", 0), ("total", 3)]
    bound = spark.createDataFrame([("f", True), ("f", False), ("g", False)], "_file string, _rejected boolean")
    assert rows(load_summary(bound)) == [("f", 2, 1, 1), ("g", 1, 1, 0)]
    orders = spark.createDataFrame(
        [(1, 10, 0.1, date(2024, 5, 1)), (2, 10, 0.2, date(2024, 1, 1)), (3, 11, 0.3, date(2024, 3, 1))],
        "item int, o int, amount double, d date",
    )
    got = order_summary(orders, "amount", "o", "d", "item").first()
    assert (str(got[0]), got[1], got[2], got[3]) == ("0.60", 2, date(2024, 5, 1), date(2024, 3, 1))


def test_business_questions(spark, star):
    products, customers, dates = star
    fact = build_fact(
        carts(
            spark,
            (100, 7, "2024-03-01T00:00:00Z", 1, 2), (101, 7, "2024-03-09T00:00:00Z", 1, 3),
            (102, 7, V2, 1, 4), (103, 7, V2, 2, 1), (104, 7, "2020-01-01T00:00:00Z", 1, 9),
        ),
        seed(spark),
        products, customers, dates,
    )
    units = units_by_category_month(fact, products)
    assert [(c, m, int(u)) for c, m, u in rows(units)] == [
        ("bags", "2024-03", 5), ("bags", "2024-06", 4), ("jewels", "2024-06", 1),
    ]
    prices = {r.order_id: r.unit_price for r in price_at_order(fact).collect()}
    assert prices == {100: 10.0, 101: 10.0, 102: 12.0, 103: 5.5, 104: None}


def test_first_n_is_a_top_n(spark):
    top = first_n(spark.range(100).select((99 - F.col("id")).alias("k")), 3, "k")
    assert [r.k for r in top.collect()] == [0, 1, 2]
    assert "TakeOrderedAndProject" in plan(top)


def test_keys_that_are_no_hash_are_kept(spark, star):
    """Dimensions may bring keys of their own, or none, or numbers of another type than the lines."""
    products, customers, dates = star
    lines = carts(spark, (100, 7, "2024-03-01T00:00:00Z", 1, 2), (101, 8, "2024-03-01T00:00:00Z", 1, 2))
    assert _late_keyed(customers, lines, "customer_key", "user_id").filter("__given_key IS NOT NULL").isEmpty()
    own = customers.withColumn("customer_key", F.expr("if(user_id = 7, 'C7', NULL)"))
    got = by_order(build_fact(lines, seed(spark), products, own, dates))
    assert (got[100].customer_key, got[101].customer_key) == ("C7", None)
    texts = customers.withColumn("user_id", F.concat(F.lit("0"), "user_id"))
    got = by_order(build_fact(lines, seed(spark), products, texts, dates))
    expected = dict(rows(texts, F.col("user_id").cast("int"), "customer_key"))
    assert (got[100].customer_key, got[101].customer_key) == (expected[7], expected[8])
