"""Three daily runs over landed files: a price change, a removed user, a bad row, a repeat."""

import json
from datetime import date, datetime, timedelta, timezone

import pytest
from pyspark.sql import functions as F

from cartloom.operators.quality import CheckFailed, check_unique
from cartloom.plans import refresh as job
from cartloom.schemas import SEED_ORDER_ITEMS
from cartloom.sources.latest_store import LatestStore
from cartloom.sources.seed_csv import write_seed
from cartloom.streaming.ingest import ingest_new_files

from .conftest import rows

DAYS = [datetime(2026, 3, d, 6, tzinfo=timezone.utc) for d in (1, 2, 3)]


def land(lake, entity, now, run, records):
    stamp = {
        "_loaded_at": now.isoformat(), "_source": "shop", "_entity": entity,
        "_load_date": f"{now:%Y-%m-%d}", "_run_id": run,
    }
    folder = lake / "raw" / entity / f"year={now:%Y}" / f"month={now:%m}" / f"day={now:%d}"
    folder.mkdir(parents=True, exist_ok=True)
    text = json.dumps([{**stamp, **r} for r in records], indent=1)
    (folder / f"{entity}_{now:%Y%m%d_%H%M%S}.json").write_text(text)


def product(i, price):
    return {
        "id": i, "title": f"t{i}", "price": price, "description": "d", "category": "c",
        "image": "i", "rating": {"rate": 4.5, "count": 9},
    }


def user(i, city="Rome"):
    return {
        "id": i, "email": f"{i}@x", "username": f"u{i}", "password": "pw", "phone": "1",
        "name": {"firstname": f"F{i}", "lastname": "L"},
        "address": {
            "city": city, "street": "s", "number": 1, "zipcode": "9",
            "geolocation": {"lat": "1.5", "long": "-2.5"},
        },
    }


def cart(i, user_id, day, *items):
    return {
        "id": i, "userId": user_id, "date": f"{day}T12:00:00.000Z",
        "products": [{"productId": p, "quantity": q} for p, q in items],
    }


@pytest.fixture
def lake(spark, tmp_path):
    seed = spark.createDataFrame(
        [(1, 900, 1, 1, 2, 3.0, 6.0, date(2026, 3, 2))], SEED_ORDER_ITEMS
    )
    write_seed(seed, str(tmp_path / "seed"))
    yield job.Lake(str(tmp_path / "landing"), str(tmp_path / "lake"), str(tmp_path / "seed"))
    for name in ("stg_products", "stg_users", "stg_carts"):
        spark.sql(f"DROP TABLE IF EXISTS staging.{name}")


def land_day(lake, n, products, users, carts):
    root = __import__("pathlib").Path(lake.landing)
    for entity, records in (("products", products), ("users", users), ("carts", carts)):
        land(root, entity, DAYS[n], f"run-{n}", records)


def test_three_runs(spark, lake):
    land_day(
        lake, 0,
        [product(1, 10.0), product("bad", 1.0), product(2, 5.0)],
        [user(1), user(2)],
        [cart(50, 1, "2026-03-01", (1, 2), (2, 1)), cart(51, 2, "2020-01-01", (1, 1)), cart(52, 1, "2026-03-01")],
    )
    loaded = job.refresh(spark, lake, DAYS[0], layout="array")
    assert loaded["products"] == {"parsed": 3, "loaded": 2, "rejected": 1}
    counts = job.expected_counts(spark, lake)
    assert counts == {
        "raw.products": 2, "raw.users": 2, "raw.carts": 3,
        "staging.stg_products": 2, "staging.stg_users": 2, "staging.stg_carts": 3,
        "snapshot.products": 2, "snapshot.customers": 2,
        "dim_date": 730, "dim_product": 2, "dim_customer": 2, "fact_order_items": 4,
    }

    land_day(
        lake, 1,
        [product(1, 12.0), product(2, 5.0)],
        [user(1, "Oslo")],
        [cart(53, 1, "2026-03-02", (1, 3)), cart(50, 1, "2026-03-01", (1, 2), (2, 1))],
    )
    job.refresh(spark, lake, DAYS[1], layout="array")

    # Nothing landed on the third day: no table changes.
    before = job.expected_counts(spark, lake)
    loaded = job.refresh(spark, lake, DAYS[2], layout="array")
    assert loaded["carts"] == {"parsed": 0, "loaded": 0, "rejected": 0}
    assert job.expected_counts(spark, lake) == before

    prices = spark.table("dim_product").filter("product_id = 1").orderBy("effective_from")
    assert [r.price for r in prices.collect()] == [10.0, 12.0]
    # Staging keeps the newest row of every key ever loaded, so user 2 does not vanish.
    assert rows(spark.table("dim_customer").filter("effective_to IS NULL"), "user_id", "city") == [
        (1, "Oslo"), (2, "Rome"),
    ]
    fact = spark.table("fact_order_items")
    got = rows(fact.filter("loaded_at IS NOT NULL"), "order_id", "product_id", "unit_price", "total_price")
    assert got == sorted(
        [
            (50, 1, 10.0, 20.0), (50, 1, 10.0, 20.0), (50, 2, 5.0, 5.0), (50, 2, 5.0, 5.0),
            (51, 1, None, None), (53, 1, 12.0, 36.0),
        ],
        key=lambda r: [(v is not None, str(v)) for v in r],
    )
    # Cart 50 came in two runs: its item keys repeat, which the check reports.
    assert check_unique(fact, ["order_item_key"], "u").first()["failing"] == 2
    assert fact.filter("loaded_at IS NULL").select("unit_price", "total_price").first() == (3.0, 6.0)
    assert "password" not in spark.table("staging.stg_users").columns
    assert spark.table("staging.stg_users").select("latitude", "longitude").first() == (1.5, -2.5)


def test_a_failed_check_stops_the_run(spark, lake):
    land_day(lake, 0, [product(1, None)], [user(1)], [cart(1, 1, "2026-03-01", (1, 1))])
    with pytest.raises(CheckFailed) as caught:
        job.refresh(spark, lake, DAYS[0], layout="array")
    assert caught.value.failures == {"raw.products.price not_null": 1}


def test_incremental_staging_equals_a_full_rebuild(spark, lake):
    days = (
        ([product(1, 10.0), product(2, 5.0)], [user(1), user(2)]),
        ([product(1, 12.0)], [user(1, "Oslo"), user(3)]),
        ([product(2, 6.0), product(4, 1.0)], [user(2, "Bern")]),
    )
    tables = ("staging.stg_products", "staging.stg_users")
    for n, (products, users) in enumerate(days):
        land_day(lake, n, products, users, [cart(n, 1, "2026-03-01", (1, 1))])
        job.ingest(spark, lake, "array")
        job.stage(spark, lake, incremental=True)
        merged = [rows(spark.table(t)) for t in tables]
        job.stage(spark, lake, incremental=True)  # nothing new: nothing changes
        assert [rows(spark.table(t)) for t in tables] == merged
        job.stage(spark, lake)
        assert [rows(spark.table(t)) for t in tables] == merged
    assert len(merged[0]) == 3 and len(merged[1]) == 3


def test_incremental_staging_reads_only_new_batches(spark, lake):
    for n in range(2):
        land_day(lake, n, [product(n, 1.0)], [user(n)], [])
        job.ingest(spark, lake, "array")
        store = LatestStore(spark, lake.root, "products", ["id"])
        assert store.advance().count() == n + 1
        assert store.generations.last() == (n + 1, n)
    assert store.advance().count() == 2
    assert store.generations.last() == (2, 1)


def test_refresh_after_each_ingested_batch(spark, lake):
    land_day(lake, 0, [product(1, 1.0)], [user(1)], [cart(1, 1, "2026-03-01", (1, 1))])
    for entity in ("products", "users"):
        ingest_new_files(spark, entity, lake.landing, lake.root, "array")
    runs = []

    def rebuild(batch_id):
        now = DAYS[0] + timedelta(minutes=batch_id)
        job.stage(spark, lake)
        job.snapshot(spark, lake, now)
        job.publish(spark, lake)
        runs.append(job.check(spark, lake))

    ingest_new_files(spark, "carts", lake.landing, lake.root, "array", after_batch=rebuild)
    assert len(runs) == 1 and len(runs[0]) == 12
    fact = spark.table("fact_order_items")
    assert fact.filter(F.col("loaded_at").isNotNull()).count() == 1


def test_landed_by_us_then_refreshed(spark, lake):
    """Frames in, star out: the landing step writes what the ingestion step reads."""
    products = spark.createDataFrame(
        [(1, "bag", 10.0, (4.5, 9))],
        "id long, title string, price double, rating struct<rate: double, count: int>",
    ).withColumn("category", F.lit("bags"))
    users = spark.createDataFrame(
        [(5, "a@x", ("Ann", None))], "id long, email string, name struct<firstname: string, lastname: string>"
    )
    carts = spark.createDataFrame(
        [(70, 5, "2026-03-01T12:00:00.000Z", [(1, 3)]), (71, 5, "2026-03-01T12:00:00.000Z", [])],
        "id long, userId long, date string, products array<struct<productId: long, quantity: int>>",
    )
    frames = {"products": products, "users": users, "carts": carts}
    locations, run_id = job.land(frames, lake, "shop", DAYS[0])
    assert set(locations) == set(frames) and len(run_id) == 36

    loaded = job.refresh(spark, lake, DAYS[0], incremental=True)
    assert {e: c["loaded"] for e, c in loaded.items()} == {"products": 1, "users": 1, "carts": 2}
    fact = spark.table("fact_order_items").filter("loaded_at IS NOT NULL").collect()
    assert [(r.order_id, r.product_id, r.quantity, r.total_price) for r in fact] == [(70, 1, 3, 30.0)]
    staged = spark.table("staging.stg_carts").first()
    assert (staged.run_id, staged.source_system) == (run_id, "shop")
    assert spark.table("dim_customer").select("first_name", "full_name").first() == ("Ann", None)
    assert spark.table("staging.stg_products").select("rating_score", "rating_count").first() == (4.5, 9)
    with pytest.raises(ValueError, match="unknown entity"):
        job.land({"orders": products}, lake, "shop", DAYS[0])
