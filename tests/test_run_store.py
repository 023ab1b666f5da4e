"""Carts rebuilt run by run, batches merged in any order, sessions that start anew between the steps."""

import json
from datetime import date, datetime, timezone

import pytest

from cartloom.operators.quality import CheckFailed
from cartloom.plans import refresh as job
from cartloom.plans.staging import stg_carts
from cartloom.schemas import SEED_ORDER_ITEMS
from cartloom.sources.json_batches import load_bronze, load_run, read_bronze
from cartloom.sources.latest_store import LatestStore
from cartloom.sources.run_store import RUN, RunStore
from cartloom.sources.seed_csv import write_seed

from .conftest import rows

NOW = datetime(2026, 3, 1, 6, tzinfo=timezone.utc)


def record(id_, run, hour=0, **more):
    return {"id": id_, "_run_id": run, "_loaded_at": f"2026-03-01T{hour:02d}:00:00Z", "_source": "s", "_load_date": "2026-03-01", **more}


def cart(id_, run, hour=0, *items):
    return record(id_, run, hour, userId=1, date="2026-03-01T00:00:00Z", products=[{"productId": p, "quantity": 1} for p in items])


def load(spark, tmp_path, root, batch, records, entity="carts"):
    file = tmp_path / "in" / f"{entity}-{batch}.json"
    file.parent.mkdir(exist_ok=True)
    file.write_text(json.dumps(records, indent=1))
    load_bronze(spark, entity, str(file), root, batch)


def test_only_touched_runs_are_rebuilt(spark, tmp_path):
    root = str(tmp_path / "lake")
    store = RunStore(spark, root, "carts", ["id"], stg_carts)
    read = lambda: spark.read.schema(store.schema()).parquet(*store.paths("model").values())
    days = [
        ("b1", [cart(1, "r1", 0, 1, 2), cart(2, "r1", 0, 3)]),
        ("b3", [cart(1, "r2", 1, 1)]),
        ("b2", [cart(2, "r1", 2, 9), cart(7, None, 0, 4)]),  # a late batch of the first run, and carts of none
    ]
    for n, (batch, records) in enumerate(days, start=1):
        load(spark, tmp_path, root, batch, records)
        before = store.runs()
        touched = store.advance()
        after = store.runs()
        assert {r for r, g in after.items() if g == n} == set(touched)
        assert {r: g for r, g in after.items() if r not in touched} == {r: g for r, g in before.items() if r not in touched}
        assert store.advance() == []
        full = stg_carts(read_bronze(spark, "carts", root))
        shown = ["cart_id", "product_id", "run_id", "loaded_at"]
        assert rows(read(), *shown) == rows(full, *shown)
        inputs = read().inputFiles()
        assert all(f"{RUN}=" in f for f in inputs)
    assert len(store.runs()) == 3


def test_batches_merge_in_any_order_and_by_any_name(spark, tmp_path):
    root = str(tmp_path / "lake")
    store = LatestStore(spark, root, "products", ["id"])
    for batch, records in (("z", [record(1, "a", 5, price=2.0)]), ("000000000001", [record(2, "b", 1, price=1.0)]), ("a", [record(1, "c", 1, price=9.0)])):
        load(spark, tmp_path, root, batch, records, "products")
        store.advance()
    assert store.merged.read() == {"z", "000000000001", "a"}
    assert rows(store.read(), "id", "price") == [(1, 2.0), (2, 1.0)]
    assert store.generations.last() == (3, 2)


@pytest.fixture
def lake(spark, tmp_path):
    seed = spark.createDataFrame([(1, 900, 1, 1, 2, 3.0, 6.0, date(2026, 3, 2))], SEED_ORDER_ITEMS)
    write_seed(seed, str(tmp_path / "seed"))
    yield job.Lake(str(tmp_path / "landing"), str(tmp_path / "lake"), str(tmp_path / "seed"))
    forget(spark)


def forget(spark):
    """What a new session without a metastore knows: nothing."""
    for name in ("stg_products", "stg_users", "stg_carts"):
        spark.sql(f"DROP TABLE IF EXISTS staging.{name}")
    for name in ("dim_date", "dim_product", "dim_customer", "fact_order_items"):
        spark.catalog.dropTempView(name)


def land(tmp_path, n, products, carts):
    user = record(1, f"r{n}", n, email="e", username="u", name={"firstname": "F", "lastname": "L"})
    out = {}
    for entity, records in (("products", products), ("users", [user]), ("carts", carts)):
        file = tmp_path / "landing" / "raw" / entity / f"{n}.json"
        file.parent.mkdir(parents=True, exist_ok=True)
        file.write_text(json.dumps(records, indent=1))
        out[entity] = str(file)
    return out


def test_steps_of_new_sessions_and_named_runs(spark, lake, tmp_path):
    item = lambda n, price: record(1, f"r{n}", n, title="t", price=price, category="c")
    shown = ["order_id", "product_id", "unit_price"]
    for n, price in ((1, 5.0), (2, 6.0)):
        load_run(spark, land(tmp_path, n, [item(n, price)], [cart(n, f"r{n}", n, 1)]), lake.root, f"r{n}")
        job.stage(spark, lake, incremental=True)
        forget(spark)
        job.snapshot(spark, lake, NOW.replace(hour=NOW.hour + n))
        forget(spark)
        job.publish(spark, lake)
        incremental = rows(spark.table("fact_order_items"), *shown)
        assert len(job.check(spark, lake)) == 12
    staged = rows(spark.table("staging.stg_carts").drop(RUN))
    job.stage(spark, lake)
    assert rows(spark.table("staging.stg_carts")) == staged
    job.publish(spark, lake)
    assert rows(spark.table("fact_order_items"), *shown) == incremental
    assert job.loaded_rows(spark, lake, "carts") == 2


def test_checks_count_only_batches_without_a_note(spark, lake, tmp_path):
    load_run(spark, land(tmp_path, 1, [record(1, "r1", 1, price=1.0, category="c")], [cart(1, "r1", 1, 1)]), lake.root, "r1")
    expected = {"raw.products.title not_null": 1}
    with pytest.raises(CheckFailed) as caught:
        job.check(spark, lake)
    assert caught.value.failures == expected
    for entity in ("products", "users"):
        (tmp_path / "lake" / "ledger" / entity / "notes" / "r1.json").unlink()
    with pytest.raises(CheckFailed) as caught:
        job.check(spark, lake)
    assert caught.value.failures == expected
    assert job.loaded_rows(spark, lake, "products") == 1
