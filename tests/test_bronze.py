import json
from datetime import datetime, timezone

import pytest
from pyspark.sql import functions as F

from cartloom.operators.bronze import bind_entity, split_rejects, unreadable_members
from cartloom.operators.stamp import enrich
from cartloom.schemas import BRONZE, ENTITY_SPECS, RAW, entity_spec
from cartloom.sources.json_batches import (
    land_json,
    load_bronze,
    load_run,
    read_bronze,
    read_json_batch,
)
from cartloom.sources.latest_store import LatestStore
from cartloom.streaming.ingest import ingest_new_files

from .conftest import rows

NOW = datetime(2026, 3, 5, 7, 8, 9, tzinfo=timezone.utc)
STAMP = {
    "_loaded_at": "2026-03-05T07:08:09+00:00",
    "_source": "shop",
    "_entity": "products",
    "_load_date": "2026-03-05",
    "_run_id": "r1",
}


def product(id_, **more):
    return {"id": id_, "title": f"p{id_}", "price": 1.5, "category": "c", **STAMP, **more}


def put(path, value):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(value if isinstance(value, str) else json.dumps(value, indent=2))
    return str(path)


def test_contracts():
    assert [len(RAW[e].fields) for e in ("products", "users", "carts")] == [12, 12, 9]
    assert RAW["carts"].fieldNames()[:4] == ["id", "userid", "date", "products"]
    assert BRONZE["carts"].fieldNames()[-2:] == ["_file", "_row_tag"]
    assert entity_spec("users").table == "raw.users"


def test_unknown_entity_fails_before_io(spark):
    with pytest.raises(ValueError, match="unknown entity"):
        load_bronze(spark, "orders", "/nowhere", "/nowhere", "b")
    with pytest.raises(ValueError, match="unknown entity"):
        load_run(spark, {"orders": "/nowhere"}, "/nowhere", "r")


def test_array_scan_isolates_a_bad_element(spark, tmp_path):
    file = put(tmp_path / "a.json", [product(1), product("oops"), product(3)])
    put(tmp_path / "empty.json", "[]")
    bound = bind_entity(read_json_batch(spark, str(tmp_path)), ENTITY_SPECS["products"])
    good, bad = split_rejects(bound)
    assert rows(good, "id", "_row_tag") == [(1, 0), (3, 2)]
    assert [r["members"] for r in unreadable_members(bad, ENTITY_SPECS["products"]).collect()] == [["id"]]
    assert bad.first()["_file"].endswith(file)


def test_unparseable_file_is_one_reject(spark, tmp_path):
    put(tmp_path / "cut.json", '[{"id": 1}, {"id": ')
    put(tmp_path / "one.json", product(8))
    good, bad = split_rejects(bind_entity(read_json_batch(spark, str(tmp_path)), ENTITY_SPECS["products"]))
    assert rows(good, "id") == [(8,)]
    assert bad.count() == 1


def test_record_that_is_no_object_is_rejected(spark, tmp_path):
    put(tmp_path / "a.json", "[7, {}]")
    good, bad = split_rejects(bind_entity(read_json_batch(spark, str(tmp_path)), ENTITY_SPECS["products"]))
    assert rows(good, "id", "_row_tag") == [(None, 1)]
    assert bad.count() == 1


@pytest.mark.parametrize("tail", [' {"id": 2}', ' junk', ', {"id": 2}', '] junk [', '}'])
def test_text_after_a_record_is_rejected(spark, tmp_path, tail):
    put(tmp_path / "a.json", '{"id": 1}\n{"id": 3}' + tail)
    good, bad = split_rejects(bind_entity(read_json_batch(spark, str(tmp_path), "lines"), ENTITY_SPECS["products"]))
    assert rows(good, "id") == [(1,)] and bad.count() == 1


def test_the_wrong_layout_loads_nothing(spark, tmp_path):
    put(tmp_path / "array.json", [product(1), product(2)])
    put(tmp_path / "lines.json", "\n".join(json.dumps(product(n)) for n in range(3)))
    for name, layout in (("array", "lines"), ("lines", "array")):
        records = read_json_batch(spark, str(tmp_path / f"{name}.json"), layout)
        good, bad = split_rejects(bind_entity(records, ENTITY_SPECS["products"]))
        assert good.count() == 0 and bad.count() > 0


def test_each_file_once_for_every_entry_point(spark, tmp_path):
    one = spark.createDataFrame([(1,)], "id long")
    where = {"products": land_json(one, "products", str(tmp_path), NOW)}
    root = str(tmp_path / "lake")
    assert read_bronze(spark, "products", root).count() == 0  # nothing loaded yet
    load_run(spark, where, root, "r1")
    ingest_new_files(spark, "products", str(tmp_path), root)
    load_run(spark, where, root, "r2")
    assert rows(read_bronze(spark, "products", root), "id") == [(1,)]


def test_a_half_written_batch_is_merged_after_its_replay(spark, tmp_path):
    root = str(tmp_path / "lake")
    for n, batch in enumerate(("000000000000", "000000000001"), start=1):
        load_bronze(spark, "products", put(tmp_path / f"{n}.json", [product(n)]), root, batch)
    mark = tmp_path / "lake" / "bronze" / "products" / "batch=000000000001" / "_SUCCESS"
    mark.unlink()
    store = LatestStore(spark, root, "products", ["id"])
    assert rows(store.advance(), "id") == [(1,)]
    mark.touch()
    assert rows(store.advance(), "id") == [(1,), (2,)]


def test_lines_layout_isolates_a_bad_line(spark, tmp_path):
    lines = [json.dumps(product(1)), '{"id": ', "", json.dumps(product(2))]
    put(tmp_path / "a.json", "\n".join(lines))
    records = read_json_batch(spark, str(tmp_path), layout="lines")
    good, bad = split_rejects(bind_entity(records, ENTITY_SPECS["products"]))
    assert rows(good, "id") == [(1,), (2,)]
    assert bad.count() == 1


def test_cart_binding_is_case_sensitive_and_reads_iso_time(spark, tmp_path):
    cart = {"id": 1, "userId": 5, "date": "2020-03-02T00:00:00.000Z", "products": [{"productId": 1}]}
    put(tmp_path / "a.json", [cart, {**cart, "id": 2, "userid": 9, "userId": None}])
    good, _ = split_rejects(bind_entity(read_json_batch(spark, str(tmp_path)), ENTITY_SPECS["carts"]))
    found = good.orderBy("id").select("userid", good.date.cast("timestamp_ntz").alias("d")).collect()
    assert [r.userid for r in found] == [5, None]
    assert found[0].d == datetime(2020, 3, 2)


def test_load_counts_rejects_and_retry(spark, tmp_path):
    file = put(tmp_path / "in" / "a.json", [product(1), product("x"), product(3, rating={"rate": 2})])
    root = str(tmp_path / "lake")
    for _ in range(2):  # the same batch again replaces itself
        counts = load_bronze(spark, "products", file, root, "b1")
        assert counts == {"parsed": 3, "loaded": 2, "rejected": 1}
    assert read_bronze(spark, "products", root).count() == 2
    assert read_bronze(spark, "products", root, rejects=True).count() == 1
    load_bronze(spark, "products", file, root, "b2")  # another batch holds the file already
    assert read_bronze(spark, "products", root).count() == 2
    load_bronze(spark, "products", file, root, "b3", force=True)
    assert read_bronze(spark, "products", root).count() == 4
    assert read_bronze(spark, "products", root).columns == BRONZE["products"].fieldNames()


@pytest.mark.parametrize("entity", ["products", "users", "carts"])
def test_landing_location_and_read_back(spark, tmp_path, entity):
    batch = spark.createDataFrame([(1, "t"), (2, None)], "id long, title string")
    location = land_json(enrich(batch, entity, "shop", "r1", NOW), entity, str(tmp_path), NOW)
    assert location == (
        f"{tmp_path}/raw/{entity}/year=2026/month=03/day=05/{entity}_20260305_070809.json"
    )
    good, bad = split_rejects(bind_entity(read_json_batch(spark, location, "lines"), ENTITY_SPECS[entity]))
    assert rows(good, "id", "_run_id") == [(1, "r1"), (2, "r1")]
    assert bad.count() == 0
    whole_prefix = read_json_batch(spark, f"{tmp_path}/raw/{entity}", "lines")
    assert whole_prefix.count() == 2


def test_landing_an_empty_batch_and_the_same_second(spark, tmp_path):
    empty = spark.createDataFrame([], "id long")
    location = land_json(empty, "products", str(tmp_path), NOW)
    assert any(p.name.endswith(".json") for p in __import__("pathlib").Path(location).iterdir())
    assert read_json_batch(spark, location, "lines").count() == 0
    one = spark.createDataFrame([(1,)], "id long")
    assert land_json(one, "products", str(tmp_path), NOW) == location
    land_json(one, "products", str(tmp_path), NOW)
    assert read_json_batch(spark, location, "lines").count() == 2


def test_load_run_names_one_batch_per_entity(spark, tmp_path):
    batch = spark.createDataFrame([(1, 2)], "id long, userId long")
    where = {
        e: land_json(enrich(batch, e, "shop", "r1", NOW), e, str(tmp_path), NOW)
        for e in ("products", "carts")
    }
    root = str(tmp_path / "lake")
    counts = load_run(spark, where, root, "r1")
    assert counts["carts"] == {"parsed": 1, "loaded": 1, "rejected": 0}
    load_run(spark, where, root, "r1")
    assert rows(read_bronze(spark, "carts", root), "id", "userid") == [(1, 2)]


def test_enrich_overwrites_and_is_one_instant(spark):
    df = spark.range(3).withColumn("_source", F.lit("old"))
    stamped = enrich(df, "carts", "shop", "r9", NOW)
    assert stamped.columns == ["id", "_source", "_loaded_at", "_entity", "_load_date", "_run_id"]
    assert stamped.select("_source", "_entity", "_run_id").distinct().collect() == [("shop", "carts", "r9")]
    instant = stamped.select(F.col("_loaded_at").cast("timestamp_ntz")).distinct().collect()
    assert instant == [(datetime(2026, 3, 5, 7, 8, 9),)]
    with pytest.raises(ValueError):
        enrich(df, "carts", "shop", "r9", datetime(2026, 1, 1))
