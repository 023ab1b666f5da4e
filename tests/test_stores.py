from datetime import datetime, timedelta, timezone

import pytest

from cartloom.schemas import HistorySpec
from cartloom.sources.catalog import ensure_namespaces, publish_table, publish_view
from cartloom.sources.snapshot_store import SnapshotStore

from .conftest import plan, rows

SPEC = HistorySpec(key="k", columns=("k", "a"), check_cols=("a",))
T1 = datetime(2026, 1, 1, tzinfo=timezone.utc)
T2, T3 = T1 + timedelta(days=1), T1 + timedelta(days=2)


def batch(spark, *data):
    return spark.createDataFrame(list(data), "k int, a string")


def versions(store):
    df = store.read().selectExpr(
        "k", "a", "date_format(valid_from, 'dd') AS f", "date_format(valid_to, 'dd') AS t"
    )
    return sorted(map(repr, (tuple(r) for r in df.collect())))


def test_generations(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "s"), SPEC)
    assert store.read() is None and store.generations.last() is None
    assert store.advance(batch(spark, (1, "x"), (2, "x")), T1) == 1
    assert store.advance(batch(spark, (1, "y")), T2) == 2
    assert store.advance(batch(spark, (1, "y"), (2, "z")), T3) == 3
    expected = [(1, "x", "01", "02"), (1, "y", "02", None), (2, "x", "01", "02"), (2, "z", "03", None)]
    assert versions(store) == sorted(map(repr, expected))
    assert rows(store.read("open"), "k", "a") == [(1, "y"), (2, "z")]


def test_open_rows_are_found_by_partition_only(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "s"), SPEC)
    store.advance(batch(spark, (1, "x")), T1)
    store.advance(batch(spark, (1, "y")), T2)
    scan = plan(store.read("open"))
    assert "PartitionFilters: []" not in scan
    assert "PushedFilters: []" in scan


def test_uncommitted_generation_is_invisible_and_rewritten(spark, tmp_path):
    root = str(tmp_path / "s")
    store = SnapshotStore(spark, root, SPEC)
    store.advance(batch(spark, (1, "x")), T1)
    before = versions(store)

    def die(generation, mark):
        raise RuntimeError("lost driver")

    dying = SnapshotStore(spark, root, SPEC)
    dying.generations.commit = die
    with pytest.raises(RuntimeError):
        dying.advance(batch(spark, (1, "y"), (5, "n")), T2)
    assert versions(store) == before
    assert store.advance(batch(spark, (1, "z")), T2) == 2
    assert versions(store) == sorted(map(repr, [(1, "x", "01", "02"), (1, "z", "02", None)]))


def test_same_run_twice_and_older_run(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "s"), SPEC)
    store.advance(batch(spark, (1, "x")), T1)
    store.advance(batch(spark, (1, "y")), T2)
    once = versions(store)
    store.advance(batch(spark, (1, "y")), T2)
    assert versions(store) == once
    with pytest.raises(ValueError, match="older"):
        store.advance(batch(spark, (1, "z")), T1)
    with pytest.raises(ValueError, match="time zone"):
        store.advance(batch(spark, (1, "z")), datetime(2027, 1, 1))


def test_old_open_rows_are_dropped_but_closed_ones_stay(spark, tmp_path):
    store = SnapshotStore(spark, str(tmp_path / "s"), SPEC)
    for n in range(4):
        store.advance(batch(spark, (1, f"v{n}")), T1 + timedelta(days=n))
    assert not (tmp_path / "s" / "gen=2" / "state=open").exists()
    assert (tmp_path / "s" / "gen=3" / "state=open").exists()
    assert rows(store.read(), "a") == [("v0",), ("v1",), ("v2",), ("v3",)]


def test_table_rebuild_may_read_itself(spark, tmp_path):
    ensure_namespaces(spark)
    root, name = str(tmp_path), "staging.rebuild_me"
    publish_table(spark.range(3), name, root)
    publish_table(spark.table(name).selectExpr("id + 10 AS id"), name, root)
    assert rows(spark.table(name)) == [(10,), (11,), (12,)]
    publish_table(spark.range(1).selectExpr("'a' AS other"), name, root)
    assert rows(spark.table(name)) == [("a",)]


def test_failed_rebuild_keeps_the_table(spark, tmp_path):
    ensure_namespaces(spark)
    root, name = str(tmp_path), "staging.keep_me"
    publish_table(spark.range(2), name, root)
    with pytest.raises(Exception):
        publish_table(spark.range(2).selectExpr("CAST(raise_error('boom') AS BIGINT) AS id"), name, root)
    assert spark.table(name).count() == 2


def test_view_is_lazy(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(5).write.parquet(path)
    publish_view(spark.read.parquet(path).filter("id > 2"), "later")
    assert spark.sql("SELECT count(*) FROM later").first()[0] == 2
    assert "PushedFilters: [IsNotNull(id), GreaterThan(id,2)" in plan(spark.table("later"))
