import json

import pytest

from cartloom.sources.json_batches import read_bronze
from cartloom.sources.ledger import unseen_files
from cartloom.streaming.ingest import ingest_new_files

from .conftest import rows


def land(root, name, records, array=False):
    folder = root / "raw" / "products" / "year=2026" / "month=01" / "day=01"
    folder.mkdir(parents=True, exist_ok=True)
    text = json.dumps(records) if array else "\n".join(json.dumps(r) for r in records)
    (folder / name).write_text(text)


@pytest.mark.parametrize("layout", ["lines", "array"])
def test_each_file_is_loaded_once(spark, tmp_path, layout):
    array = layout == "array"
    lake = str(tmp_path / "lake")
    land(tmp_path, "a.json", [{"id": 1}, {"id": "x"}], array)
    land(tmp_path, "b.json", [], array)
    run = lambda: ingest_new_files(spark, "products", str(tmp_path), lake, layout)
    assert run() == {"parsed": 2, "loaded": 1, "rejected": 1}
    assert run() == {"parsed": 0, "loaded": 0, "rejected": 0}
    land(tmp_path, "c.json", [{"id": 2}], array)
    assert run() == {"parsed": 1, "loaded": 1, "rejected": 0}
    assert rows(read_bronze(spark, "products", lake), "id") == [(1,), (2,)]
    assert read_bronze(spark, "products", lake, rejects=True).count() == 1


def test_backlog_is_split_and_each_batch_reported(spark, tmp_path):
    for i in range(3):
        land(tmp_path, f"{i}.json", [{"id": i}])
    seen = []
    counts = ingest_new_files(
        spark, "products", str(tmp_path), str(tmp_path / "lake"),
        max_files_per_batch=1, after_batch=seen.append,
    )
    assert counts["loaded"] == 3
    assert seen == [0, 1, 2]


def test_replayed_batch_does_not_duplicate(spark, tmp_path):
    """A failure after the write and before the commit makes the stream replay the batch."""
    land(tmp_path, "a.json", [{"id": 1}])
    lake = str(tmp_path / "lake")

    def fail(_):
        raise RuntimeError("lost driver")

    with pytest.raises(Exception, match="lost driver"):
        ingest_new_files(spark, "products", str(tmp_path), lake, after_batch=fail)
    assert ingest_new_files(spark, "products", str(tmp_path), lake)["loaded"] == 1
    assert read_bronze(spark, "products", lake).count() == 1


def test_unknown_entity(spark, tmp_path):
    with pytest.raises(ValueError, match="unknown entity"):
        ingest_new_files(spark, "orders", str(tmp_path), str(tmp_path))


def test_unseen_files(spark):
    listed = spark.createDataFrame([("a",), ("b",), ("b",), ("c",)], "path string")
    ledger = spark.createDataFrame([("a",), ("a",), ("z",)], "path string")
    assert rows(unseen_files(listed, ledger)) == [("b",), ("c",)]
