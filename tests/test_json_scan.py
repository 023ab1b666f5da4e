"""Layouts found per file, arrays cut into elements over many blocks, and the ledger of loaded files."""

import json
import random

import pytest
from pyspark.sql import functions as F

from cartloom.sources import json_scan
from cartloom.sources.json_batches import (
    bronze_path,
    committed_batches,
    load_bronze,
    load_run,
    not_loaded,
    read_bronze,
    read_json_batch,
)
from cartloom.sources.json_scan import listed_files, scan_files
from cartloom.sources.ledger import BatchLedger
from cartloom.streaming.ingest import ingest_new_files

from .conftest import rows

TEXTS = ["a}b", '{"x":[', '\\"}', 'quote " in', "é}{", "back\\", "[", "]", ",", "", "\n}\n"]


def value(rng, depth=0):
    kind = rng.random()
    if kind < 0.3:
        return rng.choice(TEXTS)
    if kind < 0.5:
        return rng.randint(0, 9)
    if kind < 0.7 and depth < 3:
        return [value(rng, depth + 1) for _ in range(rng.randint(0, 3))]
    if kind < 0.9 and depth < 3:
        return {rng.choice('abc}"{'): value(rng, depth + 1) for _ in range(rng.randint(0, 3))}
    return None


def found(spark, folder):
    out = {}
    files = [r[0] for r in listed_files(spark.read, str(folder)).collect()]
    for file, tag, record in scan_files(spark, files).select("_file", "_row_tag", F.to_json("_record")).collect():
        out.setdefault(file.rsplit("/", 1)[1], []).append((tag, None if record is None else json.loads(record)))
    return {name: [r for _, r in sorted(records, key=lambda x: x[0])] for name, records in out.items()}


@pytest.mark.parametrize("block", [700, 1 << 20])
def test_arrays_are_cut_into_elements(spark, conf, tmp_path, block):
    conf("spark.sql.files.maxPartitionBytes", str(block))
    conf("spark.sql.files.openCostInBytes", "0")
    rng, expected = random.Random(block), {}
    for n in range(9):
        elements = [
            {"id": i, "v": value(rng), "w": value(rng)} if rng.random() < 0.9 else rng.choice([7, "s}", [1, {"a": 2}], [], None])
            for i in range((0, 1, 120)[n % 3])
        ]
        text = (
            json.dumps(elements, ensure_ascii=False),
            json.dumps(elements, indent=2),
            "[\n" + ",\n".join(map(json.dumps, elements)) + "\n]\n",
        )[n // 3]
        (tmp_path / f"{n}.json").write_text(text)
        if elements:
            expected[f"{n}.json"] = elements
    (tmp_path / "one object.json").write_text(json.dumps({"id": 1, "v": ["}"]}, indent=2))
    expected["one%20object.json"] = [{"id": 1, "v": ["}"]}]
    assert found(spark, tmp_path) == expected
    if block == 700:
        assert json_scan._fragments(spark, [str(tmp_path / "2.json")]).rdd.getNumPartitions() > 3


@pytest.mark.parametrize("most", [1, 7])
def test_a_block_holds_few_fragments_of_a_split(spark, monkeypatch, tmp_path, most):
    """What a task holds at once follows the block, so a block must not follow the size of a split."""
    monkeypatch.setattr(json_scan, "BLOCK", most, raising=False)
    rng = random.Random(most)
    elements = [{"id": i, "v": value(rng), "w": [[{"a": i}], i]} for i in range(60)]
    one = {"id": 1, "v": ["}", {"a": {}}, {}] * 9}
    texts = {
        "a.json": json.dumps(elements, indent=1), "b.json": json.dumps(elements, ensure_ascii=False),
        "one.json": json.dumps(one, indent=1), "lines.json": "\n".join(map(json.dumps, elements[:9])),
    }
    for name, text in texts.items():
        (tmp_path / name).write_text(text)
    files = [r[0] for r in listed_files(spark.read, str(tmp_path)).collect()]
    rows_ = json_scan._fragments(spark, files)
    blocks = rows_.groupBy("_file", *[c for c in rows_.columns if c in ("_block", "_split", "_part")]).count()
    assert blocks.agg(F.max("count")).first()[0] <= most
    got = found(spark, tmp_path)
    lines = got.pop("lines.json")  # lines carry no order
    assert sorted(lines, key=lambda r: r["id"]) == elements[:9]
    assert got == {"a.json": elements, "b.json": elements, "one.json": [one]}
    tags = scan_files(spark, files).groupBy("_file", "_row_tag").count()
    assert tags.filter("count > 1").isEmpty()


@pytest.mark.parametrize(
    "text",
    ['[{"id": 1}, {"id": ', '[{"id":1}] junk', '[{"id":1}]{"id":2}', '[{"id":1}][{"id":2}]', '[{"id":1}', "[", '[{"id":1}}]'],
)
def test_a_broken_array_is_one_reject(spark, tmp_path, text):
    (tmp_path / "a.json").write_text(text)
    assert found(spark, tmp_path) == {"a.json": [None]}


def test_a_bad_element_is_rejected_alone(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": 1}, {"id": }, {"id": 3}]')
    assert found(spark, tmp_path) == {"a.json": [{"id": 1}, None, {"id": 3}]}


def test_an_array_with_one_element_a_line_in_either_layout(spark, tmp_path):
    file = tmp_path / "a.json"
    file.write_text('[\n{"id":1},\n{"id":2},\n{"id":3}\n]')
    assert read_json_batch(spark, str(file)).count() == 3
    wrong = read_json_batch(spark, str(file), "lines").collect()
    assert [r["_record"] for r in wrong] == [None]
    with pytest.raises(ValueError, match="unknown layout"):
        read_json_batch(spark, str(file), "rows")


def test_no_files_and_blank_files(spark, tmp_path):
    (tmp_path / "a.json").write_text("")
    (tmp_path / "b.json").write_text(" \n\n ")
    (tmp_path / "c[1]*.json").write_text('{"id": 1}\n{"id": 2}\n')
    assert scan_files(spark, []).count() == 0
    assert found(spark, tmp_path).keys() == {"c%5B1%5D*.json"}


def test_arrays_are_read_and_parsed_once(spark, tmp_path):
    (tmp_path / "a.json").write_text('[{"id": 1}, {"id": 2}]')
    out = scan_files(spark, [r[0] for r in listed_files(spark.read, str(tmp_path)).collect()])
    assert not any(f.endswith("/a.json") for f in out.inputFiles())
    plan = out._jdf.queryExecution().optimizedPlan().toString()
    # Once where it is put and once where it is looked for, for elements within a block and for those across.
    assert plan.count("end of the text, read by cartloom") == 4


def put(path, records):
    path.parent.mkdir(parents=True, exist_ok=True)
    path.write_text(json.dumps(records, indent=1))
    return str(path)


def test_a_load_reads_the_ledger_and_no_bronze_rows(spark, tmp_path):
    root = str(tmp_path / "lake")
    files = [put(tmp_path / "in" / f"{n}.json", [{"id": n}]) for n in range(3)]
    for n in range(2):
        load_bronze(spark, "products", files[n], root, f"b{n}")
    listed = listed_files(spark.read, str(tmp_path / "in"))
    fresh = not_loaded(listed, "products", root, "b2")
    inputs = fresh.inputFiles()
    assert not any("/bronze/" in f for f in inputs) and sum("/ledger/products/files/" in f for f in inputs) == 2
    assert [r[0].rsplit("/", 1)[1] for r in fresh.collect()] == ["2.json"]
    assert load_bronze(spark, "products", str(tmp_path / "in"), root, "b2")["loaded"] == 1
    ledger = BatchLedger(spark, root, "products")
    assert ledger.batches() == {"b0", "b1", "b2"}
    notes = ledger.notes()
    assert notes["b2"]["counts"] == {"parsed": 1, "loaded": 1, "rejected": 0}
    assert notes["b2"]["nulls"]["title"] == 1 and notes["b2"]["nulls"]["id"] == 0


def test_a_file_without_rows_is_loaded_once_too(spark, tmp_path):
    root = str(tmp_path / "lake")
    put(tmp_path / "raw" / "products" / "a.json", [])
    ingest_new_files(spark, "products", str(tmp_path), root)
    listed = listed_files(spark.read, str(tmp_path / "raw" / "products"))
    assert not_loaded(listed, "products", root, "other").count() == 0


def test_entries_of_a_batch_that_never_completed_do_not_count(spark, tmp_path):
    root = str(tmp_path / "lake")
    file = put(tmp_path / "a.json", [{"id": 1}])
    name = listed_files(spark.read, file).first()[0]
    BatchLedger(spark, root, "products").enter("lost", [name])
    assert load_bronze(spark, "products", file, root, "b1")["loaded"] == 1
    (tmp_path / "lake" / "bronze" / "products" / "batch=b1" / "_SUCCESS").unlink()
    assert committed_batches(spark, "products", root) == ([], ["b1"])
    assert load_bronze(spark, "products", file, root, "b2")["loaded"] == 1


def test_bronze_from_before_the_ledger_still_counts(spark, tmp_path):
    root = str(tmp_path / "lake")
    file = put(tmp_path / "a.json", [{"id": 1}])
    load_bronze(spark, "products", file, root, "b1")
    folder = tmp_path / "lake" / "ledger"
    folder.rename(tmp_path / "elsewhere")
    assert load_bronze(spark, "products", file, root, "b2")["loaded"] == 0
    assert read_bronze(spark, "products", root).count() == 1
    assert bronze_path(root, "products").endswith("bronze/products")


def test_named_runs_and_streams_share_the_ledger(spark, tmp_path):
    root = str(tmp_path / "lake")
    put(tmp_path / "raw" / "products" / "a.json", [{"id": 1}])
    assert load_run(spark, {"products": f"{tmp_path}/raw/products"}, root, "r1")["products"]["loaded"] == 1
    put(tmp_path / "raw" / "products" / "b.json", [{"id": 2}])
    assert ingest_new_files(spark, "products", str(tmp_path), root)["loaded"] == 1
    assert rows(read_bronze(spark, "products", root), "id") == [(1,), (2,)]
