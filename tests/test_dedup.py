import random
from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cartloom.operators.dedup import bronze_order, latest_per_key, merge_latest

from .conftest import plan, rows

SCHEMA = "id int, _run_id string, _loaded_at timestamp_ntz, _file string, _row_tag long, v string"
T1, T2 = datetime(2026, 1, 1), datetime(2026, 1, 2)


def test_newest_load_wins_per_key_and_per_run(spark):
    data = [
        (1, "a", T1, "f1", 0, "old"),
        (1, "b", T2, "f2", 0, "new"),
        (1, "b", T1, "f1", 5, "older"),
        (2, "a", T1, "f1", 1, "only"),
    ]
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(latest_per_key(df, ["id"], bronze_order()), "id", "v") == [(1, "new"), (2, "only")]
    per_run = latest_per_key(df, ["id", "_run_id"], bronze_order())
    assert rows(per_run, "id", "_run_id", "v") == [(1, "a", "old"), (1, "b", "new"), (2, "a", "only")]


def test_ties_and_null_times(spark):
    data = [
        (1, "a", T1, "f1", 7, "file loses"),
        (1, "a", T1, "f2", 0, "row loses"),
        (1, "a", T1, "f2", 1, "tie winner"),
        (2, "a", T2, "f1", 0, "dated"),
        (2, "a", None, "f1", 1, "undated first"),
        (None, "a", T1, "f1", 0, "null key"),
    ]
    df = spark.createDataFrame(data, SCHEMA)
    assert rows(latest_per_key(df, ["id"], bronze_order()), "id", "v") == [
        (None, "null key"), (1, "tie winner"), (2, "undated first"),
    ]


def test_order_without_tie_break_is_refused(spark):
    df = spark.createDataFrame([], SCHEMA)
    with pytest.raises(ValueError, match="tie-break"):
        latest_per_key(df, ["id"], [F.col("_loaded_at").desc()])


def test_idempotent_and_equal_to_incremental(spark):
    rng = random.Random(5)
    data = [
        (rng.randint(0, 9), "r", rng.choice([T1, T2, None]), f"f{rng.randint(0, 2)}", i, str(i))
        for i in range(120)
    ]
    df = spark.createDataFrame(data, SCHEMA)
    full = rows(latest_per_key(df, ["id"], bronze_order()))
    once = latest_per_key(df.filter("_row_tag < 50"), ["id"], bronze_order())
    folded = merge_latest(once, df.filter("_row_tag >= 50"), ["id"], bronze_order())
    assert rows(folded) == full
    assert rows(latest_per_key(folded, ["id"], bronze_order())) == full


def test_rows_are_limited_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, "a", T1, "f", 0, "v")], SCHEMA)
    text = plan(latest_per_key(df, ["id"], bronze_order()))
    below_exchange = text[text.index("Exchange") :]
    assert "WindowGroupLimit" in below_exchange and "Partial" in below_exchange
