import random
from datetime import datetime, timedelta

import pytest
from pyspark.sql import functions as F

from cartloom.operators import quality as dq

from .conftest import rows

DAY = datetime(2026, 1, 1)


def test_not_null_counts_all_columns_in_one_scan(spark):
    df = spark.createDataFrame([(1, None), (None, None), (3, "x")], "a int, b string")
    assert rows(dq.check_not_null(df, ["a", "b"], "t.")) == [("t.a not_null", 1), ("t.b not_null", 2)]
    empty = dq.check_not_null(df.limit(0), ["a"])
    assert rows(empty) == [("a not_null", 0)]


def test_unique_foreign_key_accepted(spark):
    df = spark.createDataFrame([(1, "x"), (1, "x"), (2, "y"), (None, "z"), (None, "z")], "k int, v string")
    parent = spark.createDataFrame([(1,), (1,), (7,)], "id int")
    assert dq.check_unique(df, ["k"], "u").first()["failing"] == 1
    assert dq.check_unique(df, ["k", "v"], "u").first()["failing"] == 1
    assert dq.check_fk(df, "k", parent, "id", "fk").first()["failing"] == 1
    assert dq.check_accepted(df, "v", ["x", "y"], "a").first()["failing"] == 2
    assert dq.check_fk(df.limit(0), "k", parent, "id", "fk").first()["failing"] == 0


def test_fields_present(spark):
    df = spark.createDataFrame([('{"id": 1}',), ('{"id": null}',), ("{}",)], "t string")
    records = df.select(F.parse_json("t").alias("r"))
    assert rows(dq.check_fields(records, "r", ["id", "title"])) == [("id present", 1), ("title present", 3)]


def test_failing_check_fails_the_run(spark):
    good = spark.createDataFrame([(1,)], "a int")
    bad = spark.createDataFrame([(None,)], "a int")
    assert dq.run_checks([dq.check_not_null(good, ["a"])]) == {"a not_null": 0}
    with pytest.raises(dq.CheckFailed) as caught:
        dq.run_checks([dq.check_not_null(good, ["a"], "g."), dq.check_not_null(bad, ["a"], "b.")])
    assert caught.value.failures == {"b.a not_null": 1}


@pytest.mark.parametrize("seed", range(4))
def test_overlap_equals_brute_force(spark, seed):
    rng = random.Random(seed)
    data, failing = [], 0
    for key in range(8):
        versions = []
        for _ in range(rng.randint(1, 12)):
            start = rng.randint(0, 300)
            end = None if rng.random() < 0.1 else start + rng.randint(1, 90)
            versions.append((start, end))
        versions.sort(key=lambda v: (v[0], v[1] is None, v[1] or 0))
        for (_, end), (nxt, _) in zip(versions, versions[1:]):
            failing += end is None or nxt < end
        data += [
            (key, DAY + timedelta(days=s), None if e is None else DAY + timedelta(days=e))
            for s, e in versions
        ]
    df = spark.createDataFrame(
        data, "k int, effective_from timestamp_ntz, effective_to timestamp_ntz"
    )
    for bucket in (7, 30, 10_000):
        assert dq.check_no_overlap(df, "k", "o", bucket_days=bucket).first()["failing"] == failing
