"""A third of all rows in one group, partly as identical copies."""

from datetime import datetime

import pytest
from pyspark.sql import functions as F

from cartloom.operators import quality as dq
from cartloom.operators.aggregates import units_by_category_month
from cartloom.operators.asof import asof_left, find_hot_keys
from cartloom.operators.dedup import latest_per_key

from .conftest import plan, rows

N = 30_000


@pytest.fixture(scope="module")
def skewed(spark):
    """Key 0 owns a third of the rows, half of those being copies; a tenth has no key."""
    ids = spark.range(N)
    return ids.selectExpr(
        "CASE WHEN id % 3 = 0 THEN 0 WHEN id % 10 = 1 THEN NULL ELSE cast(id % 700 AS int) END AS k",
        "if(id % 6 = 0, 7L, id) AS v",
        "TIMESTAMP_NTZ '2026-01-15' AS t",
        "1 AS quantity",
    ).repartition(8, "v")


def test_dedup_of_a_hot_group(spark, skewed):
    latest = latest_per_key(skewed, ["k"], [F.col("t").desc_nulls_first(), F.col("v").desc_nulls_last()])
    expected = skewed.groupBy("k").agg(F.max("v").alias("v"))
    assert rows(latest, "k", "v") == rows(expected)


def test_hot_and_missing_keys_are_dealt_out_in_one_pass(spark, conf, skewed):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    dim = spark.range(700).selectExpr(
        "cast(id AS int) AS k", "TIMESTAMP_NTZ '2026-01-01' AS effective_from",
        "CAST(NULL AS TIMESTAMP_NTZ) AS effective_to", "id * 1.0D AS price",
    )
    hot = find_hot_keys(skewed, "k", share=0.2)
    assert hot == [0]
    args = (skewed, dim, "k", "t", {"price": "price"})
    split, plain = asof_left(*args, hot_keys=hot), asof_left(*args)
    assert split.count() == plain.count() == N
    assert split.exceptAll(plain).isEmpty() and plain.exceptAll(split).isEmpty()
    text = plan(split)
    assert "SortMergeJoin" in text and "Union" not in text and "__salt" in text


def test_checks_on_a_hot_group(spark, skewed):
    parents = spark.createDataFrame([(k,) for k in range(1, 700)], "k int")
    orphans = skewed.filter("k = 0").count()
    assert dq.check_fk(skewed, "k", parents, "k", "fk").first()["failing"] == orphans
    repeated = skewed.filter("k IS NOT NULL").groupBy("k", "v").count().filter("count > 1").count()
    assert dq.check_unique(skewed, ["k", "v"], "u").first()["failing"] == repeated == 1


def test_units_move_one_row_per_product_and_month(spark, conf, skewed):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    products = spark.range(700).selectExpr("cast(id AS int) AS k", "id % 2 AS category")
    units = units_by_category_month(skewed.withColumnRenamed("t", "order_date"), products, key="k")
    expected = skewed.filter("k IS NOT NULL").groupBy((F.col("k") % 2).alias("c")).count()
    assert [(c, int(u)) for c, _, u in rows(units)] == rows(expected)
    text = plan(units)
    join = text.index("SortMergeJoin")
    assert "partial_sum" in text[join:]  # summed below the join


def test_latest_time_wins_over_copies(spark):
    copies = spark.range(1000).selectExpr("1 AS k", "1 AS tag", "TIMESTAMP_NTZ '2026-01-01' AS t")
    newer = spark.createDataFrame([(1, 2, datetime(2026, 1, 2))], "k int, tag int, t timestamp_ntz")
    both = copies.unionByName(newer)
    latest = latest_per_key(both, ["k"], [F.col("t").desc_nulls_first(), F.col("tag").desc()])
    assert rows(latest, "tag") == [(2,)]
