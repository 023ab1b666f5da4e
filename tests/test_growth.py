"""Steps whose memory or shuffles must not outgrow the tables."""

import re

from cartloom.operators.asof import asof_left_bucketed
from cartloom.plans.queries import QUERIES

from .conftest import plan

SF = "/root/testdata/sf0.001"


def test_growing_dimensions_are_not_sent_to_the_driver(spark):
    text = plan(QUERIES["fact_order_items"](spark, SF))
    sent = re.findall(r"BroadcastExchange .*", text)
    assert len(sent) <= 1  # the calendar, which has a fixed size
    assert "ShuffledHashJoin" in text


def test_items_are_joined_without_sorting_them(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    for name in ("asof_product", "asof_product_hot"):
        text = plan(QUERIES[name](spark, SF))
        assert "SortMergeJoin" not in text and "Sort [l_orderkey" not in text, name


def test_rows_are_dealt_out_before_they_become_records(spark):
    for name, key in (("stg_users", "c_custkey"), ("stg_products", "p_partkey")):
        text = plan(QUERIES[name](spark, SF))
        dealt = text.index(f"hashpartitioning({key}")
        assert text.index("to_variant_object") < dealt, name  # plans are printed from the top


def test_orders_stay_dealt_out_before_they_become_records(spark):
    """AQE would merge the narrow rows again until a task sorts more records than it can hold."""
    text = plan(QUERIES["stg_carts"](spark, SF))
    dealt = re.search(r"hashpartitioning\(o_orderkey.*REPARTITION_BY_NUM", text)
    assert dealt and text.index("to_variant_object") < dealt.start()


def test_no_customer_key_goes_through_the_shuffles_of_the_fact(spark, conf):
    conf("spark.sql.autoBroadcastJoinThreshold", "-1")
    for name in ("fact_order_items", "chain_fact"):
        text = plan(QUERIES[name](spark, SF))
        second, first = text.index("hashpartitioning(product_id"), text.index("hashpartitioning(user_id")
        assert second < first, name  # plans are printed from the top
        assert re.search(r"md5\([^\n]*user_id", text[:second]), name
        assert "SortMergeJoin" in text[:second], name  # lines leave with those of a product together


def test_versions_stand_in_buckets_with_facts_only(spark):
    """A version of a century meets two facts, so two candidates of it move, not one a month."""
    fact = spark.sql("SELECT 1 AS id, explode(array(TIMESTAMP_NTZ '1950-06-01', TIMESTAMP_NTZ '2020-06-01')) AS t")
    dim = spark.sql(
        "SELECT 1 AS id, TIMESTAMP_NTZ '1920-01-01' AS effective_from, CAST(NULL AS TIMESTAMP_NTZ) AS effective_to, 'v' AS v"
    )
    joined = asof_left_bucketed(fact, dim, "id", "t", {"v": "v"})
    assert [r.v for r in joined.collect()] == ["v", "v"]
    assert "sequence(" not in plan(joined) and "collect_set" in plan(joined)
