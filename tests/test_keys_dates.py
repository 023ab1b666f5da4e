import hashlib
from datetime import date, datetime

from pyspark.sql import functions as F

from cartloom.functions.dates import date_key, landing_key, partition_values
from cartloom.functions.keys import NULL_PART, surrogate_key
from cartloom.functions.lookups import MONTH_WEIGHTS, lookup_constant
from cartloom.functions.text import new_run_id, strip_prefix
from cartloom.operators.sampling import month_weighted_sample
from cartloom.plans.marts import dim_date

from .conftest import rows


def md5(text):
    return hashlib.md5(text.encode()).hexdigest()


def test_surrogate_key_text(spark):
    df = spark.createDataFrame(
        [(1, "x", datetime(2024, 1, 1, 0, 0, 7, 100000)), (2, None, None)],
        "id long, s string, t timestamp_ntz",
    )
    got = rows(df.select("id", surrogate_key(df, ["id", "s", "t"]).alias("k")))
    assert got == [
        (1, md5("1-x-2024-01-01 00:00:07.1")),
        (2, md5(f"2-{NULL_PART}-{NULL_PART}")),
    ]


def test_surrogate_key_does_not_depend_on_the_session_zone(spark, conf):
    keys = []
    for zone in ("UTC", "America/New_York", "Asia/Tokyo"):
        conf("spark.sql.session.timeZone", zone)
        df = spark.range(1).select(F.lit("2024-06-01T12:00:00Z").cast("timestamp").alias("t"))
        keys.append(df.select(surrogate_key(df, ["t"])).first()[0])
    assert set(keys) == {md5("2024-06-01 12:00:00")}


def test_date_key_and_partitions(spark):
    df = spark.createDataFrame([(datetime(2024, 2, 3, 23, 59),), (None,)], "t timestamp_ntz")
    assert rows(df.select(date_key("t"))) == [(None,), (20240203,)]
    parts = partition_values("t")
    first = df.filter("t IS NOT NULL").select(*[c.alias(n) for n, c in parts.items()]).first()
    assert first.asDict() == {"year": "2024", "month": "02", "day": "03"}
    assert landing_key("carts", datetime(2024, 2, 3, 4, 5, 6)) == (
        "raw/carts/year=2024/month=02/day=03/carts_20240203_040506.json"
    )


def test_dim_date_defaults(spark):
    dim = dim_date(spark)
    assert dim.count() == 730
    bounds = dim.agg(F.min("full_date"), F.max("full_date")).first()
    assert tuple(bounds) == (date(2024, 1, 1), date(2025, 12, 30))
    by_key = {r.date_key: r for r in dim.collect()}
    sunday, monday = by_key[20240107], by_key[20240108]
    assert (sunday.day_of_week, sunday.day_name, sunday.is_weekend) == (0, "Sun", True)
    assert (monday.day_of_week, monday.month_name, monday.is_weekend) == (1, "Jan", False)
    assert (by_key[20240229].quarter, by_key[20240229].year) == (1, 2024)
    assert by_key[20240106].is_weekend is True


def test_lookup_and_path(spark):
    df = spark.createDataFrame([(1,), (12,), (99,)], "m int")
    got = rows(df.select("m", lookup_constant(F.col("m"), MONTH_WEIGHTS, 1.0).alias("w")))
    assert got == [(1, 1.4), (12, 2.0), (99, 1.0)]
    assert df.select(lookup_constant(F.col("m"), {1: 2.5, 12: 3.0})).collect()[2][0] is None
    path = spark.createDataFrame([("raw/carts/year=2024/x.json",)], "p string")
    assert path.select(strip_prefix("p", "raw/carts/")).first()[0] == "year=2024/x.json"


def test_run_ids_differ():
    assert new_run_id() != new_run_id()
    assert len(new_run_id()) == 36


def test_month_weighted_sample_rates_and_repeatability(spark):
    days = F.expr("date_add(DATE '2023-01-01', cast(id % 365 as int))")
    df = spark.range(36500).select("id", days.alias("day"))
    kept = month_weighted_sample(df, "id", "day")
    per_month = dict(kept.groupBy(F.month("day")).count().collect())
    assert set(per_month) == {m for m, w in MONTH_WEIGHTS.items() if w > 1}
    december = per_month[12] / (31 * 100)
    assert abs(december - 0.5) < 0.05
    again = month_weighted_sample(df.repartition(7), "id", "day")
    assert rows(again, "id") == rows(kept, "id")
