"""Data checks. Each yields rows ``(check_name, failing)``; zero means passed."""

from __future__ import annotations

from collections.abc import Iterable, Mapping, Sequence
from functools import reduce

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .asof import _bucket


class CheckFailed(RuntimeError):
    """Raised with every failing check of a run."""

    def __init__(self, failures: dict[str, int]):
        self.failures = failures
        listed = ", ".join(f"{name}: {count}" for name, count in sorted(failures.items()))
        super().__init__(f"failed checks: {listed}")


def _named(df: DataFrame, name: str, failing) -> DataFrame:
    return df.agg(F.coalesce(failing, F.lit(0)).cast("bigint").alias("failing")).select(
        F.lit(name).alias("check_name"), "failing"
    )


def check_not_null(df: DataFrame, columns: Sequence[str], prefix: str = "") -> DataFrame:
    """NULL rows of every column, counted in one scan of just those columns."""
    counts = df.agg(*[F.count_if(F.col(c).isNull()).alias(c) for c in columns])
    rows = [
        F.struct(F.lit(f"{prefix}{c} not_null").alias("check_name"), F.col(c).alias("failing"))
        for c in columns
    ]
    return counts.select(F.inline(F.array(*rows)))


def check_fields(df: DataFrame, record: str, names: Sequence[str], prefix: str = "") -> DataFrame:
    """Records of a VARIANT column that lack a member."""
    missing = [
        F.count_if(F.try_variant_get(record, f"$.{n}", "variant").isNull()).alias(n) for n in names
    ]
    rows = [
        F.struct(F.lit(f"{prefix}{n} present").alias("check_name"), F.col(n).alias("failing"))
        for n in names
    ]
    return df.agg(*missing).select(F.inline(F.array(*rows)))


def check_unique(df: DataFrame, columns: Sequence[str], name: str) -> DataFrame:
    """Number of key values that occur more than once (NULL keys are not compared)."""
    complete = reduce(lambda a, b: a & b, [F.col(c).isNotNull() for c in columns])
    repeated = df.filter(complete).groupBy(*columns).count().filter(F.col("count") > 1)
    return _named(repeated, name, F.count("*"))


def check_fk(
    child: DataFrame, child_key: str, parent: DataFrame, parent_key: str, name: str
) -> DataFrame:
    """Child rows whose non-NULL key has no parent.

    Both sides are reduced to distinct keys before the anti join, so a hot key crosses it as a single row.
    """
    keys = (
        child.filter(F.col(child_key).isNotNull())
        .groupBy(F.col(child_key).alias("__child"))
        .agg(F.count("*").alias("__rows"))
    )
    parents = parent.select(F.col(parent_key).alias("__parent")).distinct()
    orphans = keys.join(parents, F.col("__child") == F.col("__parent"), "left_anti")
    return _named(orphans, name, F.sum("__rows"))


def check_accepted(df: DataFrame, column: str, values: Sequence, name: str) -> DataFrame:
    """Rows whose non-NULL value is outside the list."""
    return _named(df.filter(~F.col(column).isin(list(values))), name, F.count("*"))


def check_no_overlap(
    dim: DataFrame,
    key: str,
    name: str,
    start: str = "effective_from",
    end: str = "effective_to",
    bucket_days: int = 30,
) -> DataFrame:
    """Versions that are still valid when the next version of their key starts.

    Neighbours are found inside (key, bucket of the start) first; only the outermost rows of
    each bucket then meet per key. No window ever holds all versions of a key.
    """
    versions = dim.filter(F.col(start).isNotNull()).select(
        F.col(key).alias("__key"),
        F.col(start).alias("__from"),
        F.col(end).alias("__to"),
        _bucket(F.col(start), bucket_days).alias("__bucket"),
    )
    in_bucket = Window.partitionBy("__key", "__bucket").orderBy(
        "__from", F.col("__to").asc_nulls_last()
    )
    overlaps = F.col("__next").isNotNull() & (
        F.col("__to").isNull() | (F.col("__next") < F.col("__to"))
    )
    buckets = (
        versions.withColumn("__next", F.lead("__from").over(in_bucket))
        .withColumn("__last", F.col("__next").isNull())
        .groupBy("__key", "__bucket")
        .agg(
            F.count_if(overlaps).alias("__inside"),
            F.min("__from").alias("__first_from"),
            F.bool_or(F.col("__last") & F.col("__to").isNull()).alias("__last_open"),
            F.max(F.when(F.col("__last"), F.col("__to"))).alias("__last_to"),
        )
    )
    across = Window.partitionBy("__key").orderBy("__bucket")
    beyond = buckets.withColumn("__next", F.lead("__first_from").over(across)).withColumn(
        "__edge",
        (
            F.col("__next").isNotNull()
            & (F.col("__last_open") | (F.col("__next") < F.col("__last_to")))
        ).cast("bigint"),
    )
    return _named(beyond, name, F.sum(F.col("__inside") + F.coalesce("__edge", F.lit(0))))


def run_checks(checks: Iterable[DataFrame]) -> dict[str, int]:
    """Run all checks as one job; raise ``CheckFailed`` when any counts a failing row.

    Only one row per check reaches the driver.
    """
    return settle({}, checks)


def settle(known: Mapping[str, int], checks: Iterable[DataFrame]) -> dict[str, int]:
    """As ``run_checks``, with failing rows counted before added to those of the checks."""
    results, checks = dict(known), list(checks)
    if checks:
        for row in reduce(DataFrame.unionAll, checks).collect():
            results[row["check_name"]] = results.get(row["check_name"], 0) + row["failing"]
    failures = {name: count for name, count in results.items() if count}
    if failures:
        raise CheckFailed(failures)
    return results
