"""Publishing results under the names other steps read."""

from __future__ import annotations

from collections.abc import Iterable, Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.types import StructType

from .generations import Generations

NAMESPACES = ("raw", "staging", "marts")


def ensure_namespaces(spark: SparkSession) -> None:
    for name in NAMESPACES:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {name}")


def publish_table(df: DataFrame, name: str, root: str) -> None:
    """Fully rebuild table ``name``, swapping it in only once it is completely written.

    Every rebuild goes to a folder of its own below ``root``; the catalog entry is pointed at
    it last. A failed rebuild leaves the previous table, and ``df`` may read that table. The
    replaced build stays for readers already planned on it; builds before it are deleted.
    """
    spark = df.sparkSession
    builds = Generations(spark, f"{root}/{name.replace('.', '/')}")
    commit = builds.last()
    generation = commit[0] + 1 if commit else 1
    location = builds.path(generation)
    df.write.mode("overwrite").parquet(location)
    builds.commit(generation, 0)
    if spark.catalog.tableExists(name) and spark.table(name).dtypes == df.dtypes:
        spark.sql(f"ALTER TABLE {name} SET LOCATION '{location}'")
        spark.catalog.refreshTable(name)
    else:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        spark.catalog.createTable(name, path=location, source="parquet", schema=df.schema)
    builds.drop_before(generation - 1)


def publish_partitions(
    spark: SparkSession, name: str, schema: StructType, by: str, folders: Mapping[str, str], changed: Iterable[str], root: str
) -> None:
    """Table ``name`` over one folder per value of ``by``; only the changed values are pointed at new folders."""
    known = spark.catalog.tableExists(name) and {c.name for c in spark.catalog.listColumns(name) if c.isPartition} == {by}
    if not known:
        spark.sql(f"DROP TABLE IF EXISTS {name}")
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in schema.fields)
        location = f"{root}/{name.replace('.', '/')}_by_{by}"
        spark.sql(f"CREATE TABLE {name} ({columns}, `{by}` string) USING parquet PARTITIONED BY (`{by}`) LOCATION '{location}'")
        changed = folders
    for value in changed:
        spark.sql(f"ALTER TABLE {name} DROP IF EXISTS PARTITION (`{by}` = '{value}')")
        spark.sql(f"ALTER TABLE {name} ADD PARTITION (`{by}` = '{value}') LOCATION '{folders[value]}'")
    spark.catalog.refreshTable(name)


def attach_table(spark: SparkSession, name: str, root: str) -> None:
    """Register the last committed build of ``name`` in a session whose catalog does not know it."""
    builds = Generations(spark, f"{root}/{name.replace('.', '/')}")
    commit = builds.last()
    if commit and not spark.catalog.tableExists(name):
        spark.catalog.createTable(name, path=builds.path(commit[0]), source="parquet")


def publish_view(df: DataFrame, name: str) -> None:
    """Lazy result: evaluated by each reader, optimised together with the reader's query."""
    df.createOrReplaceTempView(name)
