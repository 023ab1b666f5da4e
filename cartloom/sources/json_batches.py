"""Landing and scanning JSON batches, and the append-only bronze tables."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from datetime import datetime, timezone

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..functions.dates import landing_key
from ..operators.bronze import RECORD, REJECTED, bind_entity
from ..schemas import BRONZE, REQUIRED_COLUMNS, entity_spec
from .generations import Generations
from .json_scan import listed_files, scan_files
from .ledger import BatchLedger, unseen_files

_WRITE_OPTIONS = {
    "ignoreNullFields": "false",
    "timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX",
}


def read_json_batch(spark: SparkSession, paths: str | Sequence[str], layout: str | None = None) -> DataFrame:
    """Scan a landing prefix, one named batch, or a list of either, each file in the layout it has (see ``scan_files``)."""
    files = [row["_file"] for row in listed_files(spark.read, paths).collect()]
    return scan_files(spark, files, layout)


def land_json(df: DataFrame, entity: str, root: str, now: datetime) -> str:
    """Write one batch below ``root`` and return its location.

    The location is a folder named after the entity and the UTC second, holding one part file
    per task in JSON lines. An empty batch still leaves its (empty) file. A second batch in the
    same second adds part files instead of replacing the first.
    """
    if now.tzinfo is None:
        raise ValueError("now must carry a time zone")
    location = f"{root}/{landing_key(entity, now.astimezone(timezone.utc))}"
    df.write.mode("append").options(**_WRITE_OPTIONS).json(location)
    return location


def bronze_path(root: str, entity: str) -> str:
    return f"{root}/bronze/{entity_spec(entity).name}"


def write_bronze(bound: DataFrame, entity: str, root: str, batch: str) -> dict[str, int]:
    """Append one bound batch and return its parsed, loaded and rejected counts.

    Good rows and rejects leave in one write, split by partition, and the counts ride along on
    the same job, with the NULLs of the required columns; all are kept beside the batch once it is complete.
    The batch has its own folder, which a retry overwrites instead of appending.
    """
    metrics = Observation()
    required = REQUIRED_COLUMNS.get(entity_spec(entity).name, ())
    counted = bound.observe(
        metrics,
        F.count("*").alias("parsed"),
        F.count_if(~F.col(REJECTED)).alias("loaded"),
        F.count_if(F.col(REJECTED)).alias("rejected"),
        *[F.count_if(~F.col(REJECTED) & F.col(c).isNull()).alias(f"null {c}") for c in required],
    )
    (
        counted.withColumnRenamed(REJECTED, "rejected")
        .write.mode("overwrite")
        .partitionBy("rejected")
        .parquet(f"{bronze_path(root, entity)}/batch={batch}")
    )
    found = {name: int(value or 0) for name, value in metrics.get.items()}
    counts = {name: found.pop(name) for name in ("parsed", "loaded", "rejected")}
    nulls = {name.removeprefix("null "): value for name, value in found.items()}
    BatchLedger(bound.sparkSession, root, entity).note(batch, counts, nulls)
    return counts


def _stored_bronze(spark: SparkSession, entity: str, root: str) -> DataFrame:
    schema = T.StructType(
        [
            *BRONZE[entity_spec(entity).name].fields,
            T.StructField(RECORD, T.VariantType()),
            T.StructField("batch", T.StringType()),
            T.StructField("rejected", T.BooleanType()),
        ]
    )
    if not Generations(spark, bronze_path(root, entity)).children(bronze_path(root, entity)):
        return spark.createDataFrame([], schema)
    return spark.read.schema(schema).parquet(bronze_path(root, entity))


def committed_batches(spark: SparkSession, entity: str, root: str) -> tuple[list[str], list[str]]:
    """Batch ids in bronze: those written to the end, and those a lost writer left half-way."""
    path = bronze_path(root, entity)
    folders = Generations(spark, path)
    names = [n for n in folders.children(path) if n.startswith("batch=")]
    done = {n for n in names if "_SUCCESS" in folders.children(f"{path}/{n}")}
    ids = lambda some: sorted(n.removeprefix("batch=") for n in some)
    return ids(done), ids(set(names) - done)


def not_loaded(files: DataFrame, entity: str, root: str, batch: str) -> DataFrame:
    """``_file`` of the listed files that no other complete batch holds; read from the ledger, never from bronze rows.

    Only batches written before there was a ledger are looked up in bronze.
    """
    spark = files.sparkSession
    done, _ = committed_batches(spark, entity, root)
    others = set(done) - {batch}
    ledger = BatchLedger(spark, root, entity)
    seen = ledger.files().filter(F.col("batch").isin(*others)) if len(others) < 1000 else ledger.files()
    listed = ledger.batches()
    stale = listed - others
    if len(others) >= 1000 and stale:
        seen = seen.filter(~F.col("batch").isin(*stale))
    seen = seen.select("_file")
    older = others - listed
    if older:
        rows = _stored_bronze(spark, entity, root).filter(F.col("batch").isin(*older))
        seen = seen.unionByName(rows.select("_file"))
    return unseen_files(files, seen, "_file")


def bronze_batches(spark: SparkSession, entity: str, root: str) -> DataFrame:
    """Loaded rows with the batch they came in; filters on ``batch`` prune folders."""
    stored = _stored_bronze(spark, entity, root).filter("NOT rejected")
    return stored.select(*BRONZE[entity].fieldNames(), "batch")


def read_bronze(spark: SparkSession, entity: str, root: str, rejects: bool = False) -> DataFrame:
    """Loaded rows of every batch, or the rejected ones with their record and batch."""
    if rejects:
        stored = _stored_bronze(spark, entity, root).filter("rejected")
        return stored.select("_file", "_row_tag", RECORD, "batch")
    return bronze_batches(spark, entity, root).drop("batch")


def load_files(
    spark: SparkSession, files: DataFrame, entity: str, root: str, batch: str, layout: str | None = None, force: bool = False
) -> dict[str, int]:
    """Load listed files as one batch, those left out that another complete batch holds.

    The ledger names the batch's files first; the entry counts once the batch is complete.
    """
    spec = entity_spec(entity)
    fresh = files.distinct() if force else not_loaded(files, entity, root, batch)
    names = [row["_file"] for row in fresh.collect()]  # file names, which the reader lists on the driver anyway
    BatchLedger(spark, root, entity).enter(batch, names)
    return write_bronze(bind_entity(scan_files(spark, names, layout), spec), entity, root, batch)


def load_bronze(
    spark: SparkSession,
    entity: str,
    path: str | Sequence[str],
    root: str,
    batch: str,
    layout: str | None = None,
    force: bool = False,
) -> dict[str, int]:
    """Load named landed files into bronze under batch id ``batch``, each in the layout it has.

    Files that another batch holds are left out, whichever way they were loaded, unless ``force`` is given.
    """
    entity_spec(entity)
    return load_files(spark, listed_files(spark.read, path), entity, root, batch, layout, force)


def load_run(
    spark: SparkSession, locations: Mapping[str, str], root: str, run_id: str, layout: str | None = None
) -> dict[str, dict[str, int]]:
    """Load the batch of every entity of one run; loading the same run again changes nothing."""
    for entity in locations:
        entity_spec(entity)
    return {
        entity: load_bronze(spark, entity, location, root, run_id, layout)
        for entity, location in locations.items()
    }
