"""Incremental ingestion: every landed file is loaded once."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from ..schemas import entity_spec
from ..sources.json_batches import load_files
from ..sources.json_scan import listed_files


def ingest_new_files(
    spark: SparkSession,
    entity: str,
    landing_root: str,
    root: str,
    layout: str | None = None,
    max_files_per_batch: int | None = None,
    after_batch: Callable[[int], None] | None = None,
) -> dict[str, int]:
    """Load the files of an entity that no earlier call has seen, then stop.

    The stream carries file names; each micro-batch reads its files in the layout they have. Files that ``load_bronze``
    or ``load_run`` put into bronze are left out by the ledger as well. A micro-batch that is replayed after a
    failure keeps its id and overwrites its own bronze folder, so no row is loaded twice.
    ``max_files_per_batch`` bounds a backlog; ``after_batch`` runs once a batch is in bronze.
    """
    entity_spec(entity)
    reader = spark.readStream
    if max_files_per_batch:
        reader = reader.option("maxFilesPerTrigger", max_files_per_batch)
    files = listed_files(reader, f"{landing_root}/raw/{entity}")
    totals = {"parsed": 0, "loaded": 0, "rejected": 0}

    def load(batch: DataFrame, batch_id: int) -> None:
        name = f"{batch_id:012d}"
        counts = load_files(spark, batch, entity, root, name, layout)
        for count in totals:
            totals[count] += counts[count]
        if after_batch:
            after_batch(batch_id)

    query = (
        files.writeStream.foreachBatch(load)
        .option("checkpointLocation", f"{root}/checkpoints/{entity}")
        .trigger(availableNow=True)
        .start()
    )
    query.awaitTermination()
    return totals
