"""What every batch of an entity holds: its files, its counts, and the NULLs found while it was written.

Entries lie beside bronze, one folder and one note per batch, so a load looks up file names without reading any row of
bronze. The files of a batch are entered before its rows are written and count once bronze holds the batch complete; the note is
written last, so a batch without one still has to be counted.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .generations import Generations


def unseen_files(listed: DataFrame, ledger: DataFrame, path: str = "path") -> DataFrame:
    """Distinct listed paths that the ledger does not hold."""
    seen = ledger.select(F.col(path).alias("__seen")).distinct()
    found = listed.select(path).distinct()
    return found.join(seen, F.col(path) == F.col("__seen"), "left_anti")


class BatchLedger:
    def __init__(self, spark: SparkSession, root: str, entity: str):
        self.spark = spark
        self.path = f"{root}/ledger/{entity}"
        self.folders = Generations(spark, self.path)

    def enter(self, batch: str, files: Sequence[str]) -> None:
        rows = self.spark.createDataFrame([(f,) for f in files], "_file string")
        rows.coalesce(1 + len(files) // 100_000).write.mode("overwrite").parquet(f"{self.path}/files/batch={batch}")

    def batches(self) -> set[str]:
        """Batches whose files are entered to the end, complete in bronze or not."""
        names = [n for n in self.folders.children(f"{self.path}/files") if n.startswith("batch=")]
        return {n.removeprefix("batch=") for n in names if "_SUCCESS" in self.folders.children(f"{self.path}/files/{n}")}

    def files(self) -> DataFrame:
        """``(_file, batch)`` of all entries."""
        schema = "_file string, batch string"
        if not self.batches():
            return self.spark.createDataFrame([], schema)
        return self.spark.read.schema(schema).parquet(f"{self.path}/files")

    def note(self, batch: str, counts: dict[str, int], nulls: dict[str, int]) -> None:
        """Keep the counts of a complete batch; a later note of the same batch replaces it."""
        self.folders.put(f"{self.path}/notes/{batch}.json", json.dumps({"batch": batch, "counts": counts, "nulls": nulls}))

    def notes(self) -> dict[str, dict]:
        """Notes by batch; they are as many as batches and a few hundred bytes each."""
        names = self.folders.children(f"{self.path}/notes")
        if not any(n.endswith(".json") for n in names):
            return {}
        rows = self.spark.read.text(f"{self.path}/notes").collect()
        return {note["batch"]: note for note in (json.loads(row["value"]) for row in rows if row["value"].strip())}
