"""Type-2 history on plain Parquet.

Each run writes one generation: ``state=open`` holds all current versions, ``state=closed``
only those closed by that run. The history as of generation N is the closed rows of every
generation up to N plus the open rows of N, which is a partition filter. Closing and inserting
become visible together, with the commit of the generation.
"""

from __future__ import annotations

from datetime import datetime, timezone

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.scd2 import SYSTEM_COLUMNS, advance_open, first_versions
from ..schemas import HistorySpec
from .generations import Generations


class SnapshotStore:
    def __init__(self, spark: SparkSession, root: str, spec: HistorySpec):
        self.spark = spark
        self.spec = spec
        self.generations = Generations(spark, root)

    def read(self, state: str | None = None) -> DataFrame | None:
        """Committed history, or only its ``open`` part; None before the first run."""
        commit = self.generations.last()
        if commit is None:
            return None
        generation = F.lit(commit[0])
        stored = self.spark.read.parquet(self.generations.root)
        is_open = (F.col("state") == "open") & (F.col("gen") == generation)
        is_closed = (F.col("state") == "closed") & (F.col("gen") <= generation)
        wanted = is_open if state == "open" else (is_open | is_closed)
        return stored.filter(wanted).drop("gen", "state")

    def advance(self, batch: DataFrame, now: datetime, hard_deletes: bool = True) -> int:
        """Record one run over ``batch`` (unique per key) and return its generation."""
        if now.tzinfo is None:
            raise ValueError("now must carry a time zone")
        utc = now.astimezone(timezone.utc)
        micros = int(utc.timestamp()) * 1_000_000 + utc.microsecond
        commit = self.generations.last()
        if commit and micros < commit[1]:
            raise ValueError("a run cannot be older than the last committed one")

        instant = F.lit(f"{utc:%Y-%m-%d %H:%M:%S.%f}+00:00").cast(T.TimestampType())
        tracked = batch.select(*self.spec.columns)
        if commit is None:
            rows = first_versions(tracked, self.spec.key, instant)
        else:
            rows = advance_open(
                self.read("open"), tracked, self.spec.key, self.spec.check_cols, instant, hard_deletes
            )
        generation = commit[0] + 1 if commit else 1
        state = F.when(F.col("valid_to").isNull(), F.lit("open")).otherwise(F.lit("closed"))
        (
            rows.select(*self.spec.columns, *SYSTEM_COLUMNS)
            .withColumn("state", state)
            .write.mode("overwrite")
            .partitionBy("state")
            .parquet(self.generations.path(generation))
        )
        self.generations.commit(generation, micros)
        # The previous open rows stay for readers that already planned on them.
        self.generations.drop_before(generation - 1, within="state=open")
        return generation
