"""Latest bronze row per key, kept up to date by merging only newly ingested batches.

Rebuilding from all of bronze costs more every day; this costs one row per key plus what
arrived. Both give the same rows, because keeping the latest is associative.
"""

from __future__ import annotations

import json
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..operators.dedup import bronze_order, latest_per_key
from ..schemas import BRONZE
from .generations import Generations
from .json_batches import bronze_batches, committed_batches


class MergedBatches:
    """The batch names that a committed generation holds, kept beside it."""

    def __init__(self, generations: Generations):
        self.generations = generations

    def _path(self, generation: int) -> str:
        return f"{self.generations.root}/_merged/{generation:06d}.json"

    def read(self) -> set[str]:
        commit = self.generations.last()
        if commit is None:
            return set()
        found = self.generations.spark.read.text(self._path(commit[0])).collect()
        return set(json.loads(found[0]["value"]))

    def write(self, generation: int, batches: set[str]) -> None:
        self.generations.put(self._path(generation), json.dumps(sorted(batches)))


class LatestStore:
    def __init__(self, spark: SparkSession, root: str, entity: str, keys: Sequence[str]):
        self.spark = spark
        self.root = root
        self.entity = entity
        self.keys = list(keys)
        self.generations = Generations(spark, f"{root}/latest/{entity}")
        self.merged = MergedBatches(self.generations)

    def read(self) -> DataFrame | None:
        commit = self.generations.last()
        if commit is None:
            return None
        schema = BRONZE[self.entity]
        return self.spark.read.schema(schema).parquet(self.generations.path(commit[0]))

    def advance(self) -> DataFrame:
        """Merge the complete batches that no earlier call merged; returns the result.

        The commit names the batches it holds, so they may have any name and become complete in any order. One
        that failed half-way is merged after its replay.
        """
        done, _ = committed_batches(self.spark, self.entity, self.root)
        merged = self.merged.read()
        new = sorted(set(done) - merged)
        commit = self.generations.last()
        if commit and not new:
            return self.read()
        arrived = bronze_batches(self.spark, self.entity, self.root).filter(F.col("batch").isin(*new))
        rows = arrived.select(*BRONZE[self.entity].fieldNames())
        known = self.read()
        if known is not None:
            rows = known.unionByName(rows)
        generation = commit[0] + 1 if commit else 1
        latest = latest_per_key(rows, self.keys, bronze_order())
        latest.write.mode("overwrite").parquet(self.generations.path(generation))
        self.merged.write(generation, merged | set(new))
        self.generations.commit(generation, len(merged) + len(new) - 1)
        self.generations.drop_before(generation - 1)
        return self.read()
