"""Rows kept per run, rebuilt only for the runs that new batches touch.

Every advance writes the touched runs to a generation of its own and commits a map from run to the generation that
holds it, so readers of an earlier map keep their files and the history of other runs is neither read nor written.
"""

from __future__ import annotations

import json
from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from ..operators.dedup import bronze_order, latest_per_key
from ..schemas import BRONZE
from .generations import Generations
from .json_batches import bronze_batches, committed_batches
from .latest_store import MergedBatches

RUN = "run_key"


def run_key(run: str) -> Column:
    """Name of a run's folder: a hash, so any run id will do, a missing one too."""
    return F.substring(F.sha2(F.coalesce(F.col(run), F.lit("")).cast("binary"), 256), 1, 32)


class RunStore:
    """Latest bronze row per key and run, and the model of those rows beside them.

    ``model`` must work run by run: the model of all rows is the union of the models of every run's rows. ``run`` is the
    column that names it in bronze, ``shown`` the one in the model.
    """

    def __init__(
        self,
        spark: SparkSession,
        root: str,
        entity: str,
        keys: Sequence[str],
        model: Callable[[DataFrame], DataFrame],
        run: str = "_run_id",
        shown: str = "run_id",
    ):
        self.spark = spark
        self.root = root
        self.entity = entity
        self.keys = [*keys, run]
        self.run, self.shown = run, shown
        self.model = model
        self.generations = Generations(spark, f"{root}/runs/{entity}")
        self.merged = MergedBatches(self.generations)

    def _map_path(self, generation: int) -> str:
        return f"{self.generations.root}/_map/{generation:06d}.json"

    def runs(self, generation: int | None = None) -> dict[str, int]:
        """The generation that holds each run; one entry a run."""
        commit = self.generations.last()
        generation = generation if generation is not None else commit and commit[0]
        if not generation:
            return {}
        return json.loads(self.spark.read.text(self._map_path(generation)).collect()[0]["value"])

    def schema(self) -> T.StructType:
        """Schema of the model."""
        return self.model(self.spark.createDataFrame([], BRONZE[self.entity])).schema

    def paths(self, part: str) -> dict[str, str]:
        """Folder of each run; ``part`` is ``rows`` or ``model``."""
        return {run: f"{self.generations.path(n)}/{part}/{RUN}={run}" for run, n in self.runs().items()}

    def stored(self, runs: Sequence[str]) -> DataFrame:
        schema = BRONZE[self.entity]
        known = self.paths("rows")
        paths = [known[r] for r in runs if r in known]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def advance(self) -> list[str]:
        """Rebuild the runs that batches not merged before touch; returns their keys."""
        done, _ = committed_batches(self.spark, self.entity, self.root)
        merged = self.merged.read()
        new = sorted(set(done) - merged)
        if not new:
            return []
        fields = BRONZE[self.entity].fieldNames()
        arrived = bronze_batches(self.spark, self.entity, self.root).filter(F.col("batch").isin(*new)).select(*fields)
        touched = [row[0] for row in arrived.select(run_key(self.run)).distinct().collect()]  # the runs of the new batches
        known = self.runs()
        commit = self.generations.last()
        generation = commit[0] + 1 if commit else 1
        target = self.generations.path(generation)
        latest = latest_per_key(self.stored(touched).unionByName(arrived), self.keys, bronze_order())
        latest.withColumn(RUN, run_key(self.run)).write.mode("overwrite").partitionBy(RUN).parquet(f"{target}/rows")
        schema = T.StructType([*BRONZE[self.entity].fields, T.StructField(RUN, T.StringType())])
        rows = self.spark.read.schema(schema).parquet(f"{target}/rows") if touched else latest
        staged = self.model(rows.select(*fields))
        staged.withColumn(RUN, run_key(self.shown)).write.mode("overwrite").partitionBy(RUN).parquet(f"{target}/model")
        before = self.runs(commit[0] - 1) if commit and commit[0] > 1 else {}
        now = {**known, **dict.fromkeys(touched, generation)}
        self.generations.put(self._map_path(generation), json.dumps(now))
        self.merged.write(generation, merged | set(new))
        self.generations.commit(generation, len(merged) + len(new) - 1)
        # Readers may still hold the map before this one; folders that only older maps name can go.
        for run, n in before.items():
            if known.get(run) != n and now.get(run) != n:
                for part in ("rows", "model"):
                    self.generations.drop(f"{self.generations.path(n)}/{part}/{RUN}={run}")
        return touched
