"""Intermediate tables in the folder that all executors share."""

from __future__ import annotations

import gc
import uuid

from pyspark.sql import DataFrame, SparkSession

from cartloom.session import ensure_checkpoint_dir


def shared_folder(spark: SparkSession) -> str:
    """The folder the cluster names in `spark.checkpoint.dir`; one is set only where none is named."""
    return spark.conf.get("spark.checkpoint.dir", None) or ensure_checkpoint_dir(spark)


def written(df: DataFrame) -> DataFrame:
    """The rows of `df`, written as Parquet to the shared folder and read again.

    Lineage ends there and a lost executor costs nothing. `dropped` removes the files once every step
    that reads them is done; those that a query's result still reads stay until the cluster clears the folder.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark).rstrip('/')}/llm-{uuid.uuid4().hex}"
    df.write.parquet(path)
    # Shuffle files go when the driver's collector finds their plans unused; a job of many steps cannot wait for that.
    gc.collect()
    spark.sparkContext._jvm.System.gc()
    out = spark.read.schema(df.schema).parquet(path)
    out.scratch_path = path
    return out


def dropped(*tables: DataFrame) -> None:
    """Remove the files of tables made by `written`."""
    for df in tables:
        context = df.sparkSession.sparkContext
        path = context._jvm.org.apache.hadoop.fs.Path(df.scratch_path)
        path.getFileSystem(context._jsc.hadoopConfiguration()).delete(path, True)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")
