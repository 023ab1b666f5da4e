"""Session settings and lineage cutting shared by every job."""

from __future__ import annotations

import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

# Applied to every session this package opens. Shuffle partition counts are left to the
# cluster (AQE coalesces them); only the local helper pins a small number.
ENGINE_CONF = {
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.ansi.enabled": "true",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Recording the Python call site of every column about doubles the time to build a plan.
    "spark.sql.dataFrameQueryContext.enabled": "false",
    "spark.python.sql.dataFrameDebugging.enabled": "false",
}


def build_session(app: str = "cartloom", master: str | None = None, **conf: str) -> SparkSession:
    """Open (or reuse) a session; on a cluster leave ``master`` to spark-submit."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for name, value in {**ENGINE_CONF, **conf}.items():
        builder = builder.config(name, value)
    return builder.getOrCreate()


def sized_for(shuffle_bytes: int, cores: int, target_bytes: int = 200 << 20) -> dict[str, str]:
    """Partition settings for a cluster job whose largest shuffle moves ``shuffle_bytes``.

    Shuffles start with partitions of about ``target_bytes`` (never fewer than two per core)
    and AQE merges the small ones; scans are cut to the same size.
    """
    partitions = max(2 * cores, -(-shuffle_bytes // target_bytes))
    return {
        "spark.sql.shuffle.partitions": str(partitions),
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": str(target_bytes),
        "spark.sql.files.maxPartitionBytes": str(target_bytes),
    }


def local_session(cores: int = 8, app: str = "cartloom-local", **conf: str) -> SparkSession:
    """Single-JVM session for tests and the benchmark."""
    settings = {
        "spark.ui.enabled": "false",
        "spark.driver.memory": "12g",
        "spark.sql.shuffle.partitions": str(cores),
        **conf,
    }
    spark = build_session(app, f"local[{cores}]", **settings)
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def ensure_checkpoint_dir(spark: SparkSession) -> str:
    """Return the shared checkpoint folder, setting one only where none is configured.

    A cluster must name the folder in ``spark.checkpoint.dir``; only a local master may
    fall back to a temporary folder.
    """
    context = spark.sparkContext
    current = context.getCheckpointDir()
    if current:
        return current
    folder = context.getConf().get("spark.checkpoint.dir")
    if not folder:
        if context.master != "local" and not context.master.startswith("local["):
            raise RuntimeError("set spark.checkpoint.dir to a folder every executor can reach")
        folder = tempfile.mkdtemp(prefix="cartloom-checkpoint-")
    context.setCheckpointDir(folder)
    return folder


def kept(df: DataFrame) -> DataFrame:
    """``df`` written as Parquet to a new folder in the shared checkpoint folder, and read from there.

    Work that several steps need is done once. The files stay until the checkpoint folder is cleared, as those of ``cut_lineage``.
    """
    path = f"{ensure_checkpoint_dir(df.sparkSession).rstrip('/')}/kept-{uuid.uuid4().hex}"
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def cut_lineage(df: DataFrame) -> DataFrame:
    """Materialise ``df`` in the shared checkpoint folder and forget how it was made."""
    ensure_checkpoint_dir(df.sparkSession)
    return df.checkpoint()
