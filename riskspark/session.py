"""Session set-up and the shared scratch folder that jobs write intermediate tables to."""

from __future__ import annotations

import os
import tempfile
import uuid
import zipfile
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession

_SHIPPED: set[str] = set()


def local_session(cores: str | int = "*", **conf: str) -> SparkSession:
    """A local session for tests and benchmarks; clusters bring their own."""
    builder = (
        SparkSession.builder.master(f"local[{cores}]")
        .appName("riskspark")
        .config("spark.sql.shuffle.partitions", "8")
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.driver.memory", os.environ.get("RISKSPARK_DRIVER_MEMORY", "12g"))
        .config("spark.ui.enabled", "false")
        .config("spark.sql.execution.arrow.pyspark.enabled", "true")
        .config("spark.python.sql.dataFrameDebugging.enabled", "false")
    )
    for key, value in conf.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def shared_dir(spark: SparkSession) -> str:
    """The folder all executors can reach, as the cluster names it.

    A local session without one (tests) gets a temporary folder, since its only
    executor runs on this machine; on any other master that is an error.
    """
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        context = spark.sparkContext
        if context.getCheckpointDir() is None:
            master = context.master
            if master != "local" and not master.startswith("local["):
                raise RuntimeError("set spark.checkpoint.dir to a folder that all executors reach")
            context.setCheckpointDir(tempfile.mkdtemp(prefix="riskspark-"))
        folder = context.getCheckpointDir()
    return folder.rstrip("/")


def ship_package(spark: SparkSession) -> None:
    """Make this package importable in the Python workers of a session's executors.

    Does nothing the second time, and is not needed when the package is
    installed there or was submitted with the job.
    """
    context = spark.sparkContext
    if context.applicationId in _SHIPPED:
        return
    root = Path(__file__).resolve().parent
    archive = Path(tempfile.mkdtemp(prefix="riskspark-package-")) / f"{root.name}.zip"
    with zipfile.ZipFile(archive, "w") as packed:
        for source in sorted(root.rglob("*.py")):
            packed.write(source, source.relative_to(root.parent))
    context.addPyFile(str(archive))
    _SHIPPED.add(context.applicationId)


def _scratch_dir(spark: SparkSession) -> str:
    return f"{shared_dir(spark)}/riskspark/{spark.sparkContext.applicationId}"


def scratch_path(spark: SparkSession, name: str) -> str:
    """A new place in the shared folder, below a folder of this application."""
    return f"{_scratch_dir(spark)}/{name}-{uuid.uuid4().hex}"


def remove_scratch(spark: SparkSession) -> None:
    """Delete all that this application wrote to its scratch places.

    For the end of a job, when no result that reads from them is needed any more.
    """
    jvm = spark.sparkContext._jvm
    path = jvm.org.apache.hadoop.fs.Path(_scratch_dir(spark))
    files = path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration())
    files.delete(path, True)


def materialize(df: DataFrame, name: str, partition_by: list[str] | None = None) -> DataFrame:
    """Write ``df`` to the shared folder and read it back.

    Cuts the lineage in a way that outlives lost executors, freezes values
    that would differ on recomputation, and keeps column pruning.
    """
    path = scratch_path(df.sparkSession, name)
    writer = df.write
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    writer.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def spread_by(df: DataFrame, key: str) -> DataFrame:
    """Partition by ``key`` into the configured number of partitions.

    For work that multiplies rows: coalescing by the size of what comes in
    would leave too few tasks for what goes out.
    """
    return df.repartition(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), key)


def checkpointed(df: DataFrame) -> DataFrame:
    """Reliable checkpoint: cuts lineage and keeps partitions and their row order."""
    context = df.sparkSession.sparkContext
    if context.getCheckpointDir() is None:
        context.setCheckpointDir(shared_dir(df.sparkSession))
    return df.checkpoint()
