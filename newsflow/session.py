"""Session settings the operators rely on, and the shared folder for cut lineage."""

from __future__ import annotations

import gc
import tempfile
import uuid

from pyspark.sql import DataFrame, SparkSession

_CHECKPOINT_KEY = "spark.checkpoint.dir"


def configure(spark: SparkSession) -> SparkSession:
    """Runtime settings that the operators rely on: UTC wall clocks, adaptive plans, and Arrow batches that stay small
    when pages, texts or answers are long, so that a task's Python holds a batch and not a partition."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(8 << 20))
    return spark


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach.

    The cluster names it in ``spark.checkpoint.dir``. Only a local session without one falls back
    to a folder of this machine.
    """
    folder = spark.conf.get(_CHECKPOINT_KEY, None)
    if folder:
        return folder.rstrip("/")
    if not spark.sparkContext.master.startswith("local"):
        raise RuntimeError(f"set {_CHECKPOINT_KEY} to a folder shared by all executors")
    folder = tempfile.mkdtemp(prefix="newsflow-")
    spark.conf.set(_CHECKPOINT_KEY, folder)
    return folder


def fresh_path(spark: SparkSession, name: str) -> str:
    """A new, never used path below the shared folder."""
    return f"{shared_dir(spark)}/{name}-{uuid.uuid4().hex}"


def written(df: DataFrame, name: str) -> DataFrame:
    """``df`` written once as Parquet below the shared folder, and read back.

    For results of outside calls, or of work that several later steps read: nothing before this
    point runs again when an executor is lost, and each reader takes only its columns.
    """
    path = fresh_path(df.sparkSession, name)
    df.write.parquet(path)
    return df.sparkSession.read.schema(df.schema).parquet(path)


def release(spark: SparkSession) -> None:
    """Has the driver drop plans that nothing refers to any more. Executors keep shuffle files until then, so a job of many
    written steps would hold those of all its steps at once."""
    gc.collect()
    spark.sparkContext._jvm.System.gc()
