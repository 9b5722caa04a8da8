"""Parquet tables with appends that survive replays, and upserts by merge on read.

Layout below a table's root: ``base/v=<n>`` full versions, ``delta/batch_id=<id>`` changed rows of
one micro-batch each, ``versions`` one row per published version. A batch that runs twice rewrites
its own folder; a version counts only once its row is in ``versions``.
"""

from __future__ import annotations

from collections.abc import Sequence
from datetime import datetime, timezone

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.operators.keyed import upsert

_BATCH = T.StructType([T.StructField("batch_id", T.LongType())])
_VERSION = T.StructType([T.StructField("version", T.LongType()), T.StructField("upto_batch", T.LongType())])


def write_batch(rows: DataFrame, root: str, batch_id: int, partition_by: Sequence[str] = ()) -> None:
    """Write the rows of one micro-batch, replacing what an earlier try of it left."""
    rows.write.mode("overwrite").parquet(f"{root}/delta/batch_id={batch_id}", partitionBy=list(partition_by) or None)


def read_or_empty(spark: SparkSession, path: str, schema: T.StructType) -> DataFrame:
    """Rows at ``path``, or an empty frame when nothing is there yet."""
    try:
        return spark.read.schema(schema).parquet(path)
    except AnalysisException as error:
        if error.getCondition() != "PATH_NOT_FOUND":
            raise
        return spark.createDataFrame([], schema)


def _published(spark: SparkSession, root: str) -> tuple[int, int]:
    """Newest version and the last batch inside it; (-1, -1) before the first."""
    last = read_or_empty(spark, f"{root}/versions", _VERSION).agg(
        F.max("version").alias("v"), F.max_by("upto_batch", "version").alias("b")
    ).first()
    return (-1, -1) if last["v"] is None else (last["v"], last["b"])


def _delta(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    return read_or_empty(spark, f"{root}/delta", T.StructType(schema.fields + _BATCH.fields))


def last_batch(spark: SparkSession, root: str) -> int:
    """Number of the newest batch, -1 before the first."""
    last = read_or_empty(spark, f"{root}/delta", _BATCH).agg(F.max("batch_id")).first()[0]
    return max(_published(spark, root)[1], -1 if last is None else last)


def read_batch(spark: SparkSession, root: str, batch_id: int, schema: T.StructType) -> DataFrame:
    """The stored rows of one micro-batch."""
    return read_or_empty(spark, f"{root}/delta/batch_id={batch_id}", schema)


def read_appended(spark: SparkSession, root: str, schema: T.StructType, before: int | None = None) -> DataFrame:
    """All rows of an append-only table, or those of the batches before one."""
    return read_current(spark, root, schema, keys=None, before=before)


def read_current(spark: SparkSession, root: str, schema: T.StructType, keys: list[str] | None,
                 before: int | None = None) -> DataFrame:
    """The table's rows now: the newest version with later batches merged over it by key.

    The later batches are small next to the version, so the version is not shuffled: adaptive
    execution broadcasts their keys when their measured size allows it.
    """
    version, upto = _published(spark, root)
    delta = _delta(spark, root, schema).where(F.col("batch_id") > upto)
    if before is not None:
        delta = delta.where(F.col("batch_id") < before)
    names = [f"`{n}`" for n in schema.fieldNames()]
    base = (
        spark.createDataFrame([], schema)
        if version < 0
        else read_or_empty(spark, f"{root}/base/v={version}", schema).select(names)
    )
    if keys is None:
        return base.unionByName(delta.select(names))
    return upsert(base, delta, keys, ["batch_id"])


def publish(rows: DataFrame, root: str, upto_batch: int, partition_by: Sequence[str] = ()) -> int:
    """Make ``rows`` the table's next version, covering all batches up to ``upto_batch``."""
    spark = rows.sparkSession
    version = _published(spark, root)[0] + 1
    rows.write.mode("overwrite").parquet(f"{root}/base/v={version}", partitionBy=list(partition_by) or None)
    spark.createDataFrame([(version, upto_batch)], _VERSION).coalesce(1).write.mode("append").parquet(
        f"{root}/versions"
    )
    return version


def compact(spark: SparkSession, root: str, schema: T.StructType, keys: list[str] | None) -> int:
    """Fold the batches so far into a new version. Run it while no batch is being written."""
    return publish(read_current(spark, root, schema, keys), root, last_batch(spark, root))


def drop_replaced(spark: SparkSession, root: str) -> None:
    """Delete the batches and versions that the newest version covers. Run it while nobody reads the table."""
    version, upto = _published(spark, root)
    hadoop = spark._jvm.org.apache.hadoop.fs
    for folder, name, last in ((f"{root}/base", "v=", version - 1), (f"{root}/delta", "batch_id=", upto)):
        at = hadoop.Path(folder)
        files = at.getFileSystem(spark._jsc.hadoopConfiguration())
        for entry in files.listStatus(at) if files.exists(at) else []:
            label = entry.getPath().getName()
            if label.startswith(name) and int(label.removeprefix(name)) <= last:
                files.delete(entry.getPath(), True)


def create_table(spark: SparkSession, root: str, schema: T.StructType, replace: bool = False) -> None:
    """Publish an empty first version. An existing table is kept unless ``replace``."""
    if replace or _published(spark, root)[0] < 0:
        publish(spark.createDataFrame([], schema), root, last_batch(spark, root))


def backup(rows: DataFrame, folder: str, start_ms: int, end_ms: int) -> str:
    """Write rows under a name made of their date range; an existing backup is never overwritten."""
    label = [datetime.fromtimestamp(ms / 1000, timezone.utc).strftime("%Y%m%d") for ms in (start_ms, end_ms)]
    path = f"{folder}/backup_{label[0]}_{label[1]}"
    rows.write.mode("errorifexists").parquet(path)
    return path


def with_memory_defaults(rows: DataFrame) -> DataFrame:
    """Embedded news in the memory shape, unsettled and with zero win rate and return."""
    return rows.select(
        F.col("id").cast("string").alias("event_id"),
        "title",
        F.col("sentiment_score").cast("bigint").alias("sentiment_score"),
        "rsi_14",
        "atr_14",
        "price_at_t",
        F.col("pubDate").alias("pub_date"),
        "sentiment_es",
        F.col("vector").cast("array<float>").alias("vector"),
        F.lit(False).alias("is_settled"),
        F.lit(0.0).alias("win_rate"),
        F.lit(0.0).alias("return"),
    )
