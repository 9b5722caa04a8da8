"""Message sinks: JSON values, keys, partition choice, and the writer options for a broker."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter

from newsflow.config import JobConfig
from newsflow.session import written


def to_json_value(rows: DataFrame, key: str | None = None) -> DataFrame:
    """One JSON text per row (null fields are left out), with an optional key."""
    value = F.to_json(F.struct(*[F.col(f"`{c}`") for c in rows.columns])).alias("value")
    return rows.select(value) if key is None else rows.select(F.col(key).cast("string").alias("key"), value)


def round_robin(rows: DataFrame, partitions: int) -> DataFrame:
    """Even spread over ``partitions`` whatever the values are."""
    return rows.repartition(partitions)


def keyed_order(rows: DataFrame, key: str, order: list[str], partitions: int) -> DataFrame:
    """Rows sorted by key and order over all partitions.

    The ranges are cut by volume: a key with very many rows lies in several neighbouring partitions
    instead of overloading one. These partitions are sent side by side, so a receiver that needs such a key in
    order goes by the numbers of ``numbered``.
    """
    return rows.repartitionByRange(partitions, key, *order).sortWithinPartitions(key, *order)


def numbered(rows: DataFrame, key: str, order: list[str], partitions: int, name: str = "sequence") -> DataFrame:
    """``keyed_order`` with a gapless number from 0 for each row within its key; ``order`` is unique within a key.

    Two-level prefix sums: rows are numbered within their part of the key, and each part starts where the parts
    before it end. The parts are the sorted ranges, written once, so a hot key is numbered by several tasks and a
    lost one numbers its rows again alike. Rows without a key are numbered as one key.
    """
    placed = written(keyed_order(rows, key, order, partitions).withColumn("_part", F.spark_partition_id()), "ordered")
    before = Window.partitionBy(key).orderBy("_part").rowsBetween(Window.unboundedPreceding, -1)
    sizes = placed.groupBy(key, "_part").agg(F.count(F.lit(1)).alias("_n"))
    starts = sizes.select(F.col(key).alias("_key"), F.col("_part").alias("_of"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    within = F.row_number().over(Window.partitionBy(key, "_part").orderBy(*order))
    joined = placed.withColumn("_at", within).join(starts, F.col(key).eqNullSafe(F.col("_key")) & (F.col("_part") == F.col("_of")))
    return joined.select(*[f"`{c}`" for c in rows.columns], (F.col("_start") + F.col("_at") - 1).alias(name))


def in_input_order(rows: DataFrame, partition: str, offset: str) -> DataFrame:
    """Emit the rows of each input partition by offset."""
    return rows.sortWithinPartitions(partition, offset)


def tapped(rows: DataFrame, stage: str, *metrics: Column) -> DataFrame:
    """Counts the rows that pass, without another pass over them.

    A stream shows the numbers in its progress, a batch through an ``Observation`` of that name.
    """
    return rows.observe(stage, F.count(F.lit(1)).alias("rows"), *metrics)


def console(rows: DataFrame, stage: str) -> DataStreamWriter:
    """Print a stage of a stream while developing."""
    return rows.writeStream.format("console").queryName(stage).option("truncate", "true")


def kafka_sink_options(cfg: JobConfig, acks: str = "1") -> dict[str, str]:
    return {"kafka.bootstrap.servers": cfg.kafka_servers, "topic": cfg.sink_topic, "kafka.acks": acks}


def write_stream_to_kafka(values: DataFrame, cfg: JobConfig, checkpoint: str, acks: str = "1") -> DataStreamWriter:
    """At-least-once writer of a ``value`` (and ``key``) stream; needs the Kafka connector jar."""
    return (
        values.writeStream.format("kafka")
        .options(**kafka_sink_options(cfg, acks))
        .option("checkpointLocation", checkpoint)
        .trigger(processingTime=cfg.trigger_interval)
    )


def send(values: DataFrame, cfg: JobConfig, batch_id: int) -> None:
    """Hand the stored messages ``(value)`` of one batch to the configured sink, at least once.

    Files are lines of text below ``output_path``, one folder per batch, which a batch that runs again replaces.
    """
    if cfg.sink == "kafka":
        values.write.format("kafka").options(**kafka_sink_options(cfg)).save()
    elif cfg.sink == "files":
        values.select("value").write.mode("overwrite").text(f"{cfg.output_path}/batch-{batch_id}")
    elif cfg.sink != "table":
        raise ValueError("sink is one of table, kafka, files")


def jdbc_options(cfg: JobConfig, table: str | None = None) -> dict[str, str]:
    """Connection options; user and password only when they are given."""
    if not cfg.jdbc_url:
        raise ValueError("jdbc_url is not set")
    options = {"url": cfg.jdbc_url, "dbtable": table or cfg.jdbc_table or ""}
    if cfg.jdbc_user is not None:
        options["user"] = cfg.jdbc_user
    if cfg.jdbc_password is not None:
        options["password"] = cfg.jdbc_password
    return options


def write_jdbc(rows: DataFrame, cfg: JobConfig, table: str | None = None, mode: str = "append") -> None:
    """Write rows to a relational table. Reduce them to one row per key before."""
    rows.write.format("jdbc").options(**jdbc_options(cfg, table)).mode(mode).save()
