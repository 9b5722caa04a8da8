"""Message sources as text values, typed rows from them, and relational reads."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow import schemas
from newsflow.config import JobConfig
from newsflow.functions import scalars as S
from newsflow.sinks.topics import jdbc_options


def kafka_source_options(cfg: JobConfig, tuned: bool = False) -> dict[str, str]:
    """Reader options. ``tuned`` adds the fetch and discovery settings of the analysis job."""
    options = {
        "kafka.bootstrap.servers": cfg.kafka_servers,
        "subscribe": cfg.source_topic,
        "startingOffsets": cfg.starting_offsets,
        "groupIdPrefix": cfg.kafka_group,
    }
    if cfg.max_offsets_per_trigger:
        options["maxOffsetsPerTrigger"] = str(cfg.max_offsets_per_trigger)
    if cfg.min_partitions:
        options["minPartitions"] = str(cfg.min_partitions)
    if tuned:
        # fixed values
        options |= {
            "kafka.fetch.min.bytes": "1024",
            "kafka.fetch.max.wait.ms": "500",
            "kafka.metadata.max.age.ms": "10000",
        }
    return options


def read_kafka(spark: SparkSession, cfg: JobConfig, tuned: bool = False) -> DataFrame:
    """Value-only text stream; needs the Kafka connector jar."""
    stream = spark.readStream.format("kafka").options(**kafka_source_options(cfg, tuned)).load()
    return stream.select(F.col("value").cast("string").alias("value"), "partition", "offset")


def read_text_stream(spark: SparkSession, folder: str, max_files: int | None = None) -> DataFrame:
    """The same stream from landed files, one message per line."""
    reader = spark.readStream.format("text")
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def read_file_stream(spark: SparkSession, folder: str, schema: T.StructType, fmt: str = "parquet",
                     max_files: int | None = None) -> DataFrame:
    reader = spark.readStream.format(fmt).schema(schema)
    if max_files:
        reader = reader.option("maxFilesPerTrigger", max_files)
    return reader.load(folder)


def read_jdbc(spark: SparkSession, cfg: JobConfig, table: str | None = None) -> DataFrame:
    """Relational table; filters and column choice reach the database."""
    return spark.read.format("jdbc").options(**jdbc_options(cfg, table)).load()


def parse_json(messages: DataFrame, schema: T.StructType, value: str = "value", keep: list[str] = []) -> DataFrame:
    """Typed rows of JSON messages. An unreadable message gives a row of nulls."""
    return messages.select(*keep, F.from_json(F.col(value), schema).alias("_m")).select(*keep, "_m.*")


def employees(messages: DataFrame, value: str = "value", keep: list[str] = []) -> DataFrame:
    """Employee rows with their event time and a zero-delay watermark."""
    rows = parse_json(messages, schemas.EMPLOYEE, value, keep)
    return rows.withWatermark("message_time", "0 seconds")


def user_clicks(messages: DataFrame, value: str = "value", keep: list[str] = []) -> DataFrame:
    rows = parse_json(messages, schemas.USER_CLICK, value, keep)
    return rows.withColumn("clicked_at", F.try_to_timestamp("ts", F.lit("yyyy-MM-dd HH:mm:ss")))


def scraped_sentiment(messages: DataFrame, value: str = "value", keep: list[str] = []) -> DataFrame:
    """Scraped items; their seconds become milliseconds like every other time."""
    rows = parse_json(messages, schemas.SENTIMENT_DATA, value, keep)
    return rows.withColumn("ts_ms", S.to_epoch_ms(F.timestamp_seconds("timestamp"))).drop("timestamp")


def trade_signals(messages: DataFrame, value: str = "value", keep: list[str] = []) -> DataFrame:
    return parse_json(messages, schemas.TRADE_SIGNAL, value, keep)
