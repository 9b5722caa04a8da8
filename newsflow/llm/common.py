"""Small helpers that the operators share."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.session import written

SPACES = "\x20\x09\x0a\x0b\x0c\x0d"  # what the contracts call white space


def configure(spark: SparkSession) -> SparkSession:
    """Adaptive plans, and Arrow batches that stay small when texts are long."""
    spark.conf.set("spark.sql.adaptive.enabled", "true")
    spark.conf.set("spark.sql.adaptive.skewJoin.enabled", "true")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "1000")
    spark.conf.set("spark.sql.execution.arrow.maxBytesPerBatch", str(16 << 20))
    return spark


def documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    return configure(spark).read.parquet(f"{sf_dir}/documents.parquet")


def texts(docs: DataFrame) -> DataFrame:
    """``doc_id`` and the whole text; a null text is an empty one."""
    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"))


def whole_text() -> Column:
    return F.coalesce(F.col("text"), F.lit(""))


def parts_for(spark: SparkSession, rows: int, each: int) -> int:
    """Partitions of at most about ``each`` rows, and no fewer than the session's own number."""
    return max(int(spark.conf.get("spark.sql.shuffle.partitions")), -(-rows // each))


def most_counted(counted: DataFrame, most: int) -> DataFrame:
    """The rows with the largest ``n``, ``most`` at most: all above a cut through the counts' histogram,
    so no task sorts the rows."""
    counted = written(counted, "counted")
    left, cut = most, None
    for row in counted.groupBy("n").count().orderBy(F.desc("n")).toLocalIterator():
        left -= row["count"]
        if left < 0:
            break
        cut = row.n
    return counted.where(F.lit(False) if cut is None else F.col("n") >= cut)
