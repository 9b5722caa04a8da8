"""Ids seen lately: a table by day of sighting that forgets, asked through a Bloom filter.

A row ``(id, day)`` says that the id was sighted on that day (days since 1970). An id gets at most one row a
day, however often it comes. It counts as seen for ``keep_days`` after its last sighting, so a feed that repeats
an item for months never sends it twice, and an id that stays away is forgotten. A batch reads only the
days that can still matter to it; older folders are not opened. Null ids are never seen.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.operators.settle import DAY_MS
from newsflow.sinks import tables

SEEN = T.StructType([T.StructField("id", T.StringType()), T.StructField("day", T.LongType())])
KEEP_DAYS = 7
WORDS = 1 << 16  # of 64 bits: the filter never has more rows, whatever the batch holds

_HASH = "xxhash64(id)"
_WORD = f"CAST(pmod({_HASH}, {WORDS}) AS INT)"
_MASK = " | ".join(f"shiftleft(1L, CAST(shiftrightunsigned({_HASH}, {at}) & 63 AS INT))" for at in (16, 28, 40, 52))


def day_of(ms: Column) -> Column:
    return F.floor(ms / DAY_MS).cast("bigint")


def may_match(rows: DataFrame, ids: DataFrame) -> DataFrame:
    """The rows whose id may be among ``ids``: all that are, and few others.

    Each id sets four bits of one word. Only the words are broadcast, so the rows meet them where they are read.
    """
    words = ids.select(F.expr(_WORD).alias("_word"), F.expr(_MASK).alias("_mask")).groupBy("_word").agg(
        F.bit_or("_mask").alias("_bits")
    )
    asked = rows.withColumns({"_word": F.expr(_WORD), "_mask": F.expr(_MASK)})
    return asked.join(F.broadcast(words), "_word").where("_bits & _mask = _mask").select(rows.columns)


def with_last_day(items: DataFrame, seen: DataFrame, keep_days: int = KEEP_DAYS) -> DataFrame:
    """``items`` (one row per id, with their ``_day``) with ``_seen``: the day their id was last sighted.

    It is null for ids that are new or forgotten.
    """
    low = items.agg(F.min("_day")).first()[0]  # a value in the plan, so that the scan is cut to its folders
    near = seen.where(F.col("day") >= F.lit(low).cast("bigint") - keep_days)
    last = may_match(near, items.select("id")).groupBy("id").agg(F.max("day").alias("_seen"))
    kept = F.when(F.col("_seen") >= F.col("_day") - keep_days, F.col("_seen"))
    return items.join(last, "id", "left").withColumn("_seen", kept).select(*items.columns, "_seen")


def remember(marked: DataFrame, root: str, batch_id: int) -> None:
    """Store the sightings of one batch that say something new: new ids, and known ones on a later day."""
    news = marked.where("id IS NOT NULL AND (_seen IS NULL OR _seen < _day)")
    tables.write_batch(news.select("id", F.col("_day").alias("day")), root, batch_id, partition_by=["day"])


def forget(spark: SparkSession, root: str, today: int, keep_days: int = KEEP_DAYS) -> int | None:
    """New version of the table with one row per id and without the days that no batch asks for.

    The newest batch stays apart, as it may run again and must not meet its own ids. What the version replaces is
    deleted; run it while no batch is at work. None when there is nothing to fold yet.
    """
    upto = tables.last_batch(spark, root) - 1
    if upto < 0:
        return None
    rows = tables.read_appended(spark, root, SEEN, before=upto + 1).where(F.col("day") >= today - keep_days)
    version = tables.publish(rows.groupBy("id").agg(F.max("day").alias("day")), root, upto, partition_by=["day"])
    tables.drop_replaced(spark, root)
    return version
