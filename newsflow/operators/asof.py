"""Backward as-of join that no key or time range can overload."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsflow.operators.keyed import latest_per_key

HOUR_MS = 3_600_000


def asof_join(left: DataFrame, right: DataFrame, left_ts: str, right_ts: str, by: list[str],
              values: list[str], how: str = "inner", bucket_ms: int = HOUR_MS,
              available_after_ms: int = 0) -> DataFrame:
    """Adds to each left row the ``values`` of the latest right row at or before ``left_ts``.

    Times are epoch milliseconds; ``right`` has at most one row per ``by`` and time.
    ``available_after_ms`` delays each right row, for bars that are keyed by their opening time.

    1. Only the distinct ``(by, time)`` probes of the left side take part, so repeated times cost
       nothing and a bucket holds at most ``bucket_ms`` probes.
    2. Probes and right rows are shuffled once, by ``(by, bucket)``. One reader of that exchange
       fills forward within the bucket; another keeps each bucket's last right row, and that small
       table hands the row of the earlier buckets in where a bucket starts without one.
    3. The answers go back to the left rows by an equi-join, which adaptive execution splits when
       one time is hot.
    """
    start = F.col("_t") - F.pmod(F.col("_t"), F.lit(bucket_ms))
    probes = left.select(*by, F.col(left_ts).alias("_t")).distinct().withColumn("_v", F.lit(None))
    known = right.select(
        *by,
        (F.col(right_ts) + available_after_ms).alias("_t"),
        F.struct(*[F.col(f"`{v}`") for v in values]).alias("_v"),
    )
    # both readers below use exactly these columns, so that they share the exchange
    marks = (
        probes.unionByName(known)
        .dropna(subset=[*by, "_t"])
        .withColumn("_b", start)
        .repartition(*by, "_b")
    )

    is_known = F.col("_v").isNotNull()
    earlier = Window.partitionBy(*by).orderBy("_b").rowsBetween(Window.unboundedPreceding, -1)
    carry = (
        marks.groupBy(*by, "_b")
        .agg(F.max_by("_v", F.when(is_known, F.col("_t"))).alias("_last"))
        .select(*by, "_b", F.last("_last", ignorenulls=True).over(earlier).alias("_carry"))
        .where("_carry IS NOT NULL")
    )

    upto = (
        Window.partitionBy(*by, "_b")
        .orderBy("_t", is_known.desc())
        .rowsBetween(Window.unboundedPreceding, 0)
    )
    answers = (
        marks.withColumn("_fill", F.last("_v", ignorenulls=True).over(upto))
        .where(~is_known)
        .join(carry, [*by, "_b"], "left")
        .select(*by, F.col("_t").alias(left_ts), F.coalesce("_fill", "_carry").alias("_hit"))
        .where("_hit IS NOT NULL")
    )
    joined = left.join(answers, [*by, left_ts], how)
    return joined.select(*[f"`{c}`" for c in left.columns], *[f"_hit.`{v}`" for v in values])


def reachable_rows(right: DataFrame, right_ts: str, by: list[str], low: int, high: int) -> DataFrame:
    """The right rows that probes between ``low`` and ``high`` can match.

    Of the rows up to ``low`` only the last of each key counts, and Spark finds it before the
    shuffle; so a small batch against a long history moves few rows.
    """
    t = F.col(right_ts)
    last = latest_per_key(right.where(t <= low), by, [right_ts]).where(t.isNotNull())
    return right.where((t > low) & (t <= high)).unionByName(last)
