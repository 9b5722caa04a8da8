"""Ticks to OHLCV bars, and the indicators over bars."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from newsflow.functions import scalars as S

MINUTE_MS = 60_000
_DAY_MS = 86_400_000


def tick_order(ts: Column, seq: Column) -> Column:
    """Time, then sequence number, as one number.

    A fixed-width ordering lets the bars be built by hash aggregation; an ordering by a struct
    would sort all ticks first.
    """
    micros = F.unix_micros(ts.cast("timestamp")).cast("decimal(19,0)")
    shift = F.lit("10000000000000000000").cast("decimal(20,0)")  # above every sequence number
    return (micros * shift + seq).cast("decimal(38,0)")


def ohlcv_bars(ticks: DataFrame, by: list[str], ts_ms: Column, price: Column, volume: Column,
               order: Column, interval_ms: int = MINUTE_MS) -> DataFrame:
    """Bars keyed by their opening time. ``order`` decides the first and last tick of a bar."""
    rows = ticks.select(
        *by,
        (ts_ms - F.pmod(ts_ms, F.lit(interval_ms))).alias("timestamp"),
        order.alias("_o"),
        price.alias("_p"),
        volume.alias("_v"),
    )
    return rows.groupBy(*by, "timestamp").agg(
        F.min_by("_p", "_o").alias("open"),
        F.max("_p").alias("high"),
        F.min("_p").alias("low"),
        F.max_by("_p", "_o").alias("close"),
        F.sum("_v").alias("volume"),
    )


def _halo_blocks(bars: DataFrame, by: list[str], ts: str, halo: int, block_rows: int) -> DataFrame:
    """Cut each symbol's bars into blocks of ``block_rows`` consecutive bars, every block carrying
    the ``halo`` bars before it.

    Adds ``_rn`` (row number in the symbol), ``_blk`` (first row number of the block) and ``_own``
    (false for halo copies). No task
    sees a whole symbol: rows are numbered within a day, and only the per-day counts are summed up
    over the symbol.
    """
    dated = bars.withColumn("_day", F.col(ts) - F.pmod(F.col(ts), F.lit(_DAY_MS)))
    before = Window.partitionBy(*by).orderBy("_day").rowsBetween(Window.unboundedPreceding, -1)
    offsets = (
        dated.groupBy(*by, "_day")
        .agg(F.count(F.lit(1)).alias("_n"))
        .select(*by, "_day", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_before"))
    )
    in_day = Window.partitionBy(*by, "_day").orderBy(ts)
    numbered = (
        dated.join(offsets, [*by, "_day"])
        .withColumn("_rn", F.col("_before") + F.row_number().over(in_day) - 1)
        .drop("_day", "_before")
    )
    place = F.col("_rn") % block_rows
    block = F.col("_rn") - place
    copies = F.when(place >= block_rows - halo, F.array(block, block + block_rows)).otherwise(F.array(block))
    return numbered.withColumn("_blk", F.explode(copies)).withColumn(
        "_own", F.col("_rn") >= F.col("_blk")
    )


def _smoothed(x: Column, weight: Column, n: Column, frame, length: int, adjust: bool) -> Column:
    """Wilder mean of the frame's ``n`` values. ``weight`` grows by ``length / (length - 1)`` a row."""
    keep = (length - 1) / length
    total = F.sum(x * weight).over(frame) / weight
    left_over = F.pow(F.lit(keep), n)
    if adjust:
        return total / (length * (1 - left_over))
    # without adjustment the oldest value keeps all of the remaining weight
    return total / length + left_over * F.first(x, ignorenulls=True).over(frame)


def indicators(bars: DataFrame, by: list[str], ts: str = "timestamp", length: int = 14,
               limit: int = 100, adjust: bool = True, block_rows: int = 1000) -> DataFrame:
    """Adds ``true_range``, ``rsi_<length>`` and ``atr_<length>``; bars without prices drop out.

    A bar's value is the one computed when that bar is the newest of ``limit`` fetched bars, so
    its frame holds ``limit - 1`` differences. The first ``length`` bars of a symbol stay null.

    The exponential weights are written as growing powers of the row number inside a block, so a
    plain ``sum`` over the frame gives the smoothed value; all terms are non-negative, so nothing
    cancels. Only the first bar of a symbol has no difference, which gives the number of values in
    a frame without counting.
    """
    halo = limit - 1
    if block_rows < halo:
        raise ValueError("block_rows must be at least limit - 1")
    blocks = _halo_blocks(bars.dropna(subset=["high", "low", "close"]), by, ts, halo, block_rows)
    w = Window.partitionBy(*by, "_blk").orderBy("_rn")
    frame = w.rowsBetween(-(limit - 2), 0)
    prev, change = F.col("_prev"), F.col("close") - F.col("_prev")
    steps = blocks.withColumn("_prev", F.lag("close").over(w)).select(
        *bars.columns,
        "_own",
        F.when(prev.isNotNull(), F.greatest(change, F.lit(0.0))).alias("_gain"),
        F.when(prev.isNotNull(), F.greatest(-change, F.lit(0.0))).alias("_loss"),
        true_range(F.col("high"), F.col("low"), prev).alias("true_range"),
        F.pow(F.lit(length / (length - 1)), F.col("_rn") - F.col("_blk")).alias("_w"),
        F.least("_rn", F.lit(halo)).alias("_n"),
        "_blk",
        "_rn",
    )
    smooth = {
        f"_{x}": _smoothed(F.col(x), F.col("_w"), F.col("_n"), frame, length, adjust)
        for x in ("_gain", "_loss", "true_range")
    }
    # one select, so that all sums share one window pass
    done = steps.select("*", *[c.alias(n) for n, c in smooth.items()]).where("_own")
    ready = F.col("_n") >= length
    rsi = F.try_divide(100 * F.col("__gain"), F.col("__gain") + F.col("__loss"))
    return done.select(
        *bars.columns,
        "true_range",
        F.when(ready, rsi).alias(f"rsi_{length}"),
        F.when(ready, F.col("_true_range")).alias(f"atr_{length}"),
    )


def true_range(high: Column, low: Column, prev_close: Column) -> Column:
    """Widest of the bar's range and its reach from the last close; null for the first bar."""
    return F.when(
        prev_close.isNotNull(),
        F.greatest(high - low, F.abs(high - prev_close), F.abs(prev_close - low)),
    )


def drop_warmup(rows: DataFrame, cols: list[str]) -> DataFrame:
    """Drop rows with a null or NaN indicator."""
    return rows.na.drop(subset=cols)


def kline_features(bars: DataFrame, by: list[str], **options) -> DataFrame:
    """Stored feature rows: indicators, close as ``price_at_t`` and the Shanghai wall clock."""
    rows = drop_warmup(indicators(bars, by, **options), ["rsi_14", "atr_14"])
    return rows.select(
        *by,
        "timestamp",
        S.shanghai_datetime(F.col("timestamp")).alias("datetime_sh"),
        F.col("close").alias("price_at_t"),
        "rsi_14",
        "atr_14",
        "high",
        "low",
        "close",
    )
