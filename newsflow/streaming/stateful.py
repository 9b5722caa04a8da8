"""Stateful streams: bars from ticks, indicators per new bar, and timers for settlement by age.

The state of a key is small and of a fixed size (a minute's bar, the last bars of one symbol, one event), so
a key of very many rows costs time but no memory. State lives in the RocksDB store; ``use_rocksdb`` sets it.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming.stateful_processor import StatefulProcessor, StatefulProcessorHandle

from newsflow.config import JobConfig
from newsflow.operators import asof, bars as B, settle
from newsflow.functions import scalars as S
from newsflow.sinks import tables

ROCKSDB = "org.apache.spark.sql.execution.streaming.state.RocksDBStateStoreProvider"


def use_rocksdb(spark: SparkSession) -> SparkSession:
    spark.conf.set("spark.sql.streaming.stateStore.providerClass", ROCKSDB)
    return spark


# ---- bars -------------------------------------------------------------------------------------

def streaming_bars(ticks: DataFrame, by: list[str], ts: str, price: Column, volume: Column, order: Column,
                   delay: str = "2 minutes", interval_ms: int = B.MINUTE_MS) -> DataFrame:
    """OHLCV bars of a stream of ticks, equal to ``bars.ohlcv_bars`` over the same ticks.

    ``ts`` is a timestamp column. A tick that is late by up to ``delay`` still changes its bar; a bar is final, and
    in append mode comes out, once the watermark has passed its end. Ticks are combined before the shuffle,
    so a symbol with most of the ticks sends one row per task and minute.
    """
    rows = ticks.withWatermark(ts, delay).select(
        *by, F.window(ts, f"{interval_ms // 1000} seconds").alias("_w"), order.alias("_o"), price.alias("_p"), volume.alias("_v"),
    )
    built = rows.groupBy(*by, "_w").agg(
        F.min_by("_p", "_o").alias("open"), F.max("_p").alias("high"), F.min("_p").alias("low"),
        F.max_by("_p", "_o").alias("close"), F.sum("_v").alias("volume"),
    )
    return built.select(*by, F.unix_millis("_w.start").alias("timestamp"), "open", "high", "low", "close", "volume")


# ---- indicators -------------------------------------------------------------------------------

_VALUES = ("high", "low", "close")


class RollingIndicators:
    """True range, RSI and ATR of the newest bar, kept up to date bar by bar.

    Holds the last ``limit`` bars' differences and their exponentially weighted sums; a new bar scales the sums,
    adds its own values and takes out those that leave the frame.
    """

    def __init__(self, length: int = 14, limit: int = 100) -> None:
        self.length, self.limit = length, limit
        self.keep = (length - 1) / length
        self.last_close: float | None = None
        self.steps: list[tuple[float, float, float]] = []
        self.sums = [0.0, 0.0, 0.0]
        self.since = 0  # bars since the sums were last added up anew

    def add(self, high: float, low: float, close: float) -> tuple[float | None, float | None, float | None]:
        """``true_range, rsi, atr`` with this bar the newest; None while too few bars are known."""
        before, self.last_close = self.last_close, close
        if before is None:
            return None, None, None
        change = close - before
        wide = max(high - low, abs(high - before), abs(before - low))
        step = (max(change, 0.0), max(-change, 0.0), wide)
        self.steps.append(step)
        self.sums = [self.keep * s + x for s, x in zip(self.sums, step, strict=True)]
        if len(self.steps) > self.limit - 1:
            gone, weight = self.steps.pop(0), self.keep ** (self.limit - 1)
            self.sums = [s - weight * x for s, x in zip(self.sums, gone, strict=True)]
        self.since += 1
        if self.since >= self.limit:  # so that rounding errors never add up
            self.sums, self.since = [sum(x[i] * self.keep ** age for age, x in enumerate(reversed(self.steps))) for i in range(3)], 0
        n = len(self.steps)
        if n < self.length:
            return wide, None, None
        gain, loss, total = self.sums
        rsi = 100 * gain / (gain + loss) if gain + loss > 0 else None
        return wide, rsi, total / (self.length * (1 - self.keep ** n))

    def state(self) -> tuple:
        flat = [x for step in self.steps for x in step]
        return (self.last_close, flat, self.sums, self.since)

    @classmethod
    def restored(cls, state: tuple | None, length: int, limit: int) -> RollingIndicators:
        out = cls(length, limit)
        if state is not None:
            out.last_close, flat, out.sums, out.since = state[0], list(state[1]), list(state[2]), state[3]
            out.steps = [tuple(flat[i : i + 3]) for i in range(0, len(flat), 3)]
        return out


_ROLLING_STATE = "last_close double, steps array<double>, sums array<double>, since int, newest bigint"


class _IndicatorProcessor(StatefulProcessor):
    def __init__(self, by: str, length: int, limit: int) -> None:
        self.by, self.length, self.limit = by, length, limit

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.held = handle.getValueState("rolling", _ROLLING_STATE)

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N803
        new = pd.concat(rows, ignore_index=True).dropna(subset=list(_VALUES)).sort_values("timestamp", kind="stable")
        state = self.held.get() if self.held.exists() else None
        rolling, newest = RollingIndicators.restored(state, self.length, self.limit), None if state is None else state[4]
        out = []
        for at, high, low, close in new[["timestamp", *_VALUES]].itertuples(index=False):
            if newest is not None and at <= newest:
                continue  # bars come in order; one that was seen changes nothing
            newest = at
            out.append((key[0], int(at), float(high), float(low), float(close), *rolling.add(float(high), float(low), float(close))))
        if newest is not None:
            self.held.update((*rolling.state(), int(newest)))
        yield pd.DataFrame(out, columns=[self.by, "timestamp", *_VALUES, "true_range", "rsi", "atr"])

    def close(self) -> None:
        pass


def streaming_indicators(bars: DataFrame, by: str, length: int = 14, limit: int = 100) -> DataFrame:
    """Each new bar with ``true_range``, ``rsi_<length>`` and ``atr_<length>`` as ``bars.indicators`` gives them.

    ``bars`` is a stream of final bars; within a batch those of a symbol are put in order by time. The state of a
    symbol is its last ``limit`` bars, never its history.
    """
    rows = bars.select(F.col(by).cast("string").alias(by), "timestamp", *[F.col(v).cast("double").alias(v) for v in _VALUES])
    out = T.StructType([T.StructField(by, T.StringType()), T.StructField("timestamp", T.LongType())]
                       + [T.StructField(n, T.DoubleType()) for n in (*_VALUES, "true_range", "rsi", "atr")])
    found = rows.groupBy(by).transformWithStateInPandas(_IndicatorProcessor(by, length, limit), out, "append", "none")
    return found.withColumnsRenamed({"rsi": f"rsi_{length}", "atr": f"atr_{length}"})


# ---- settlement by age ------------------------------------------------------------------------

DUE = T.StructType([T.StructField("event_id", T.StringType()), T.StructField("symbol", T.StringType()), T.StructField("price_at_t", T.DoubleType()),
                    T.StructField("timestamp", T.LongType()), T.StructField("due", T.LongType())])
_EVENT = "event-"
CLOCKS = 64  # keys that carry the time of ticks


class _DueProcessor(StatefulProcessor):
    """Holds each event until event time has passed its age; then it comes out and is forgotten.

    An event that is sent again after that comes out again later; the settlement log knows it.
    """

    def __init__(self, age_ms: int) -> None:
        self.age_ms = age_ms

    def init(self, handle: StatefulProcessorHandle) -> None:
        self.handle = handle
        self.held = handle.getValueState("event", "symbol string, price_at_t double, timestamp bigint")

    def handleInputRows(self, key, rows: Iterator[pd.DataFrame], timerValues) -> Iterator[pd.DataFrame]:  # noqa: N803
        for part in rows:
            if key[0].startswith(_EVENT) and len(part) and not self.held.exists():  # the first sighting counts
                first = part.sort_values("timestamp", kind="stable").iloc[0]
                symbol = None if pd.isna(first["symbol"]) else str(first["symbol"])
                price = None if pd.isna(first["price_at_t"]) else float(first["price_at_t"])
                self.held.update((symbol, price, int(first["timestamp"])))
                self.handle.registerTimer(int(first["timestamp"]) + self.age_ms)
        yield self._rows([])

    def handleExpiredTimer(self, key, timerValues, expiredTimerInfo) -> Iterator[pd.DataFrame]:  # noqa: N803
        symbol, price, at = self.held.get()
        self.held.clear()
        yield self._rows([(key[0], symbol, price, at, at + self.age_ms)])

    @staticmethod
    def _rows(rows: list) -> pd.DataFrame:
        return pd.DataFrame(rows, columns=DUE.fieldNames())

    def close(self) -> None:
        pass


def due_events(events: DataFrame, ticks: DataFrame, age_ms: int = settle.DAY_MS, delay: str = "0 seconds") -> DataFrame:
    """Stream of the events ``(event_id, symbol, price_at_t, timestamp)`` whose age event time has just passed.

    Event time is that of events and ``ticks`` (a stream with ``timestamp``), in milliseconds. Each event has a
    timer of its own and is a key of its own, so no key gathers rows; ticks only move the time on, and are
    dealt over a few keys without state.
    """
    clock = ticks.select(F.concat(F.lit("clock-"), F.pmod(F.xxhash64("timestamp"), F.lit(CLOCKS))).alias("event_id"), F.lit(None).cast("string").alias("symbol"),
                         F.lit(None).cast("double").alias("price_at_t"), "timestamp")
    known = events.where("event_id IS NOT NULL AND timestamp IS NOT NULL").select(
        F.concat(F.lit(_EVENT), F.col("event_id").cast("string")).alias("event_id"), F.col("symbol").cast("string").alias("symbol"),
        F.col("price_at_t").cast("double").alias("price_at_t"), "timestamp")
    both = known.unionByName(clock).withColumn("_at", F.timestamp_millis("timestamp")).withWatermark("_at", delay)
    out = both.groupBy("event_id").transformWithStateInPandas(_DueProcessor(age_ms), DUE, "append", "eventTime")
    return out.withColumn("event_id", F.substring("event_id", len(_EVENT) + 1, 2**31 - 1))


def first_price_after(due: DataFrame, prices: DataFrame, by: list[str]) -> DataFrame:
    """``due`` with ``price_after_24h``: the first price at or after the time an event was due, null without one."""
    back = prices.select(*by, (-F.col("timestamp")).alias("_t"), F.col("price_at_t").alias("price_after_24h"))
    probes = due.withColumn("_t_due", -F.col("due"))
    return asof.asof_join(probes, back, "_t_due", "_t", by, ["price_after_24h"], how="left").drop("_t_due")


def age_settlement_batch(cfg: JobConfig, settle_root: str, prices: Callable[[], DataFrame], by: list[str] | None = None,
                         now: Column | None = None) -> Callable[[DataFrame, int], None]:
    """Work of one batch of due events: settle each at the first price after it was due.

    Settlements go to the same log as those by signal. Events that are settled already are left out; those without
    a usable price go to the rejects with a reason. A batch that runs again replaces its own rows.
    """
    from newsflow.streaming.jobs import SETTLEMENT, _rejects

    keys = by if by is not None else ["symbol"]

    def work(due: DataFrame, batch_id: int) -> None:
        spark = due.sparkSession
        seen = tables.read_appended(spark, settle_root, SETTLEMENT, before=batch_id).select("event_id").distinct()
        open_rows = due.join(seen, "event_id", "left_anti")
        rate = S.return_rate(F.col("price_at_t"), F.col("price_after_24h"))
        rated = first_price_after(open_rows, prices(), keys).withColumn("rate", rate).persist()
        try:
            at = S.now_ms() if now is None else now
            done = rated.where("rate IS NOT NULL").select(
                "event_id", "rate", S.win_flag(F.col("rate")).alias("win"), F.lit("settled").alias("outcome"), at.cast("bigint").alias("settled_at"))
            tables.write_batch(done, settle_root, batch_id)
            if cfg.reject_path:
                why = F.when(F.col("price_after_24h").isNull(), "no later price").otherwise("price at event not usable")
                refused = rated.where("rate IS NULL").drop("rate").withColumn("reason", why)
                tables.write_batch(_rejects(refused, "age settlement", "event_id"), cfg.reject_path, batch_id)
        finally:
            rated.unpersist()

    return work


def pending_events(memory: DataFrame, symbol: str) -> DataFrame:
    """Stored news (see ``schemas.MEMORY``) as events for ``due_events``: those not settled, at their own time."""
    return memory.where("NOT is_settled").select("event_id", F.lit(symbol).alias("symbol"), "price_at_t", F.col("pub_date").alias("timestamp"))
