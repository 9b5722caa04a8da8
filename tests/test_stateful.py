"""Streams with state over landed files: bars, indicators, and settlement by age."""

import os

import numpy as np
import pytest
from pyspark.sql import functions as F

from newsflow.operators import bars as B
from newsflow.sinks import tables
from newsflow.sources import streams
from newsflow.streaming import jobs, stateful
from test_streaming import T0, config, run

MINUTE = 60_000
TICK = "symbol string, ts timestamp, seq bigint, price double, volume double"


@pytest.fixture(autouse=True)
def rocksdb(spark):
    stateful.use_rocksdb(spark)
    yield
    spark.conf.unset("spark.sql.streaming.stateStore.providerClass")


def land(spark, folder, rows, schema):
    """One more file, read as one more batch."""
    df = spark.createDataFrame(rows, schema)
    if "ts" in df.columns and dict(df.dtypes)["ts"] == "bigint":
        df = df.withColumn("ts", F.timestamp_millis("ts"))
    df.coalesce(1).write.mode("append").parquet(folder)


def collect(stream, folder, mode="append"):
    """Runs what has landed so far; the rows of all runs."""
    def keep(rows, batch_id):
        tables.write_batch(rows, f"{folder}/out", batch_id)

    run(stream.writeStream.foreachBatch(keep).outputMode(mode).option("checkpointLocation", f"{folder}/check").trigger(availableNow=True))
    return stream.sparkSession.read.parquet(f"{folder}/out/delta")


def ticks(spark, folder):
    os.makedirs(folder, exist_ok=True)
    return streams.read_file_stream(spark, folder, spark.createDataFrame([], TICK).schema, max_files=1)


def args():
    return F.col("price"), F.col("volume"), B.tick_order(F.col("ts"), F.col("seq"))


def test_streaming_bars_equal_the_batch_bars(spark, tmp_path):
    folder, rng = str(tmp_path / "in"), np.random.default_rng(1)
    ms = TICK.replace("timestamp", "bigint")
    early = [("ETH" if i % 3 else "BTC", T0 + i * 7000, i, float(rng.integers(1, 50)), 1.0) for i in range(60)]
    late = [("ETH", T0 + 410_000, 900, 99.0, 2.0)]  # its minute is still open
    too_late = [("ETH", T0 + 1000, 901, 500.0, 3.0)]
    after = [("BTC", T0 + 2_000_000, 902, 1.0, 1.0)]
    built = stateful.streaming_bars(ticks(spark, folder), ["symbol"], "ts", *args(), delay="1 minute")
    land(spark, folder, early, ms)
    land(spark, folder, late, ms)
    collect(built, str(tmp_path / "s"))
    land(spark, folder, too_late, ms)
    land(spark, folder, after, ms)
    land(spark, folder, [("BTC", T0 + 3_000_000, 903, 1.0, 1.0)], ms)
    found = collect(stateful.streaming_bars(ticks(spark, folder), ["symbol"], "ts", *args(), delay="1 minute"), str(tmp_path / "s"))
    given = spark.createDataFrame(early + late + after, ms).withColumn("ts", F.timestamp_millis("ts"))
    want = B.ohlcv_bars(given, ["symbol"], F.unix_millis("ts"), *args())
    cols = ["symbol", "timestamp", "open", "high", "low", "close", "volume"]
    assert sorted(map(tuple, found.select(cols).collect())) == sorted(map(tuple, want.select(cols).collect()))


def bars(n, symbol, seed):
    rng, close, out = np.random.default_rng(seed), 100.0, []
    for i in range(n):
        new = max(close + float(rng.normal()), 1.0) if i % 17 else close
        out.append((symbol, T0 + i * MINUTE, max(close, new) + float(rng.random()), min(close, new) - float(rng.random()), new))
        close = new
    return out


BAR = "symbol string, timestamp bigint, high double, low double, close double"


def test_rolling_indicators_equal_the_batch_ones_bar_by_bar(spark, tmp_path):
    held = bars(260, "ETH", 3) + bars(40, "BTC", 4)
    frame = spark.createDataFrame(held, BAR)
    want = {(r.symbol, r.timestamp): (r.true_range, r.rsi_14, r.atr_14) for r in B.indicators(frame, ["symbol"]).collect()}
    folder = str(tmp_path / "in")
    stream = lambda: stateful.streaming_indicators(streams.read_file_stream(spark, folder, frame.schema, max_files=1), "symbol")
    for start in range(0, 260, 65):  # out of order inside a batch
        land(spark, folder, [r for r in reversed(held) if start <= (r[1] - T0) // MINUTE < start + 65], BAR)
        collect(stream(), str(tmp_path / "s"))
    land(spark, folder, held[:30] + [("BTC", T0 + 5000 * MINUTE, None, 1.0, 1.0)], BAR)  # seen before; not a bar
    found = collect(stream(), str(tmp_path / "s")).collect()
    assert len(found) == len(want)
    for r in found:
        for got, exact in zip((r.true_range, r.rsi_14, r.atr_14), want[r.symbol, r.timestamp], strict=True):
            assert got == (None if exact is None else pytest.approx(exact, rel=1e-9, abs=1e-9))


def test_flat_prices_have_no_rsi():
    rolling = stateful.RollingIndicators(length=3, limit=6)
    for _ in range(10):
        last = rolling.add(5.0, 5.0, 5.0)
    assert last == (0.0, None, 0.0)


EVENT = "event_id string, symbol string, price_at_t double, timestamp bigint"
DAY = 86_400_000


def test_each_event_settles_once_a_day_later(spark, tmp_path):
    events_in, ticks_in, settled = str(tmp_path / "e"), str(tmp_path / "t"), str(tmp_path / "settled")
    cfg = config(tmp_path)
    prices = spark.createDataFrame([("ETH", T0 + h * 3_600_000, 100.0 + h) for h in range(60)], "symbol string, timestamp bigint, price_at_t double")

    def go():
        read = lambda folder, schema: streams.read_file_stream(spark, folder, spark.createDataFrame([], schema).schema)
        due = stateful.due_events(read(events_in, EVENT), read(ticks_in, "timestamp bigint"))
        work = stateful.age_settlement_batch(cfg, settled, lambda: prices, now=F.lit(7))
        run(due.writeStream.foreachBatch(work).option("checkpointLocation", f"{cfg.checkpoint_path}/age").trigger(availableNow=True))

    def state():
        return {r.event_id: (round(r.rate, 6), r.win) for r in tables.read_appended(spark, settled, jobs.SETTLEMENT).collect()}

    land(spark, events_in, [("a", "ETH", 100.0, T0 + 1), ("b", "ETH", 200.0, T0 + DAY // 2), ("b", "ETH", 1.0, T0 + DAY), ("c", "ETH", 0.0, T0 + 2),
                            ("d", "XXX", 1.0, T0 + 3), (None, "ETH", 1.0, T0), ("e", "ETH", 5.0, None)], EVENT)
    land(spark, ticks_in, [(T0 + DAY - 5,)], "timestamp bigint")
    go()
    assert state() == {}
    land(spark, ticks_in, [(T0 + DAY + 60_000,)], "timestamp bigint")
    go()  # a restart: the timers are still there
    assert state() == {"a": (0.25, 1.0)}
    land(spark, events_in, [("a", "ETH", 50.0, T0 + DAY + 90_000)], EVENT)  # sent again
    land(spark, ticks_in, [(T0 + 2 * DAY,)], "timestamp bigint")
    go()
    land(spark, ticks_in, [(T0 + 5 * DAY,)], "timestamp bigint")
    go()
    assert state() == {"a": (0.25, 1.0), "b": (round((136 - 200) / 200, 6), 0.0)}
    refused = {(r["id"], r["reason"]) for r in spark.read.parquet(f"{cfg.reject_path}/delta").collect()}
    assert refused == {("c", "price at event not usable"), ("d", "no later price")}
    assert tables.read_appended(spark, settled, jobs.SETTLEMENT).count() == 2
