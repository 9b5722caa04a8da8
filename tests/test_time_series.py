import random

import numpy as np
import pandas as pd
import pytest
from pyspark.sql import functions as F

from newsflow.operators import asof, bars as B
from newsflow.functions import scalars as S


def walk(n, seed, symbol, gap=True):
    rng = random.Random(seed)
    price, ts, rows = 100.0, 1704067200000, []
    for _ in range(n):
        ts += 60000 * (rng.choice([1, 1, 1, 50, 3000]) if gap else 1)
        price = max(1.0, price + rng.gauss(0, 1))
        high, low = price + rng.random(), price - rng.random()
        rows.append((symbol, ts, price, high, low, price + rng.uniform(-0.3, 0.3), 1.0))
    return rows


BAR = "symbol string, timestamp bigint, open double, high double, low double, close double, volume double"


def pandas_indicators(pdf, limit, adjust=True):
    """Each bar from its own fetch window of ``limit`` bars."""
    out = []
    for i in range(len(pdf)):
        w = pdf.iloc[max(0, i - limit + 1): i + 1]
        diff = w.close.diff()
        opts = dict(alpha=1 / 14, min_periods=14, adjust=adjust)
        gain = diff.clip(lower=0).ewm(**opts).mean().iloc[-1]
        loss = (-diff.clip(upper=0)).ewm(**opts).mean().iloc[-1]
        prev = w.close.shift(1)
        tr = pd.concat([w.high - w.low, (w.high - prev).abs(), (prev - w.low).abs()], axis=1).max(axis=1)
        tr[prev.isna()] = np.nan
        out.append((100 * gain / (gain + loss), tr.ewm(**opts).mean().iloc[-1]))
    return np.array(out)


@pytest.mark.parametrize("adjust", [True, False])
def test_indicators_equal_pandas(spark, adjust):
    rows = walk(700, 1, "a") + walk(130, 2, "b", gap=False) + walk(5, 3, "c")
    df = B.indicators(spark.createDataFrame(rows, BAR), ["symbol"], block_rows=120, adjust=adjust)
    got = df.orderBy("symbol", "timestamp").toPandas()
    assert len(got) == len(rows)
    for symbol, pdf in got.groupby("symbol"):
        want = pandas_indicators(pdf, 100, adjust)
        np.testing.assert_allclose(pdf[["rsi_14", "atr_14"]].to_numpy(float), want, atol=1e-9, rtol=1e-9)
        assert pdf.rsi_14.iloc[:14].isna().all() and pdf.rsi_14.iloc[14:].notna().all()
    ready = got.rsi_14.dropna()
    assert ready.between(0, 100).all()


def test_block_size_does_not_matter(spark):
    df = spark.createDataFrame(walk(900, 5, "a"), BAR)
    small = B.indicators(df, ["symbol"], block_rows=99).orderBy("timestamp").toPandas()
    large = B.indicators(df, ["symbol"], block_rows=100000).orderBy("timestamp").toPandas()
    pd.testing.assert_frame_equal(small, large, rtol=1e-9)


def test_flat_prices_have_no_rsi_and_are_dropped(spark):
    rows = [("a", 60000 * i, 5.0, 5.0, 5.0, 5.0, 1.0) for i in range(40)]
    df = spark.createDataFrame(rows, BAR)
    assert B.kline_features(df, ["symbol"]).count() == 0


def test_block_smaller_than_halo_is_refused(spark):
    with pytest.raises(ValueError):
        B.indicators(spark.createDataFrame(walk(3, 1, "a"), BAR), ["symbol"], block_rows=10)


def test_bars(spark):
    ticks = [("a", 1, 60001, 3.0, 1.0), ("a", 2, 60001, 5.0, 2.0), ("a", 3, 119999, 1.0, 1.0), ("a", 4, 120000, 9.0, 1.0)]
    df = spark.createDataFrame(ticks, "s string, seq bigint, t bigint, p double, v double")
    got = B.ohlcv_bars(df, ["s"], F.col("t"), F.col("p"), F.col("v"), F.struct("t", "seq")).orderBy("timestamp").collect()
    assert [tuple(r) for r in got] == [("a", 60000, 3.0, 5.0, 1.0, 1.0, 4.0), ("a", 120000, 9.0, 9.0, 9.0, 9.0, 1.0)]


# ---- as-of ----------------------------------------------------------------------------------

LEFT, RIGHT = "k string, t bigint, id bigint", "k string, rt bigint, v double, w string"


def brute(left, right, delay=0):
    out = {}
    for k, t, i in left:
        hits = [r for r in right if r[0] == k and k is not None and t is not None and r[1] + delay <= t]
        out[i] = max(hits, key=lambda r: r[1])[2:] if hits else (None, None)
    return out


@pytest.mark.parametrize("seed", range(4))
@pytest.mark.parametrize("how", ["inner", "left"])
def test_asof_equals_brute_force(spark, seed, how):
    rng = random.Random(seed)
    keys = ["a", "b", "c", None]
    span = rng.choice([50, 5000, 10 ** 6])
    right = [(k, t, float(t), None if t % 3 == 0 else f"{k}{t}") for k in keys[:2] for t in sorted(rng.sample(range(span), 20))]
    left = [(rng.choice(keys), rng.choice([None, 7, rng.randrange(-10, span)]), i) for i in range(150)]
    delay = rng.choice([0, 60])
    got = asof.asof_join(
        spark.createDataFrame(left, LEFT), spark.createDataFrame(right, RIGHT), "t", "rt", ["k"], ["v", "w"],
        how=how, bucket_ms=100, available_after_ms=delay,
    ).collect()
    want = brute(left, right, delay)
    if how == "inner":
        want = {i: v for i, v in want.items() if v[0] is not None}
    assert {r["id"]: (r["v"], r["w"]) for r in got} == want
    assert len(got) == len(want)


def test_asof_exact_hit_gap_and_duplicates(spark):
    day = 86_400_000
    right = spark.createDataFrame([("a", 10, 1.0, "x"), ("a", 20, 2.0, "y")], RIGHT)
    left = spark.createDataFrame([("a", 20, 1), ("a", 9, 2), ("a", 9 * day, 3), ("a", 9 * day, 4), ("z", 50, 5)], LEFT)
    got = asof.asof_join(left, right, "t", "rt", ["k"], ["v"]).collect()
    assert sorted((r["id"], r["v"]) for r in got) == [(1, 2.0), (3, 2.0), (4, 2.0)]


def test_asof_without_key(spark):
    right = spark.createDataFrame([(10, 1.0), (4000000, 2.0)], "rt bigint, v double")
    left = spark.createDataFrame([(5,), (11,), (9000000,)], "t bigint")
    got = asof.asof_join(left, right, "t", "rt", [], ["v"]).collect()
    assert sorted(tuple(r) for r in got) == [(11, 1.0), (9000000, 2.0)]


def test_asof_keeps_repeated_left_rows(spark):
    right = spark.createDataFrame([("a", 0, 1.0, "x")], RIGHT)
    left = spark.createDataFrame([("a", 5, 1)] * 1000, LEFT)
    assert asof.asof_join(left, right, "t", "rt", ["k"], ["v"]).count() == 1000


def test_reachable_rows_do_not_change_the_answers(spark):
    rng = random.Random(8)
    right = [(k, t, float(t), None) for k in "ab" for t in sorted(rng.sample(range(1000), 40))] + [("c", 5, 5.0, None)]
    left = [(rng.choice("abc"), rng.randrange(600, 700), i) for i in range(50)]
    r, l = spark.createDataFrame(right, RIGHT), spark.createDataFrame(left, LEFT)
    times = [t for _, t, _ in left]
    near = asof.reachable_rows(r, "rt", ["k"], min(times), max(times))
    assert near.count() < r.count()
    got = {x["id"]: (x["v"], None) for x in asof.asof_join(l, near, "t", "rt", ["k"], ["v"], "left").collect()}
    assert got == brute(left, right)
    single = r.where("k = 'a'").drop("k")
    assert asof.reachable_rows(single, "rt", [], -5, -1).count() == 0


def test_to_epoch_ms_keeps_milliseconds(spark):
    got = spark.sql("SELECT timestamp_ntz'2024-01-01 00:00:00.123456' AS t").select(S.to_epoch_ms(F.col("t"))).first()[0]
    assert got == 1704067200123
