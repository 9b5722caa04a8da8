"""Settlement of memory rows: by SELL signal, and by age."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.functions import scalars as S
from newsflow.operators.asof import asof_join
from newsflow.operators.keyed import first_per_key, upsert

DAY_MS = 86_400_000


def sell_signals(signals: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Usable SELL signals, and the SELL signals refused with a reason."""
    price = F.coalesce(F.col("buy_price"), F.lit(0.0))
    ident = F.col("event_id").cast("string")
    reason = F.when(ident.isNull() | (ident == ""), "no event_id").when(price <= 0, "buy_price not positive")
    sells = signals.where("action = 'SELL'").withColumn("reason", reason)
    return sells.where("reason IS NULL").drop("reason"), sells.where("reason IS NOT NULL")


def settlements(signals: DataFrame, memory: DataFrame, order: str) -> DataFrame:
    """What the first usable SELL of each event does to memory.

    One row per signalled event: ``outcome`` is settled, already_settled or not_found.
    """
    usable, _ = sell_signals(signals)
    rate = S.return_rate(F.col("buy_price"), F.coalesce(F.col("sell_price"), F.lit(0.0)))
    first = first_per_key(usable.select("event_id", order, rate.alias("rate")), ["event_id"], [order])
    known = memory.select("event_id", F.col("is_settled").alias("_was"))
    outcome = (
        F.when(F.col("_was").isNull(), "not_found")
        .when(F.col("_was"), "already_settled")
        .otherwise("settled")
    )
    return first.join(known, "event_id", "left").select(
        "event_id", "rate", S.win_flag(F.col("rate")).alias("win"), outcome.alias("outcome")
    )


def apply_settlements(memory: DataFrame, done: DataFrame) -> DataFrame:
    """Memory with ``is_settled``, ``return`` and ``win_rate`` of the newly settled rows."""
    new = done.where("outcome = 'settled'").select(
        "event_id", F.col("rate").alias("_rate"), F.col("win").alias("_win")
    )
    hit = F.col("_rate").isNotNull()
    replaced = {
        "is_settled": F.when(hit, F.lit(True)).otherwise(F.col("is_settled")),
        "return": F.coalesce(F.col("_rate"), F.col("`return`")),
        "win_rate": F.coalesce(F.col("_win"), F.col("win_rate")),
    }
    return memory.join(new, "event_id", "left").select(
        *[replaced[c].alias(c) if c in replaced else F.col(f"`{c}`") for c in memory.columns]
    )


def due_unsettled(memory: DataFrame, now: Column, ts: str = "timestamp", age_ms: int = DAY_MS) -> DataFrame:
    return memory.where(~F.col("is_settled") & (F.col(ts) <= now - age_ms))


def settle_by_age(memory: DataFrame, now: Column, prices: DataFrame, *, price: str = "now", ts: str = "timestamp",
                  price_ts: str = "timestamp", by: list[str] | None = None) -> tuple[DataFrame, DataFrame]:
    """Settle due rows from a price table ``(price_ts, price_at_t)``.

    ``now`` uses the latest price (of each key of ``by``); ``t_plus_24h`` uses each row's own price a day
    later, from a bar after the row itself. Returns the settled rows and those refused (price of zero,
    or no later price).
    """
    due = due_unsettled(memory, now, ts)
    if price == "now":
        latest = F.max_by("price_at_t", price_ts).alias("price_after_24h")
        due = due.drop("price_after_24h")
        if by:
            priced = due.join(prices.groupBy(*by).agg(latest), by, "left")
        else:
            priced = due.withColumn("price_after_24h", prices.agg(latest).scalar())
    elif price == "t_plus_24h":
        later = due.withColumn("_later", F.col(ts) + DAY_MS)
        right = prices.select(*(by or []), price_ts, F.col("price_at_t").alias("_price"), F.col(price_ts).alias("_bar"))
        priced = asof_join(later.drop("price_after_24h"), right, "_later", price_ts, by or [], ["_price", "_bar"], how="left")
        after = F.when(F.col("_bar") > F.col(ts), F.col("_price"))
        priced = priced.withColumn("price_after_24h", after).drop("_later", "_price", "_bar")
    else:
        raise ValueError("price is now or t_plus_24h")
    rate = S.return_rate(F.col("price_at_t"), F.col("price_after_24h"))
    done = priced.withColumn("return_24h", rate).withColumn("is_settled", F.lit(True))
    return done.where("return_24h IS NOT NULL"), done.where("return_24h IS NULL")


def merge_settled(memory: DataFrame, done: DataFrame, key: str) -> DataFrame:
    return upsert(memory, done, [key])


def win_rate_summary(settled: DataFrame, win: str = "win", ret: str = "rate",
                     by: str = "sentiment_score") -> DataFrame:
    return settled.groupBy(by).agg(
        F.count(F.lit(1)).alias("n"), F.avg(win).alias("avg_win"), F.avg(ret).alias("avg_return")
    )
