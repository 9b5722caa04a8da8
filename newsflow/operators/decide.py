"""Back-test statistics over similar history, and the trade signal."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.functions import scalars as S
from newsflow.operators.knn import Bound, knn_join, query_key
from newsflow.operators.news import extreme_gate


def backtest_stats(hits: DataFrame, queries: DataFrame, q_id: str, sim_threshold: float = 0.9,
                   ret: str = "return") -> DataFrame:
    """Per query over its neighbours: matches above the threshold, best similarity, wins, win rate.

    Queries without any neighbour get zeros. Queries that carry the ``q_key`` of the search are matched by it
    too, so rows of one id that were searched apart are rated apart.
    """
    valid = F.col("sim") > sim_threshold
    ours = "q_key" in queries.columns  # then rows of one id have statistics of their own
    keys = ["q_id", "q_key"] if ours else ["q_id"]
    stats = hits.groupBy(*keys).agg(
        F.count_if(valid).alias("valid_matches"),
        F.max(F.when(valid, F.col("sim"))).alias("max_similarity"),
        F.count_if(valid & (F.col(ret) > 0)).alias("win_count"),
    )
    joined = queries.join(stats.withColumnRenamed("q_id", q_id), [q_id, *keys[1:]], "left")
    zero = F.lit(0).cast("bigint")
    return joined.select(
        *[f"`{c}`" for c in queries.columns],
        F.coalesce("valid_matches", zero).alias("valid_matches"),
        F.coalesce("max_similarity", F.lit(0.0)).alias("max_similarity"),
        F.coalesce("win_count", zero).alias("win_count"),
        F.coalesce(F.try_divide(F.col("win_count"), F.col("valid_matches")), F.lit(0.0)).alias("win_rate"),
    )


def similar_history(queries: DataFrame, memory: DataFrame, k: int = 5, *, q_id: str = "id",
                    m_id: str = "event_id", point_in_time: bool = True, ret: str = "return", **options) -> DataFrame:
    """Hybrid search: settled memory of the same score whose RSI is at least the query's minus 5.

    ``point_in_time`` also asks that the memory row is older than the query.
    """
    q = queries.withColumn("_rsi_floor", S.rsi_floor(F.col("rsi_14")))
    bounds = [("rsi_14", ">=", "_rsi_floor")]
    if point_in_time:
        bounds.append(("sentiment_es", "<", "sentiment_es"))
    return knn_join(
        q, memory.where("is_settled"), k, q_id=q_id, m_id=m_id, q_vec="vector", m_vec="vector",
        part=("sentiment_score", "sentiment_score"), bounds=bounds, carry=[ret], **options,
    )


def passes(mode: str, sim: float = 0.9, win: float = 0.65) -> Column:
    """The decision gate: ``strict`` asks for similarity and win rate, ``score_only`` for nothing."""
    if mode == "score_only":
        return F.col("max_similarity") >= 0.0
    if mode == "strict":
        return (F.col("max_similarity") > sim) & (F.col("win_rate") > win)
    raise ValueError("mode is strict or score_only")


def trade_signals(stats: DataFrame, mode: str = "strict", sim: float = 0.9, win: float = 0.65,
                  token: str = "ETH", now: Column | None = None) -> DataFrame:
    """One signal per row that passes the gate. Rows without date or score give none.

    The signal carries ``event_id`` and ``buy_price``, which the settlement needs.
    """
    at = S.now_ms() if now is None else now
    none = F.lit(None)
    return stats.where(
        passes(mode, sim, win) & F.col("pubDate").isNotNull() & F.col("sentiment_score").isNotNull()
    ).select(
        S.decision_action(F.col("sentiment_score")).alias("action"),
        F.lit(token).alias("token"),
        "pubDate",
        "sentiment_es",
        at.alias("buy_time"),
        none.cast("bigint").alias("sell_time"),
        F.col("sentiment_score").cast("bigint").alias("trigger_score"),
        at.alias("timestamp"),
        F.col("id").cast("string").alias("event_id"),
        F.col("price_at_t").alias("buy_price"),
        none.cast("double").alias("sell_price"),
    )


def analysis_decisions(scored: DataFrame, memory: DataFrame, *, q_id: str = "id", m_id: str = "id", k: int = 10,
                       sim_threshold: float = 0.9, win_threshold: float = 0.65, ret: str = "return_24h",
                       point_in_time: bool = False, bounds: Sequence[Bound] = (), **options) -> DataFrame:
    """Decision of the analysis job: extreme scores are back-tested, the others pass undecided."""
    older = [("sentiment_es", "<", "sentiment_es")] if point_in_time else []
    limits = [*bounds, *older]
    gated = extreme_gate(scored).withColumn("q_key", query_key("vector", None, limits))
    asked = gated.where("backtested")
    hits = knn_join(
        asked, memory.where("is_settled"), k, q_id=q_id, m_id=m_id, q_vec="vector", m_vec="vector", carry=[ret],
        bounds=limits, **options,
    )
    stats = backtest_stats(hits, asked.select(q_id, "q_key").distinct(), q_id, sim_threshold, ret)
    decided = stats.select(
        q_id, "q_key",
        S.buy_decision(F.col("max_similarity"), F.col("win_rate"), sim_threshold, win_threshold).alias("decision"),
        F.when(
            (F.col("max_similarity") > sim_threshold) & (F.col("win_rate") > win_threshold), F.col("win_rate")
        ).alias("win_rate_calc"),
    )
    return gated.join(decided, [q_id, "q_key"], "left").drop("q_key")
