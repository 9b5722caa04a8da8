"""The streaming jobs: batch operators inside ``foreachBatch``, with replay-safe writes.

Every job writes to tables of its own, one folder per micro-batch, so a batch that runs again
replaces what it wrote before. Model answers are computed once per batch: the stored rows are what
the later steps read.
"""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter

from newsflow import schemas
from newsflow.config import JobConfig
from newsflow.functions import scalars as S
from newsflow.operators import asof, bars as B, decide, enrich, keyed, news, retrain, settle
from newsflow.sinks import models, seen, tables, topics
from newsflow.sources import feeds, streams

SETTLEMENT = T.StructType(
    [T.StructField(n, t) for n, t in (
        ("event_id", T.StringType()), ("rate", T.DoubleType()), ("win", T.DoubleType()),
        ("outcome", T.StringType()), ("settled_at", T.LongType()),
    )]
)
REJECT = T.StructType(
    [T.StructField(n, T.StringType()) for n in ("id", "stage", "reason", "payload")]
)


@dataclass(frozen=True)
class Models:
    """The two outside models of the news jobs."""

    scorer: enrich.ClientFactory
    embedder: enrich.ClientFactory


def start_each_batch(stream: DataFrame, work: Callable[[DataFrame, int], None], cfg: JobConfig, name: str,
                     available_now: bool = False) -> DataStreamWriter:
    """Writer that hands each micro-batch to ``work``; the checkpoint makes restarts safe."""
    writer = stream.writeStream.queryName(name).option("checkpointLocation", f"{cfg.checkpoint_path}/{name}")
    writer = writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=cfg.trigger_interval)
    return writer.foreachBatch(work)


def current_memory(spark: SparkSession, memory_root: str, settle_root: str, before: int | None = None) -> DataFrame:
    """Stored events (or those of the batches before one) with the settlements so far. The settlements are narrow,
    the vectors stay put."""
    rows = tables.read_appended(spark, memory_root, schemas.MEMORY, before)
    done = tables.read_appended(spark, settle_root, SETTLEMENT)
    return settle.apply_settlements(rows, keyed.first_per_key(done, ["event_id"], ["settled_at"]))


def fold_settlements(spark: SparkSession, memory_root: str, settle_root: str) -> int:
    """New memory version with the settlements written into the rows; the settlement log restarts.

    Run it between batches. Stopping half-way is harmless: settlements applied twice change nothing.
    """
    upto = tables.last_batch(spark, memory_root)
    rows = current_memory(spark, memory_root, settle_root)
    version = tables.publish(rows, memory_root, upto, partition_by=["sentiment_score"])
    tables.publish(spark.createDataFrame([], SETTLEMENT), settle_root, tables.last_batch(spark, settle_root))
    return version


def _rejects(rows: DataFrame, stage: str, ident: str = "id") -> DataFrame:
    payload = F.to_json(F.struct(*[f"`{c}`" for c in rows.columns if c not in ("reason", "vector")]))
    return rows.select(
        F.col(ident).cast("string").alias("id"), F.lit(stage).alias("stage"), "reason", payload.alias("payload")
    )


# ---- news intake ----------------------------------------------------------------------------

SEEN_FOR = f"{seen.KEEP_DAYS} days"


def fresh_news(items: DataFrame, now: Column | None = None, horizon: str | None = SEEN_FOR) -> DataFrame:
    """Stream of first sightings that are fresh.

    Stale items count as seen: the duplicates go first. Ids are kept for ``horizon`` after their
    collection time; with None they are kept for ever, and the state grows with the stream.
    """
    if horizon is None:
        once = items.dropDuplicates(["id"])
    else:
        timed = items.withColumn("_at", F.timestamp_millis("es")).withWatermark("_at", horizon)
        once = timed.dropDuplicatesWithinWatermark(["id"]).drop("_at")
    return news.fresh_only(once, F.col("es") if now is None else now)


def rss_intake(responses: DataFrame, now: Column | None = None, horizon: str | None = SEEN_FOR) -> DataFrame:
    """Landed RSS responses ``(url, status, body)`` to JSON news messages."""
    return topics.to_json_value(fresh_news(feeds.rss_items(feeds.landed_ok(responses), now), now, horizon))


def intake_batch(cfg: JobConfig, seen_root: str, order: list[str], now: Column | None = None,
                 keep_days: int = seen.KEEP_DAYS) -> Callable[[DataFrame, int], None]:
    """Work of one batch of items with the ids of the last ``keep_days`` in a table (``sinks.seen``).

    An id repeated very often is reduced before the shuffle, which the state of a stream cannot do.
    ``seen.forget`` takes old days out of the table between batches.
    """

    def work(items: DataFrame, batch_id: int) -> None:
        at = F.col("es") if now is None else now
        dated = items.withColumn("_day", seen.day_of(F.coalesce("es", S.now_ms() if now is None else now)))
        firsts = keyed.first_per_key(dated, ["id"], order).persist()
        known = tables.read_appended(items.sparkSession, seen_root, seen.SEEN, before=batch_id)
        marked = seen.with_last_day(firsts, known, keep_days).persist()
        try:
            fresh = news.fresh_only(marked.where("_seen IS NULL"), at).select(items.columns)
            tables.write_batch(topics.to_json_value(fresh), cfg.signal_path, batch_id)
            seen.remember(marked, seen_root, batch_id)
        finally:
            marked.unpersist()
            firsts.unpersist()

    return work


MARK = T.StructType([T.StructField("last_id", T.LongType())])


def newer_posts_batch(cfg: JobConfig, mark_root: str) -> Callable[[DataFrame, int], None]:
    """Work of one batch of REST posts: forward those above the stored mark, then raise the mark.

    The mark lives in a table, so a restart does not send old posts again.
    """

    def work(posts: DataFrame, batch_id: int) -> None:
        marks = tables.read_appended(posts.sparkSession, mark_root, MARK, before=batch_id)
        mark = marks.agg(F.max("last_id")).scalar()
        new = news.new_above(posts, mark)
        tables.write_batch(topics.to_json_value(new), cfg.signal_path, batch_id)
        tables.write_batch(posts.agg(F.max("id").alias("last_id")), mark_root, batch_id)

    return work


# ---- trading --------------------------------------------------------------------------------

def trading_rows(items: DataFrame, klines: DataFrame, models: Models, cfg: JobConfig,
                 now: Column | None = None) -> DataFrame:
    """News with price features, ``sentiment`` and ``vector`` results (good or failed).

    Features come before the models: news without an earlier bar is never sent to them. ``items``
    is read several times; a stream passes its batch persisted.
    """
    by = ["symbol"] if cfg.symbol is None and "symbol" in items.columns else []
    prices = klines if cfg.symbol is None or "symbol" not in klines.columns else klines.where(F.col("symbol") == cfg.symbol)
    usable = news.require_pubdate(news.clean(items))
    low, high = usable.agg(F.min("pubDate"), F.max("pubDate")).first()
    values = ["rsi_14", "atr_14", "price_at_t"]
    near = asof.reachable_rows(prices.select(*by, "timestamp", *values), "timestamp", by, low or 0, high or 0)
    featured = asof.asof_join(usable, near, "pubDate", "timestamp", by, values)
    scored = enrich.score_news(featured, models.scorer, capacity=cfg.score_capacity, timeout_s=cfg.score_timeout_s, tasks=cfg.call_tasks)
    flat = scored.withColumn("raw_content", F.when(F.col("sentiment.ok"), F.col("summary"))).withColumn(
        "sentiment_es", S.now_ms() if now is None else now
    )
    return enrich.embed(
        flat, "raw_content", models.embedder, capacity=cfg.embed_capacity, timeout_s=cfg.embed_timeout_s, tasks=cfg.call_tasks
    )


def decide_batch(rows: DataFrame, memory: DataFrame, cfg: JobConfig, now: Column | None = None) -> DataFrame:
    """Signals for stored memory rows."""
    asked = rows.drop("is_settled", "win_rate", "return").withColumnsRenamed(
        {"event_id": "id", "pub_date": "pubDate"}
    )
    hits = decide.similar_history(asked, memory, cfg.top_k, point_in_time=cfg.point_in_time)
    stats = decide.backtest_stats(hits, asked.drop("vector"), "id", cfg.sim_threshold)
    return decide.trade_signals(
        stats, cfg.decision_mode, cfg.sim_threshold, cfg.win_rate_threshold, cfg.token, now
    )


def trading_batch(cfg: JobConfig, models: Models, klines: Callable[[], DataFrame], settle_root: str,
                  now: Column | None = None) -> Callable[[DataFrame, int], None]:
    """Work of one micro-batch: remember the embedded news, then decide on the remembered rows."""

    def work(messages: DataFrame, batch_id: int) -> None:
        spark = messages.sparkSession
        parsed = streams.parse_json(messages, schemas.NEWS_ITEM)
        # copies of one item in a batch are one item: asked once, remembered once
        once = keyed.first_per_key(parsed.where("id IS NOT NULL"), ["id"], ["es", "pubDate", "title", "summary"])
        items = once.unionByName(parsed.where("id IS NULL")).persist()
        rows = trading_rows(items, klines(), models, cfg, now).persist()
        try:
            good, no_score = enrich.split_failed(rows, "sentiment")
            good, no_vector = enrich.split_failed(good, "vector")
            good = good.withColumn("sentiment_score", F.col("sentiment.sentiment_score"))
            # texts of any length are kept; only a vector of another model cannot be compared
            kept, oversize = news.split_oversize(tables.with_memory_defaults(good), {}, "vector", cfg.vector_dim)
            tables.write_batch(kept, cfg.memory_path, batch_id)
            if cfg.reject_path:
                refused = _rejects(no_score, "sentiment").unionByName(
                    _rejects(no_vector.drop("sentiment"), "embedding")
                ).unionByName(_rejects(oversize, "memory", "event_id"))
                tables.write_batch(refused, cfg.reject_path, batch_id)
        finally:
            rows.unpersist()
            items.unpersist()
        stored = tables.read_batch(spark, cfg.memory_path, batch_id, schemas.MEMORY)
        signals = decide_batch(stored, current_memory(spark, cfg.memory_path, settle_root), cfg, now)
        tables.write_batch(topics.to_json_value(signals), cfg.signal_path, batch_id)

    return work


# ---- analysis -------------------------------------------------------------------------------

def analysis_batch(cfg: JobConfig, models: Models, now: Column | None = None) -> Callable[[DataFrame, int], None]:
    """Score and embed whole messages, remember them in the older memory shape, write decisions."""

    def work(messages: DataFrame, batch_id: int) -> None:
        spark = messages.sparkSession
        at = S.now_ms() if now is None else now
        asked = messages.select(
            F.xxhash64("value").alias("id"), F.col("value").alias("raw_content"), at.alias("timestamp"),
        )
        scored = enrich.score_news(
            asked, models.scorer, capacity=cfg.analysis_score_capacity, timeout_s=cfg.analysis_score_timeout_s, tasks=cfg.call_tasks, ordered=False, prompt=S.analysis_prompt(F.col("raw_content")),
        )
        good, _ = enrich.split_failed(scored, "sentiment", "drop")
        vectors = enrich.embed(
            good, "raw_content", models.embedder, capacity=cfg.analysis_embed_capacity, timeout_s=cfg.analysis_embed_timeout_s,
            tasks=cfg.call_tasks, ordered=False,
        )
        rows, _ = enrich.split_failed(vectors, "vector", "drop")
        zero = F.lit(0.0).cast("float")
        tables.write_batch(
            rows.select(
                "id", "raw_content", F.col("sentiment.sentiment_score").cast("int").alias("sentiment_score"),
                F.col("sentiment.sentiment_reason").alias("sentiment_reason"), "timestamp", "vector",
                zero.alias("price_at_t"), zero.alias("price_after_24h"), zero.alias("return_24h"),
                F.lit(False).alias("is_settled"),
            ),
            cfg.memory_path, batch_id,
        )
        stored = tables.read_batch(spark, cfg.memory_path, batch_id, schemas.MEMORY_V1)
        memory = tables.read_appended(spark, cfg.memory_path, schemas.MEMORY_V1)
        decided = decide.analysis_decisions(
            stored, memory, sim_threshold=cfg.sim_threshold, win_threshold=cfg.win_rate_threshold
        )
        tables.write_batch(decided.drop("vector"), cfg.signal_path, batch_id)

    return work


# ---- risk log -------------------------------------------------------------------------------

def risk_log_batch(cfg: JobConfig, embedder: enrich.ClientFactory) -> Callable[[DataFrame, int], None]:
    """Embed every log line and append it to the log memory; failed and late calls drop out."""

    def work(messages: DataFrame, batch_id: int) -> None:
        asked = messages.select(F.xxhash64("value").alias("id"), F.col("value").alias("raw_log"))
        rows, _ = enrich.split_failed(
            enrich.embed(
                asked, "raw_log", embedder, capacity=cfg.risk_embed_capacity, timeout_s=cfg.risk_embed_timeout_s,
                tasks=cfg.call_tasks, ordered=False,
            ), "vector", "drop",
        )
        fields = rows.select("id", "raw_log", "vector", F.lit(None).cast("map<string,string>").alias("extra"))
        tables.write_batch(fields, cfg.memory_path, batch_id)

    return work


# ---- employees ------------------------------------------------------------------------------

def employee_batch(cfg: JobConfig, order: list[str], partitions: int) -> Callable[[DataFrame, int], None]:
    """One read of the topic feeds both sinks: the keyed table and the message sink."""

    def work(rows: DataFrame, batch_id: int) -> None:
        cols = schemas.EMPLOYEE.fieldNames()
        rows = rows.persist()
        try:
            tables.write_batch(keyed.latest_per_key(rows, ["id"], order).select(cols), cfg.memory_path, batch_id)
            values = topics.to_json_value(rows.select(cols))
            tables.write_batch(topics.round_robin(values, partitions), cfg.signal_path, batch_id)
        finally:
            rows.unpersist()

    return work


# ---- klines ---------------------------------------------------------------------------------

def kline_run(spark: SparkSession, bars: DataFrame, cfg: JobConfig, run_id: int, limit: int = 100) -> None:
    """Features of the fetched bars, replacing stored rows of the same symbol and minute."""
    features = B.kline_features(bars, ["symbol"], limit=limit)
    tables.write_batch(features, cfg.kline_path, run_id)


KLINE_TABLE = T.StructType([T.StructField("symbol", T.StringType()), *schemas.KLINE_FEATURES.fields])


def read_klines(spark: SparkSession, cfg: JobConfig) -> DataFrame:
    return tables.read_current(spark, cfg.kline_path, KLINE_TABLE, ["symbol", "timestamp"])


# ---- settlement -----------------------------------------------------------------------------

PENDING = T.StructType(
    [T.StructField(n, t) for n, t in (
        ("event_id", T.StringType()), ("buy_price", T.DoubleType()), ("sell_price", T.DoubleType()),
        ("_order", T.ArrayType(T.LongType())), ("since", T.LongType()),
    )]
)


def _arrival(messages: DataFrame, signals: DataFrame, order: str) -> Column:
    """Place of a signal as numbers that a replay gives again: (partition, offset) of its message when it has
    them, else its time; signals of one time follow a hash of their prices, and equal ones settle alike."""
    if {"partition", "offset"} <= set(messages.columns):
        places = ["partition", "offset"]
    else:
        places = [order]
    cells = [F.col(c).cast("bigint") for c in places]
    return F.array(*cells, F.xxhash64("buy_price", "sell_price"))


def settlement_batch(cfg: JobConfig, settle_root: str, order: str = "timestamp", now: Column | None = None,
                     wait_ms: int = settle.DAY_MS) -> Callable[[DataFrame, int], None]:
    """First usable SELL per event settles its memory row; later ones find it settled.

    A SELL whose event is not in memory waits and is tried again with every batch, ahead of newer ones; after
    ``wait_ms`` it goes to the rejects. What waits is written whole by each batch, one row per event, so a
    replay starts from what the batch before it left.
    """

    def work(messages: DataFrame, batch_id: int) -> None:
        spark = messages.sparkSession
        places = [c for c in ("partition", "offset") if c in messages.columns]
        signals = streams.trade_signals(messages, keep=places)
        # a replayed batch must not see its own earlier try
        seen_before = tables.read_appended(spark, settle_root, SETTLEMENT, before=batch_id)
        memory = settle.apply_settlements(
            tables.read_appended(spark, cfg.memory_path, schemas.MEMORY),
            keyed.first_per_key(seen_before, ["event_id"], ["settled_at"]),
        )
        at = S.now_ms() if now is None else now
        usable, refused = settle.sell_signals(signals)
        fresh = usable.select(
            F.col("event_id").cast("string").alias("event_id"), "buy_price", "sell_price",
            _arrival(messages, usable, order).alias("_order"), at.cast("bigint").alias("since"),
        )
        waiting = tables.read_batch(spark, f"{settle_root}/waiting", batch_id - 1, PENDING)
        # all that waits came before this batch
        first = keyed.first_per_key(
            waiting.withColumn("_new", F.lit(0)).unionByName(fresh.withColumn("_new", F.lit(1))), ["event_id"], ["_new", "since", "_order"]
        ).persist()
        asked = first.withColumn("action", F.lit("SELL"))
        found = settle.settlements(asked, memory, "since").persist()
        try:
            done = found.where("outcome = 'settled'")
            tables.write_batch(done.withColumn("settled_at", at), settle_root, batch_id)
            unknown = first.join(found.where("outcome = 'not_found'").select("event_id"), "event_id", "left_semi")
            late = F.col("since") + wait_ms <= at
            tables.write_batch(unknown.where(~late).select(PENDING.fieldNames()), f"{settle_root}/waiting", batch_id)
            if cfg.reject_path:
                gone = unknown.where(late).withColumn("reason", F.lit("event not in memory")).drop("_new")
                bad = _rejects(refused, "settlement", "event_id").unionByName(_rejects(gone, "settlement", "event_id"))
                tables.write_batch(bad, cfg.reject_path, batch_id)
        finally:
            found.unpersist()
            first.unpersist()

    return work


# ---- return model ---------------------------------------------------------------------------

def _purge_trained(spark: SparkSession, cfg: JobConfig, settle_root: str, backup: str) -> None:
    """Publish the memory without the rows of a backup; batches written meanwhile stay."""
    upto = tables.last_batch(spark, cfg.memory_path)
    memory = current_memory(spark, cfg.memory_path, settle_root, before=upto + 1)
    trained = spark.read.schema(memory.schema).parquet(backup).select("event_id")
    if not memory.join(trained, "event_id", "left_semi").isEmpty():
        kept = memory.join(trained, "event_id", "left_anti").select(memory.columns)
        tables.publish(kept, cfg.memory_path, upto, partition_by=["sentiment_score"])


def retrain_run(spark: SparkSession, cfg: JobConfig, settle_root: str, model_root: str, backup_dir: str, now_ms: int, *,
                min_rows: int = 100, **fit_options) -> int | None:
    """Back up the training window, train on the backup, publish the next model version, then the memory without
    the trained rows.

    A run may stop anywhere: until the version is published nothing has been removed and the next run starts
    over; after it, the next run first removes what the last version was trained on. Returns the new version,
    or None when the window has too few rows.
    """
    last = models.latest(spark, model_root)
    if last is not None:
        _purge_trained(spark, cfg, settle_root, last["backup"])
    memory = current_memory(spark, cfg.memory_path, settle_root)
    window = retrain.training_window(memory, F.lit(now_ms).cast("bigint"), "sentiment_es")
    if not retrain.enough(window, min_rows):
        return None
    version = 0 if last is None else last["version"] + 1
    backup = f"{backup_dir}/version={version}"
    window.write.mode("overwrite").parquet(backup)  # an earlier try of this version removed nothing
    saved = spark.read.schema(memory.schema).parquet(backup)
    models.publish(retrain.fit(retrain.training_set(saved, label="return"), **fit_options), model_root, version, backup)
    _purge_trained(spark, cfg, settle_root, backup)
    return version


def scoring_batch(cfg: JobConfig, model_root: str) -> Callable[[DataFrame, int], None]:
    """Work of one batch of embedded rows: predicted return by the newest model version, and which one it was.

    The version is looked up for every batch and the model is loaded when it changed.
    """
    loaded = models.Loaded(model_root)

    def work(rows: DataFrame, batch_id: int) -> None:
        tables.write_batch(models.predict(loaded.current(rows.sparkSession), rows), cfg.signal_path, batch_id)

    return work
