"""Start a job by its name: ``python -m newsflow.streaming.main trading --memory_path ... --kline_path ...``.

A job reads its topic, or landed files with ``--source files --input_path ...``; it stores what it makes in its tables, and
sends its messages on to ``--sink`` (a topic, or files that the next job can read). Messages are sent from
what the table stored, so a batch that runs again sends the same ones. Streams run until they are stopped, or with
``--available_now true`` until they have read all there is; ``klines`` and ``retrain`` run once, for a timer outside.
"""

from __future__ import annotations

import sys
import time
from collections.abc import Callable, Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import types as T
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from newsflow import schemas
from newsflow.config import JobConfig
from newsflow.operators import enrich
from newsflow.session import configure
from newsflow.sinks import tables, topics
from newsflow.sources import feeds, posts, streams
from newsflow.streaming import jobs, stateful

MESSAGE = T.StructType([T.StructField("value", T.StringType())])
TICK_BAR = T.StructType([T.StructField("symbol", T.StringType()), *schemas.KLINE.fields])
Work = Callable[[DataFrame, int], None]


def messages(spark: SparkSession, cfg: JobConfig, tuned: bool = False) -> DataFrame:
    """Stream of the messages of the configured source (``value``; ``partition`` and ``offset`` from a topic)."""
    if cfg.source == "kafka":
        return streams.read_kafka(spark, cfg, tuned)
    if cfg.source == "files":
        return streams.read_text_stream(spark, cfg.input_path, cfg.max_files)
    raise ValueError("source is one of kafka, files")


def sending(work: Work, cfg: JobConfig) -> Work:
    """``work``, then the messages that it stored for the batch go to the sink."""

    def both(batch: DataFrame, batch_id: int) -> None:
        work(batch, batch_id)
        topics.send(tables.read_batch(batch.sparkSession, cfg.signal_path, batch_id, MESSAGE), cfg, batch_id)

    return both


def served_models(cfg: JobConfig) -> jobs.Models:
    """The models behind the configured addresses."""
    missing = [n for n in ("score_url", "score_model", "embed_url", "embed_model") if not getattr(cfg, n)]
    if missing:
        raise ValueError(f"settings missing: {missing}")
    return jobs.Models(
        enrich.http_client(cfg.score_url, cfg.score_model, "response", max(cfg.score_timeout_s, cfg.analysis_score_timeout_s)),
        enrich.http_client(cfg.embed_url, cfg.embed_model, "embedding", max(cfg.embed_timeout_s, cfg.analysis_embed_timeout_s, cfg.risk_embed_timeout_s)),
    )


# ---- streams: each gives its writer ---------------------------------------------------------

def _started(stream: DataFrame, work: Work, cfg: JobConfig, name: str) -> DataStreamWriter:
    return jobs.start_each_batch(stream, work, cfg, name, cfg.available_now)


def rss(spark: SparkSession, cfg: JobConfig, models: jobs.Models | None) -> DataStreamWriter:
    """Landed feed responses, one JSON text each, to news messages seen for the first time."""
    responses = streams.parse_json(messages(spark, cfg), schemas.WEB_RESPONSE)
    items = feeds.rss_items(feeds.landed_ok(responses))
    return _started(items, sending(jobs.intake_batch(cfg, cfg.seen_path, ["es", "pubDate", "title", "source"]), cfg), cfg, "rss")


def rest_posts(spark: SparkSession, cfg: JobConfig, models: jobs.Models | None) -> DataStreamWriter:
    """New posts of the pages landed below ``input_path`` (``sources.posts``)."""

    def work(rows: DataFrame, batch_id: int) -> None:
        tables.write_batch(topics.to_json_value(posts.once(rows)), cfg.signal_path, batch_id)

    found = posts.new_posts(posts.read_pages(spark, cfg.input_path), cfg.source_type)
    return _started(found, sending(work, cfg), cfg, "posts")


def trading(spark: SparkSession, cfg: JobConfig, models: jobs.Models | None) -> DataStreamWriter:
    work = jobs.trading_batch(cfg, models or served_models(cfg), lambda: jobs.read_klines(spark, cfg), cfg.settle_path)
    return _started(messages(spark, cfg), sending(work, cfg), cfg, "trading")


def analysis(spark: SparkSession, cfg: JobConfig, models: jobs.Models | None) -> DataStreamWriter:
    return _started(messages(spark, cfg, tuned=True), jobs.analysis_batch(cfg, models or served_models(cfg)), cfg, "analysis")


def risk_log(spark: SparkSession, cfg: JobConfig, models: jobs.Models | None) -> DataStreamWriter:
    return _started(messages(spark, cfg), jobs.risk_log_batch(cfg, (models or served_models(cfg)).embedder), cfg, "risk_log")


def employees(spark: SparkSession, cfg: JobConfig, models: jobs.Models | None) -> DataStreamWriter:
    rows = streams.employees(messages(spark, cfg))
    return _started(rows, sending(jobs.employee_batch(cfg, ["message_time"], cfg.sink_partitions), cfg), cfg, "employees")


def settlement(spark: SparkSession, cfg: JobConfig, models: jobs.Models | None) -> DataStreamWriter:
    return _started(messages(spark, cfg), jobs.settlement_batch(cfg, cfg.settle_path), cfg, "settlement")


def age_settlement(spark: SparkSession, cfg: JobConfig, models: jobs.Models | None) -> DataStreamWriter:
    """Events of the memory table settle a day later at the prices of the kline table, whose bars move the time on."""
    stateful.use_rocksdb(spark)
    remembered = streams.read_file_stream(spark, f"{cfg.memory_path}/delta", schemas.MEMORY)
    bars = streams.read_file_stream(spark, f"{cfg.kline_path}/delta", jobs.KLINE_TABLE)
    due = stateful.due_events(stateful.pending_events(remembered, cfg.symbol), bars)
    return _started(due, stateful.age_settlement_batch(cfg, cfg.settle_path, lambda: jobs.read_klines(spark, cfg)), cfg, "age_settlement")


def scoring(spark: SparkSession, cfg: JobConfig, models: jobs.Models | None) -> DataStreamWriter:
    """Predicted returns of remembered rows by the newest model."""
    remembered = streams.read_file_stream(spark, f"{cfg.memory_path}/delta", schemas.MEMORY)
    return _started(remembered, jobs.scoring_batch(cfg, cfg.model_path), cfg, "scoring")


# ---- runs: these end by themselves ----------------------------------------------------------

def klines(spark: SparkSession, cfg: JobConfig, models: jobs.Models | None) -> None:
    """Features of the fetched bars in ``input_path`` into the kline table."""
    bars = spark.read.schema(TICK_BAR).parquet(cfg.input_path)
    jobs.kline_run(spark, bars, cfg, tables.last_batch(spark, cfg.kline_path) + 1)


def retrain(spark: SparkSession, cfg: JobConfig, models: jobs.Models | None) -> None:
    jobs.retrain_run(spark, cfg, cfg.settle_path, cfg.model_path, cfg.backup_path, int(time.time() * 1000))


@dataclass(frozen=True)
class Job:
    build: Callable[[SparkSession, JobConfig, jobs.Models | None], DataStreamWriter | None]
    needs: tuple[str, ...]


JOBS = {
    "rss": Job(rss, ("seen_path", "signal_path", "checkpoint_path")),
    "posts": Job(rest_posts, ("input_path", "signal_path", "checkpoint_path")),
    "trading": Job(trading, ("memory_path", "kline_path", "settle_path", "signal_path", "checkpoint_path")),
    "analysis": Job(analysis, ("memory_path", "signal_path", "checkpoint_path")),
    "risk_log": Job(risk_log, ("memory_path", "checkpoint_path")),
    "employees": Job(employees, ("memory_path", "signal_path", "checkpoint_path")),
    "settlement": Job(settlement, ("memory_path", "settle_path", "checkpoint_path")),
    "age_settlement": Job(age_settlement, ("memory_path", "kline_path", "settle_path", "symbol", "checkpoint_path")),
    "scoring": Job(scoring, ("memory_path", "model_path", "signal_path", "checkpoint_path")),
    "klines": Job(klines, ("input_path", "kline_path")),
    "retrain": Job(retrain, ("memory_path", "settle_path", "model_path", "backup_path")),
}


def start(spark: SparkSession, name: str, cfg: JobConfig, models: jobs.Models | None = None) -> StreamingQuery | None:
    """Start a stream and return it, or do a run. ``models`` stands in for the configured addresses."""
    job = JOBS[name]
    wanted = [*job.needs, *(["input_path"] if cfg.source == "files" and job.build in READERS else []), *(["output_path"] if cfg.sink == "files" else [])]
    missing = sorted({n for n in wanted if getattr(cfg, n) is None})
    if missing:
        raise ValueError(f"settings missing: {missing}")
    writer = job.build(spark, cfg, models)
    return None if writer is None else writer.start()


#: Jobs that read messages.
READERS = (rss, trading, analysis, risk_log, employees, settlement)


def main(argv: Sequence[str] | None = None) -> None:
    words = list(sys.argv[1:] if argv is None else argv)
    if not words or words[0] not in JOBS:
        raise SystemExit(f"usage: python -m newsflow.streaming.main {{{','.join(JOBS)}}} [--setting value ...]")
    cfg = JobConfig.from_args(words[1:])
    spark = configure(SparkSession.builder.appName(f"newsflow-{words[0]}").getOrCreate())
    query = start(spark, words[0], cfg)
    if query is not None:
        query.awaitTermination()


if __name__ == "__main__":
    main()
