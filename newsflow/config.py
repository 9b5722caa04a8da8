"""Job settings as one frozen dataclass; nothing secret has a default."""

from __future__ import annotations

import argparse
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, fields


@dataclass(frozen=True)
class JobConfig:
    # brokers and topics
    kafka_servers: str = "localhost:9092"
    kafka_group: str = "newsflow"
    source_topic: str = "news_stream"
    sink_topic: str = "trade_signals"
    starting_offsets: str = "latest"
    max_offsets_per_trigger: int | None = None
    min_partitions: int | None = None
    # relational store
    jdbc_url: str | None = None
    jdbc_user: str | None = None
    jdbc_password: str | None = None
    jdbc_table: str | None = None
    # tables in shared storage
    memory_path: str | None = None
    kline_path: str | None = None
    signal_path: str | None = None
    reject_path: str | None = None
    checkpoint_path: str | None = None
    # fixed values: seconds, and calls in flight over the whole cluster, of each stage that asks a model
    score_timeout_s: float = 120.0
    score_capacity: int = 2
    embed_timeout_s: float = 10.0
    embed_capacity: int = 50
    analysis_score_timeout_s: float = 60.0
    analysis_score_capacity: int = 20
    analysis_embed_timeout_s: float = 30.0
    analysis_embed_capacity: int = 50
    risk_embed_timeout_s: float = 30.0
    risk_embed_capacity: int = 100
    # tasks that share a stage's calls
    call_tasks: int = 8
    # back-test and decision
    top_k: int = 5
    sim_threshold: float = 0.9
    win_rate_threshold: float = 0.65
    decision_mode: str = "strict"
    point_in_time: bool = True
    token: str = "ETH"
    symbol: str | None = None
    vector_dim: int = 768
    # what a started job reads ("kafka" or "files") and where its messages go besides its table ("table", "kafka", "files")
    source: str = "kafka"
    input_path: str | None = None
    max_files: int | None = None
    source_type: str = "rest"
    sink: str = "table"
    output_path: str | None = None
    sink_partitions: int = 8
    # tables of single jobs
    seen_path: str | None = None
    settle_path: str | None = None
    model_path: str | None = None
    backup_path: str | None = None
    # outside models
    score_url: str | None = None
    score_model: str | None = None
    embed_url: str | None = None
    embed_model: str | None = None
    # triggers
    trigger_interval: str = "5 seconds"
    available_now: bool = False

    @classmethod
    def from_mapping(cls, values: Mapping[str, object]) -> "JobConfig":
        """Build from a dict, rejecting unknown keys and casting text to the field's type."""
        known = {f.name: f for f in fields(cls)}
        unknown = sorted(set(values) - set(known))
        if unknown:
            raise ValueError(f"unknown settings: {unknown}")
        return cls(**{k: _coerce(str(known[k].type), v) for k, v in values.items()})

    @classmethod
    def from_args(cls, argv: Sequence[str]) -> "JobConfig":
        """Build from command-line words such as ``--top_k 5``."""
        parser = argparse.ArgumentParser(allow_abbrev=False)
        for f in fields(cls):
            parser.add_argument(f"--{f.name}", default=argparse.SUPPRESS)
        return cls.from_mapping(vars(parser.parse_args(list(argv))))


def _coerce(type_name: str, value: object) -> object:
    if not isinstance(value, str):
        return value
    if type_name.startswith("bool"):
        return value.strip().lower() in ("1", "true", "yes")
    if type_name.startswith("int"):
        return int(value)
    if type_name.startswith("float"):
        return float(value)
    return value
