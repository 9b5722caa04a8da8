"""Versions of the return model: retraining, publishing, scoring, and stops in between."""

import pytest
from pyspark.sql import functions as F

from newsflow import schemas
from newsflow.config import JobConfig
from newsflow.operators import retrain
from newsflow.operators.settle import DAY_MS
from newsflow.sinks import models, tables
from newsflow.sources import streams
from newsflow.streaming import jobs

NOW = 1704067200000
QUICK = dict(trees=3, depth=2)


def remember(spark, cfg, batch, ids, days, settled=True):
    rows = [(f"e{i}", "t", 1 + i % 10, 40.0, 1.0, 100.0, NOW, NOW - days * DAY_MS, [float(i % 7), float(i % 3)], settled, 0.0, (i % 7) / 10) for i in ids]
    tables.write_batch(spark.createDataFrame(rows, schemas.MEMORY), cfg.memory_path, batch)


def ids_of(spark, cfg, settled):
    return {r["event_id"] for r in jobs.current_memory(spark, cfg.memory_path, settled).select("event_id").collect()}


@pytest.fixture
def at(tmp_path):
    cfg = JobConfig(memory_path=str(tmp_path / "memory"), signal_path=str(tmp_path / "scores"), checkpoint_path=str(tmp_path / "c"))
    return cfg, *(str(tmp_path / x) for x in ("settled", "models", "backups"))


def test_retrain_publish_score(spark, at, tmp_path):
    cfg, settled, root, backups = at
    landed = str(tmp_path / "rows")
    asked = spark.createDataFrame([("q1", 5, [1.0, 2.0]), ("q2", None, [1.0, 2.0]), ("q3", 5, [1.0]), ("q4", 5, None), ("q5", 5, [None, 1.0])],
                                  "event_id string, sentiment_score bigint, vector array<float>")
    work = jobs.scoring_batch(cfg, root)

    def score():
        asked.write.mode("append").parquet(landed)
        stream = streams.read_file_stream(spark, landed, asked.schema)
        query = jobs.start_each_batch(stream, work, cfg, "score", available_now=True).start()
        query.awaitTermination(120)
        assert query.exception() is None

    def scores(batch):
        rows = spark.read.parquet(f"{cfg.signal_path}/delta/batch_id={batch}").collect()
        return {r["event_id"]: (r["predicted_return"] is not None, r["model_version"]) for r in rows}

    score()  # before the first model
    assert scores(0) == {f"q{i}": (False, None) for i in range(1, 6)}
    remember(spark, cfg, 0, range(60), 100)
    assert jobs.retrain_run(spark, cfg, settled, root, backups, NOW, min_rows=100, **QUICK) is None and models.latest(spark, root) is None
    remember(spark, cfg, 1, range(60, 120), 100)
    remember(spark, cfg, 2, range(200, 210), 10)
    assert jobs.retrain_run(spark, cfg, settled, root, backups, NOW, **QUICK) == 0
    assert ids_of(spark, cfg, settled) == {f"e{i}" for i in range(200, 210)}
    assert spark.read.parquet(f"{backups}/version=0").count() == 120
    score()
    assert scores(1) == {"q1": (True, 0), **{f"q{i}": (False, 0) for i in range(2, 6)}}
    # a second version is noticed by the running stage
    remember(spark, cfg, 3, range(300, 420), 120)
    assert jobs.retrain_run(spark, cfg, settled, root, backups, NOW, **QUICK) == 1
    score()
    assert {v for _, v in scores(2).values()} == {1}
    assert jobs.retrain_run(spark, cfg, settled, root, backups, NOW, **QUICK) is None


def test_a_run_that_stopped_is_finished_by_the_next(spark, at, monkeypatch):
    cfg, settled, root, backups = at
    remember(spark, cfg, 0, range(120), 100)

    def stop(*args, **options):
        raise RuntimeError("lost")

    # before the version is published: nothing is removed, the next run starts over
    with monkeypatch.context() as m:
        m.setattr(models, "publish", stop)
        with pytest.raises(RuntimeError):
            jobs.retrain_run(spark, cfg, settled, root, backups, NOW, **QUICK)
    assert len(ids_of(spark, cfg, settled)) == 120 and models.latest(spark, root) is None
    # after it: the trained rows are removed by the next run and not trained twice
    with monkeypatch.context() as m:
        m.setattr(jobs, "_purge_trained", stop)
        with pytest.raises(RuntimeError):
            jobs.retrain_run(spark, cfg, settled, root, backups, NOW, **QUICK)
    assert len(ids_of(spark, cfg, settled)) == 120 and models.latest(spark, root)["version"] == 0
    remember(spark, cfg, 1, range(500, 505), 10)
    assert jobs.retrain_run(spark, cfg, settled, root, backups, NOW, **QUICK) is None
    assert ids_of(spark, cfg, settled) == {f"e{i}" for i in range(500, 505)}


def test_predictions_are_those_of_the_model_itself(spark, at):
    cfg, settled, root, backups = at
    remember(spark, cfg, 0, range(120), 100)
    rows = jobs.current_memory(spark, cfg.memory_path, settled)
    model = retrain.fit(retrain.training_set(rows, label="return"), **QUICK)
    models.publish(model, root, 0)
    want = {r["event_id"]: r["predicted_return"] for r in retrain.predict(model, rows).collect()}
    got = models.predict(models.Loaded(root).current(spark), rows).collect()
    assert {r["event_id"]: r["predicted_return"] for r in got} == want and len(want) == 120


def test_the_query_trains_once(spark, sf, monkeypatch):
    from newsflow.plans import catalog

    fits, fit = [], retrain.fit
    monkeypatch.setattr(retrain, "fit", lambda rows, **options: fits.append(1) or fit(rows, trees=1))
    monkeypatch.setattr(catalog.I, "fingerprint", lambda *args: "once")
    first = catalog.QUERIES["predict_return"](spark, sf).orderBy("event_id").collect()
    assert catalog.QUERIES["predict_return"](spark, sf).orderBy("event_id").collect() == first and len(first) == 100
    assert fits == [1] and all(r["predicted_return"] is not None for r in first)


def test_waiting_signals_settle_when_their_event_arrives(spark, at, tmp_path):
    import json
    from dataclasses import replace

    cfg, settled, _, _ = at
    cfg = replace(cfg, reject_path=str(tmp_path / "rejects"))

    def sells(*rows):
        made = [(json.dumps({"action": "SELL", "event_id": e, "buy_price": 100.0, "sell_price": p, "timestamp": 7}), 0, o) for e, p, o in rows]
        return spark.createDataFrame(made, "value string, partition int, offset bigint")

    def run(batch, at_ms, messages):
        jobs.settlement_batch(cfg, settled, now=F.lit(at_ms).cast("bigint"), wait_ms=100)(messages, batch)

    def state():
        rows = jobs.current_memory(spark, cfg.memory_path, settled).where("is_settled").collect()
        return {r["event_id"]: round(r["return"], 6) for r in rows}

    remember(spark, cfg, 0, [1], 10, settled=False)
    run(0, 1000, sells(("e1", 120.0, 2), ("e1", 110.0, 1), ("e2", 130.0, 3), ("e9", 150.0, 4)))
    assert state() == {"e1": 0.1}  # both come at one time: the smaller offset is first
    remember(spark, cfg, 1, [2], 10, settled=False)
    for _ in range(2):  # and once more as a replay
        run(1, 1050, sells(("e2", 190.0, 5)))
        assert state() == {"e1": 0.1, "e2": 0.3}  # the one that waited came first
    run(2, 1200, sells())
    refused = {(r["id"], r["reason"]) for r in spark.read.parquet(f"{cfg.reject_path}/delta").collect()}
    assert refused == {("e9", "event not in memory")}
    remember(spark, cfg, 2, [9], 10, settled=False)
    run(3, 1300, sells())
    assert state() == {"e1": 0.1, "e2": 0.3}
