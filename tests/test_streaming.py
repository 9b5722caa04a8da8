"""Jobs over landed files: equal to batch, and safe to run again."""

import json

import pytest
from pyspark.sql import functions as F

from newsflow import schemas
from newsflow.config import JobConfig
from newsflow.operators import decide, enrich, news
from newsflow.sinks import tables
from newsflow.sources import feeds, streams
from newsflow.streaming import jobs

DIM = 16
T0 = 1704067200000
MODELS = jobs.Models(enrich.digest_scorer, enrich.hashed_words_embedder(DIM))


@pytest.fixture
def land(tmp_path):
    folder = tmp_path / "in"
    folder.mkdir()

    def write(name, messages):
        (folder / name).write_text("".join((m if isinstance(m, str) else json.dumps(m)) + "\n" for m in messages))

    return str(folder), write


def config(tmp_path, **changes):
    base = dict(
        memory_path=str(tmp_path / "memory"), signal_path=str(tmp_path / "signals"), reject_path=str(tmp_path / "rejects"),
        kline_path=str(tmp_path / "klines"), checkpoint_path=str(tmp_path / "checkpoints"), vector_dim=DIM,
        decision_mode="score_only",
    )
    return JobConfig(**{**base, **changes})


def run(writer):
    query = writer.start()
    query.awaitTermination(120)
    assert query.exception() is None


def klines(spark):
    rows = [(T0 + 60000 * i, 100.0 + i, 40.0, 1.0) for i in range(3)]
    return spark.createDataFrame(rows, "timestamp bigint, price_at_t double, rsi_14 double, atr_14 double")


def item(i, **changes):
    return {"id": f"n{i}", "title": f"title {i}", "summary": f"words of item {i}", "pubDate": T0 + 60000 * i, "source": "s", "es": T0, **changes}


def test_trading_job(spark, tmp_path, land):
    folder, write = land
    cfg, settled = config(tmp_path), str(tmp_path / "settled")
    now = F.lit(T0 + 10 ** 9).cast("bigint")
    work = jobs.trading_batch(cfg, MODELS, lambda: klines(spark), settled, now)

    def go():
        source = streams.read_text_stream(spark, folder, max_files=1)
        run(jobs.start_each_batch(source, work, cfg, "trading", available_now=True))

    write("a.txt", [item(0), item(1), item(2, title=" \t"), item(3, pubDate=None), item(1), item(4, pubDate=T0 - 1), item(5, title="x" * 600)])
    write("b.txt", [item(6, summary=None), "not json"])
    go()
    memory = tables.read_appended(spark, cfg.memory_path, schemas.MEMORY)
    stored = {r["event_id"]: r for r in memory.collect()}
    assert set(stored) == {"n0", "n1", "n5", "n6"} and stored["n5"]["title"] == "x" * 600
    assert stored["n1"]["price_at_t"] == 101.0 and not stored["n1"]["is_settled"] and stored["n1"]["return"] == 0.0
    values = [json.loads(r["value"]) for r in spark.read.parquet(f"{cfg.signal_path}/delta").collect()]
    assert {v["event_id"] for v in values} == set(stored)
    assert all("sell_time" not in v and v["token"] == "ETH" for v in values)
    assert {v["event_id"]: v["action"] for v in values} == {
        k: "BUY" if r["sentiment_score"] > 8 else "SELL" if r["sentiment_score"] < 2 else "HOLD" for k, r in stored.items()}
    rejects = spark.read.parquet(f"{cfg.reject_path}/delta").collect()
    assert rejects == []  # a long title costs neither the memory row nor the signal

    # same checkpoint: nothing new. new file: one more row. replayed batch: no duplicates.
    go()
    write("c.txt", [item(7)])
    go()
    assert tables.read_appended(spark, cfg.memory_path, schemas.MEMORY).count() == 5
    work(spark.createDataFrame([(json.dumps(item(7)),)], "value string"), 2)
    assert tables.read_appended(spark, cfg.memory_path, schemas.MEMORY).count() == 5
    assert spark.read.parquet(f"{cfg.signal_path}/delta").count() == 5


def test_model_failures_reach_the_reject_table(spark, tmp_path):
    def scorer():
        def call(text):
            if "item 1" in text:
                raise RuntimeError("down")
            return "no object" if "item 2" in text else '{"sentiment_score": 9, "sentiment_reason": "r"}'

        return call

    cfg = config(tmp_path)
    work = jobs.trading_batch(cfg, jobs.Models(scorer, MODELS.embedder), lambda: klines(spark), str(tmp_path / "settled"))
    work(spark.createDataFrame([(json.dumps(item(i)),) for i in range(3)], "value string"), 0)
    assert [r["event_id"] for r in tables.read_appended(spark, cfg.memory_path, schemas.MEMORY).collect()] == ["n0"]
    got = {r["id"]: (r["stage"], r["reason"]) for r in spark.read.parquet(f"{cfg.reject_path}/delta").collect()}
    assert got == {"n1": ("sentiment", "RuntimeError: down"), "n2": ("sentiment", "no readable object")}


def remembered(spark, cfg, ids):
    rows = [(i, "t", 9, 40.0, 1.0, 100.0, T0, T0, [1.0] * DIM, False, 0.0, 0.0) for i in ids]
    tables.write_batch(spark.createDataFrame(rows, schemas.MEMORY), cfg.memory_path, 0)


def test_settlement_job_and_its_use_in_decisions(spark, tmp_path, land):
    folder, write = land
    cfg, settled = config(tmp_path, decision_mode="strict"), str(tmp_path / "settled")
    remembered(spark, cfg, ["a", "b", "c"])
    sell = {"action": "SELL", "buy_price": 100.0}
    write("1.txt", [{**sell, "event_id": "a", "sell_price": 110.0, "timestamp": 1}, {**sell, "event_id": "a", "sell_price": 1.0, "timestamp": 2},
                    {"action": "BUY", "event_id": "b", "timestamp": 3}, {**sell, "event_id": "b", "buy_price": 0.0, "sell_price": 5.0, "timestamp": 4}])
    work = jobs.settlement_batch(cfg, settled, now=F.lit(5).cast("bigint"))

    def go():
        run(jobs.start_each_batch(streams.read_text_stream(spark, folder, 1), work, cfg, "settle", available_now=True))

    go()
    write("2.txt", [{**sell, "event_id": "a", "sell_price": 50.0, "timestamp": 9}, {**sell, "event_id": "c", "sell_price": 90.0, "timestamp": 9}])
    go()

    def state():
        return {r["event_id"]: (r["is_settled"], r["return"], r["win_rate"]) for r in jobs.current_memory(spark, cfg.memory_path, settled).collect()}

    want = {"a": (True, pytest.approx(0.1), 1.0), "b": (False, 0.0, 0.0), "c": (True, pytest.approx(-0.1), 0.0)}
    assert state() == want
    # a replay of the first batch does not take its own result for an earlier settlement
    work(spark.read.text(f"{folder}/1.txt"), 0)
    assert state() == want
    refused = spark.read.parquet(f"{cfg.reject_path}/delta").collect()
    assert ("b", "buy_price not positive") in {(r["id"], r["reason"]) for r in refused}
    # folding keeps the state and later batches
    jobs.fold_settlements(spark, cfg.memory_path, settled)
    assert state() == want
    assert tables.read_appended(spark, settled, jobs.SETTLEMENT).count() == 0
    work(spark.read.text(f"{folder}/2.txt"), 1)
    assert state() == want

    query = spark.createDataFrame([("q", "t", 9, 40.0, 1.0, 100.0, T0 + 5, T0 + 5, [1.0] * DIM, False, 0.0, 0.0)], schemas.MEMORY)
    memory = jobs.current_memory(spark, cfg.memory_path, settled)
    assert jobs.decide_batch(query, memory, cfg).count() == 0  # win rate is one half
    looser = JobConfig(win_rate_threshold=0.4)
    assert [r["event_id"] for r in jobs.decide_batch(query, memory, looser).collect()] == ["q"]


def test_analysis_job(spark, tmp_path, land):
    folder, write = land
    cfg = config(tmp_path)
    write("1.txt", [f"message number {i}" for i in range(12)])
    source = streams.read_text_stream(spark, folder)
    work = jobs.analysis_batch(cfg, MODELS, F.lit(5).cast("bigint"))
    run(jobs.start_each_batch(source, work, cfg, "analysis", available_now=True))
    memory = tables.read_appended(spark, cfg.memory_path, schemas.MEMORY_V1).collect()
    assert len(memory) == 12 and all(len(r["vector"]) == DIM and not r["is_settled"] for r in memory)
    decisions = spark.read.parquet(f"{cfg.signal_path}/delta").collect()
    assert len(decisions) == 12
    for r in decisions:
        assert r["decision"] == (None if 3 < r["sentiment_score"] < 8 else "HOLD")


def test_analysis_buys_on_winning_history(spark):
    cols = "id bigint, sentiment_score int, vector array<float>, is_settled boolean, return_24h float"
    memory = spark.createDataFrame([(i, 9, [1.0, 0.0], True, 1.0 if i < 8 else -1.0) for i in range(10)], cols)
    asked = spark.createDataFrame([(100, 9, [1.0, 0.0], False, 0.0), (101, 5, [1.0, 0.0], False, 0.0)], cols)
    got = {r["id"]: (r["decision"], r["win_rate_calc"]) for r in decide.analysis_decisions(asked, memory).collect()}
    assert got == {100: ("EXECUTE_BUY", 0.8), 101: (None, None)}


def test_risk_log_job(spark, tmp_path, land):
    folder, write = land
    cfg = config(tmp_path)
    write("1.txt", ["login failed", "login failed again", "", "x " * 5000])
    work = jobs.risk_log_batch(cfg, MODELS.embedder)
    run(jobs.start_each_batch(streams.read_text_stream(spark, folder), work, cfg, "risk", available_now=True))
    rows = tables.read_appended(spark, cfg.memory_path, schemas.LOG_MEMORY).collect()
    assert {r["raw_log"] for r in rows} == {"login failed", "login failed again", "x " * 5000}  # of any length


def test_employee_job_upserts_and_forwards(spark, tmp_path, land):
    folder, write = land
    cfg = config(tmp_path)

    def employee(i, salary, at):
        return {"id": i, "name": f"e{i}", "department": "d", "salary": salary, "message_time": f"2024-01-01T00:00:{at:02d}Z"}

    write("1.txt", [employee(1, 10.0, 1), employee(1, 20.0, 5), employee(2, 1.0, 1)])
    work = jobs.employee_batch(cfg, ["message_time"], 3)

    def go():
        rows = streams.employees(streams.read_text_stream(spark, folder, 1))
        run(jobs.start_each_batch(rows, work, cfg, "employees", available_now=True))

    go()
    write("2.txt", [employee(1, 30.0, 9), employee(3, 3.0, 1)])
    go()
    current = tables.read_current(spark, cfg.memory_path, schemas.EMPLOYEE, ["id"])
    assert {r["id"]: r["salary"] for r in current.collect()} == {1: 30.0, 2: 1.0, 3: 3.0}
    assert spark.read.parquet(f"{cfg.signal_path}/delta").count() == 5


def test_kline_runs_replace_rows_of_the_same_minute(spark, tmp_path):
    cfg = config(tmp_path)

    def bars(start, n, shift):
        rows = [("ETH", T0 + 60000 * i, 1.0, 2.0 + i % 3, 1.0, 1.0 + (i * 7) % 5 + shift, 1.0) for i in range(start, start + n)]
        return spark.createDataFrame(rows, "symbol string, timestamp bigint, open double, high double, low double, close double, volume double")

    jobs.kline_run(spark, bars(0, 40, 0.0), cfg, 0)
    jobs.kline_run(spark, bars(20, 40, 0.5), cfg, 1)
    stored = {r["timestamp"]: r["close"] for r in jobs.read_klines(spark, cfg).collect()}
    assert len(stored) == 46  # minutes 14..59; each run drops its own warm-up
    assert stored[T0 + 60000 * 14] == 4.0 and stored[T0 + 60000 * 50] == 1.5


def test_rss_intake_equals_batch(spark, tmp_path):
    def body(*items):
        inner = "".join(f"<item><title>{t}</title><link>l</link><pubDate>{d}</pubDate></item>" for t, d in items)
        return f"<rss><channel>{inner}</channel></rss>"

    fresh, stale = "Mon, 01 Jan 2024 00:00:00 GMT", "Sun, 31 Dec 2023 00:00:00 GMT"
    schema = "url string, status int, body string"
    folder = str(tmp_path / "feeds")
    for batch in ([("u1", 200, body(("a", fresh), ("b", stale), ("c", "")))], [("u2", 200, body(("a", fresh), ("b", fresh))), ("u3", 404, body(("z", fresh)))]):
        spark.createDataFrame(batch, schema).coalesce(1).write.mode("append").parquet(folder)
    now = F.lit(T0 + 60000).cast("bigint")
    stream = streams.read_file_stream(spark, folder, spark.read.parquet(folder).schema, max_files=1)
    query = (jobs.rss_intake(stream, now).writeStream.format("memory").queryName("intake").outputMode("append")
             .option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    query.awaitTermination(120)
    got = sorted(json.loads(r["value"])["title"] for r in spark.table("intake").collect())
    assert got == ["a", "c"]  # "b" was first seen stale, its fresh copy stays dropped

    items = feeds.rss_items(feeds.landed_ok(spark.read.parquet(folder)), now).withColumn("o", F.col("source"))
    batch = news.fresh_only(news.dedup_new(items, None, ["o"]), now)
    assert sorted(r["title"] for r in batch.collect()) == got


def test_dedup_with_horizon_and_counts(spark, tmp_path):
    folder = str(tmp_path / "items")
    for rows in ([("x", T0), ("x", T0 + 1), ("y", T0)], [("x", T0 + 2), ("z", T0 + 3)]):
        data = [(i, "t", "s", 0, "src", es) for i, es in rows]
        spark.createDataFrame(data, schemas.NEWS_ITEM).coalesce(1).write.mode("append").parquet(folder)
    stream = streams.read_file_stream(spark, folder, schemas.NEWS_ITEM, max_files=1)
    once = jobs.fresh_news(stream, horizon="1 hour")
    query = (once.writeStream.format("memory").queryName("once").option("checkpointLocation", str(tmp_path / "c1"))
             .trigger(availableNow=True).start())
    query.awaitTermination(120)
    assert sorted(r["id"] for r in spark.table("once").collect()) == ["x", "y", "z"]

    counts = news.count_by(stream, "source")
    query = (counts.writeStream.format("memory").queryName("counts").outputMode("complete")
             .option("checkpointLocation", str(tmp_path / "c2")).trigger(availableNow=True).start())
    query.awaitTermination(120)
    assert [tuple(r) for r in spark.table("counts").collect()] == [("src", 5)]


def test_intake_with_a_table_of_seen_ids(spark, tmp_path):
    cfg, seen = config(tmp_path), str(tmp_path / "seen")
    work = jobs.intake_batch(cfg, seen, ["es"], F.lit(T0).cast("bigint"))
    old = T0 - 10 ** 8

    def items(*rows):
        return spark.createDataFrame([(i, "t", "s", p, "src", es) for i, p, es in rows], schemas.NEWS_ITEM)

    first = items(("x", 0, 1), ("x", 0, 2), ("stale", old, 3))
    work(first, 0)
    work(items(("x", 0, 4), ("stale", T0, 5), ("y", T0, 6)), 1)
    work(first, 0)  # replay
    got = [json.loads(r["value"])["id"] for r in spark.read.parquet(f"{cfg.signal_path}/delta").collect()]
    assert sorted(got) == ["x", "y"]


def test_posts_above_the_stored_mark(spark, tmp_path):
    cfg, marks = config(tmp_path), str(tmp_path / "marks")

    def posts(*ids):
        return spark.createDataFrame([(i, "t", "d", "u", "p", "rest") for i in ids], schemas.NEWS_REST)

    work = jobs.newer_posts_batch(cfg, marks)
    work(posts(3, 2, 1), 0)
    work(posts(5, 4, 3), 1)
    work(posts(5, 4, 3), 1)  # replay
    work(posts(), 2)
    work(posts(6, 5), 3)
    got = [json.loads(r["value"])["id"] for r in spark.read.parquet(f"{cfg.signal_path}/delta").collect()]
    assert sorted(got) == [1, 2, 3, 4, 5, 6]


def test_taps_count_rows_on_the_way(spark, tmp_path, land):
    from newsflow.sinks import topics

    folder, write = land
    write("1.txt", ["a", "b", "c"])
    stream = topics.tapped(streams.read_text_stream(spark, folder), "raw")
    query = (stream.writeStream.format("noop").option("checkpointLocation", str(tmp_path / "c")).trigger(availableNow=True).start())
    query.awaitTermination(60)
    assert any((p.observedMetrics.get("raw") or {"rows": 0})["rows"] == 3 for p in query.recentProgress)
