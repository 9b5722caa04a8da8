"""Jobs started by name over landed files, and the stream of landed pages."""

import json

import pytest
from pyspark.sql import functions as F

from newsflow import schemas
from newsflow.config import JobConfig
from newsflow.operators import enrich
from newsflow.sinks import tables, topics
from newsflow.sources import posts, streams
from newsflow.streaming import jobs, main

DIM = 16
T0 = 1704067200000
MODELS = jobs.Models(enrich.digest_scorer, enrich.hashed_words_embedder(DIM))


def post(i, title="t"):
    return {"id": i, "title": title, "domain": "d", "url": f"u{i}", "published_at": "p"}


def page(*ids):
    return json.dumps({"results": [post(i) for i in ids]})


def words(**settings):
    return [w for name, value in settings.items() for w in (f"--{name}", str(value))]


def lines(folder):
    return [json.loads(t) for f in sorted(folder.glob("batch-*/*.txt")) for t in f.read_text().splitlines()]


def test_posts_come_once_and_a_restart_reads_no_old_page(spark, tmp_path):
    pages, out = tmp_path / "pages", tmp_path / "out"
    args = ["posts", *words(input_path=pages, signal_path=tmp_path / "signals", checkpoint_path=tmp_path / "c", sink="files", output_path=out, available_now=True)]
    assert posts.land_page(str(pages), page(3, 2, 1)) == 3
    assert posts.land_page(str(pages), page(5, 4, 3)) == 5
    assert posts.land_page(str(pages), page()) is None
    (pages / "notes.txt").write_text("no page")
    (pages / posts.page_name(4)).write_text("not json")
    main.main(args)
    assert sorted(r["id"] for r in lines(out)) == [1, 2, 3, 4, 5] and {r["source_type"] for r in lines(out)} == {"rest"}

    posts.land_page(str(pages), page(5, 4, 3))  # fetched again
    posts.land_page(str(pages), page(2, 1))  # late
    main.main(args)
    assert len(lines(out)) == 5

    (pages / posts.page_name(3)).write_text("old pages are not opened: this one would stop the stream" + page(9))
    (pages / posts.page_name(2)).write_text(page(99))
    posts.land_page(str(pages), json.dumps({"results": [post(7), {"title": "no id"}, post(6), post(5)]}))
    main.main(args)
    assert sorted(r["id"] for r in lines(out)) == [1, 2, 3, 4, 5, 6, 7]
    assert sorted(json.loads(r["value"])["id"] for r in spark.read.parquet(f"{tmp_path}/signals/delta").collect()) == [1, 2, 3, 4, 5, 6, 7]


def test_pages_of_a_batch_are_dealt_over_tasks(tmp_path):
    for i in range(1, 8):
        posts.land_page(str(tmp_path), page(10 * i, 10 * i - 5))
    reader = posts.PagesReader(str(tmp_path), -1, 2)
    assert reader.initialOffset() == {"last_id": -1} and reader.latestOffset() == {"last_id": 70}
    parts = reader.partitions({"last_id": 20}, {"last_id": 70})
    assert [p.value for p in parts] == [(20, [30, 40]), (20, [50, 60]), (20, [70])]
    assert [(a, b) for a, b, _ in reader.read(parts[1])] == [(50, 20), (60, 20)]
    assert reader.partitions({"last_id": 70}, {"last_id": 70}) == []
    assert posts.PagesReader(str(tmp_path / "none"), 5, 2).latestOffset() == {"last_id": 5}


def test_a_post_above_its_page_is_an_error(spark):
    pages = spark.createDataFrame([(5, 3, page(6, 5, 4, 3))], "last_id bigint, above bigint, body string")
    with pytest.raises(Exception, match="post above its page: 6"):
        posts.new_posts(pages, "rest").collect()
    newer = json.dumps({"results": [post(5), post(4), post(3, "edited")]})
    fine = spark.createDataFrame([(5, 0, newer), (3, 0, page(3, 1, 0))], "last_id bigint, above bigint, body string")
    got = posts.once(posts.new_posts(fine, "rest"))
    assert sorted((r["id"], r["title"]) for r in got.collect()) == [(1, "t"), (3, "edited"), (4, "t"), (5, "t")]
    assert got.columns == schemas.NEWS_REST.fieldNames()


def test_klines_trading_and_settlement_by_name(spark, tmp_path):
    at = dict(memory_path=str(tmp_path / "memory"), kline_path=str(tmp_path / "klines"), settle_path=str(tmp_path / "settled"),
              signal_path=str(tmp_path / "signals"), reject_path=str(tmp_path / "rejects"), checkpoint_path=str(tmp_path / "c"))
    bars = [("ETH", T0 + 60_000 * i, 100.0, 101.0 + i % 3, 99.0 - i % 2, 100.0 + i % 4, 1.0) for i in range(40)]
    spark.createDataFrame(bars, main.TICK_BAR).write.parquet(str(tmp_path / "bars"))
    main.main(["klines", *words(input_path=tmp_path / "bars", kline_path=at["kline_path"])])
    assert jobs.read_klines(spark, JobConfig(**at)).count() > 0

    (tmp_path / "in").mkdir()
    news = [{"id": f"n{i}", "title": f"title {i}", "summary": f"words {i}", "pubDate": T0 + 60_000 * (30 + i), "source": "s", "es": T0} for i in range(3)]
    (tmp_path / "in" / "a.txt").write_text("".join(json.dumps(n) + "\n" for n in news))
    cfg = JobConfig(**at, source="files", input_path=str(tmp_path / "in"), sink="files", output_path=str(tmp_path / "out"), available_now=True,
                    symbol="ETH", vector_dim=DIM, decision_mode="score_only")
    query = main.start(spark, "trading", cfg, MODELS)
    query.awaitTermination(120)
    assert query.exception() is None
    stored = {r["event_id"] for r in tables.read_appended(spark, cfg.memory_path, schemas.MEMORY).collect()}
    assert stored == {"n0", "n1", "n2"}
    table = sorted(r["value"] for r in spark.read.parquet(f"{cfg.signal_path}/delta").collect())
    assert sorted(map(json.dumps, lines(tmp_path / "out"))) == sorted(json.dumps(json.loads(v)) for v in table)

    sell = {"action": "SELL", "event_id": "n1", "buy_price": 100.0, "sell_price": 120.0, "timestamp": T0}
    (tmp_path / "sent" / "batch-0").mkdir(parents=True)
    (tmp_path / "sent" / "batch-0" / "p.txt").write_text(json.dumps(sell) + "\n")
    main.main(["settlement", *words(**at, source="files", input_path=f"{tmp_path}/sent/*", available_now="true")])
    done = tables.read_appended(spark, cfg.settle_path, jobs.SETTLEMENT).where("outcome = 'settled'").collect()
    assert [(r["event_id"], round(r["rate"], 6), r["win"]) for r in done] == [("n1", 0.2, 1.0)]


def test_rss_by_name(spark, tmp_path):
    body = "<rss><channel><item><title>a</title><link>l1</link><description>d</description><pubDate>{}</pubDate></item></channel></rss>"
    now = spark.range(1).select(F.date_format(F.current_timestamp(), "EEE, dd MMM yyyy HH:mm:ss").alias("d")).first()["d"] + " GMT"
    (tmp_path / "in").mkdir()
    rows = [{"url": "f", "status": s, "body": body.format(now)} for s in (200, 200, 500)]
    (tmp_path / "in" / "a.txt").write_text("".join(json.dumps(r) + "\n" for r in rows))
    main.main(["rss", *words(source="files", input_path=tmp_path / "in", seen_path=tmp_path / "seen", signal_path=tmp_path / "signals",
                             checkpoint_path=tmp_path / "c", sink="files", output_path=tmp_path / "out", available_now=True)])
    assert [(r["title"], r["source"]) for r in lines(tmp_path / "out")] == [("a", "f")]


def test_settings_that_are_missing_are_named(spark, tmp_path):
    with pytest.raises(ValueError, match="checkpoint_path.*memory_path.*settle_path"):
        main.start(spark, "settlement", JobConfig())
    with pytest.raises(ValueError, match="input_path"):
        main.start(spark, "risk_log", JobConfig(memory_path="m", checkpoint_path="c", source="files"))
    with pytest.raises(ValueError, match="output_path"):
        main.start(spark, "posts", JobConfig(input_path="i", signal_path="s", checkpoint_path="c", sink="files"))
    with pytest.raises(ValueError, match="score_url"):
        main.served_models(JobConfig(embed_url="http://x", embed_model="m"))
    with pytest.raises(SystemExit, match="usage"):
        main.main(["unknown"])
    with pytest.raises(ValueError, match="source is one of"):
        main.messages(spark, JobConfig(source="x"))


def test_topics_are_read_and_written_through_the_connector(spark, tmp_path, monkeypatch):
    seen = []
    monkeypatch.setattr(streams, "read_kafka", lambda s, cfg, tuned: seen.append((cfg.source_topic, tuned)) or streams.read_text_stream(s, str(tmp_path)))
    for name in ("risk_log", "analysis"):
        cfg = JobConfig(memory_path=str(tmp_path / "m"), signal_path=str(tmp_path / "s"), checkpoint_path=str(tmp_path / "c"), source_topic=name)
        main.JOBS[name].build(spark, cfg, MODELS)
    assert seen == [("risk_log", False), ("analysis", True)]
    values = spark.createDataFrame([("a",)], main.MESSAGE)
    with pytest.raises(Exception, match="(?i)kafka"):  # no connector jar here
        topics.send(values, JobConfig(sink="kafka"), 0)
    with pytest.raises(ValueError, match="sink is one of"):
        topics.send(values, JobConfig(sink="x"), 0)


def test_the_analysis_prompt_holds_the_message_once(spark, tmp_path):
    asked = []

    def scorer():
        def call(text):
            (tmp_path / f"p{abs(hash(text))}").write_text(text)
            return '{"sentiment_score": 9, "sentiment_reason": "r"}'
        return call

    cfg = JobConfig(memory_path=str(tmp_path / "m"), signal_path=str(tmp_path / "s"), checkpoint_path=str(tmp_path / "c"))
    jobs.analysis_batch(cfg, jobs.Models(scorer, MODELS.embedder), F.lit(5).cast("bigint"))(spark.createDataFrame([("to the moon",)], main.MESSAGE), 0)
    asked = [f.read_text() for f in tmp_path.glob("p*") if f.is_file()]
    assert len(asked) == 1 and asked[0].count("to the moon") == 1 and "Title:" not in asked[0]
    stored = tables.read_appended(spark, cfg.memory_path, schemas.MEMORY_V1).collect()
    assert [(r["raw_content"], r["sentiment_score"]) for r in stored] == [("to the moon", 9)]
