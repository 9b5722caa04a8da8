import threading
import time

import pytest
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow import schemas
from newsflow.config import JobConfig
from newsflow.operators import chain, enrich, keyed, news, retrain, settle
from newsflow.session import written
from newsflow.sinks import tables, topics
from newsflow.sources import feeds, streams

ITEM = "id string, title string, summary string, pubDate bigint, source string, es bigint"


# ---- news -------------------------------------------------------------------------------------

def test_cleaning(spark):
    df = spark.createDataFrame(
        [("1", " \t\n", "s", 1, "x", 1), ("2", "T", None, 1, "x", 1), ("3", "T", "\t", 1, "x", 1), ("4", "T", "s", 1, "x", 1),
         ("5", None, "s", 1, "x", 1)], ITEM)
    got = {r["id"]: r["summary"] for r in news.clean(df).collect()}
    assert got == {"2": "T", "3": "T", "4": "s"}


def test_freshness(spark):
    half_hour = 1800000
    df = spark.createDataFrame([("zero", "t", "s", 0, "x", 1), ("edge", "t", "s", 10, "x", 1), ("stale", "t", "s", 9, "x", 1),
                                ("null", "t", "s", None, "x", 1)], ITEM)
    got = news.fresh_only(df, now=F.lit(10 + half_hour)).select("id").collect()
    assert {r["id"] for r in got} == {"zero", "edge", "null"}


def test_dedup_then_freshness_keeps_stale_ids_seen(spark):
    df = spark.createDataFrame([("a", "t", "s", 5, "x", 1), ("a", "t", "s", 10 ** 12, "y", 2), ("b", "t", "s", 10 ** 12, "y", 3)], ITEM)
    firsts = news.dedup_new(df, None, ["es"])
    got = news.fresh_only(firsts, now=F.lit(10 ** 12)).select("id").collect()
    assert [r["id"] for r in got] == ["b"]  # the second sighting of "a" stays dropped


def test_high_water_mark(spark):
    df = spark.createDataFrame([(i,) for i in range(5)], "id bigint")
    assert [r[0] for r in news.new_above(df, F.lit(2)).collect()] == [3, 4]
    assert news.new_above(df, F.lit(None).cast("bigint")).count() == 5


def test_strict_union_leaves_dates_unknown(spark):
    rss = spark.createDataFrame([("1", "t", "s", 5, "x", 1)], ITEM)
    rest = spark.createDataFrame([(7, "t", "d", "u", "2024-01-01T00:00:00Z", "rest")], schemas.NEWS_REST)
    tweets = spark.createDataFrame([("t", "text", "tw", "me", 9)], schemas.NEWS_TWEET)
    loose = {r["source"]: r["pubDate"] for r in news.union_news(rss, rest, tweets).collect()}
    assert loose == {"x": 5, "u": 1704067200000, "tw": 9}
    strict = news.union_news(rss, rest, tweets, strict_schema=True)
    assert {r["source"] for r in news.require_pubdate(strict).collect()} == {"x"}


def test_oversize_rows_are_refused_with_a_reason(spark):
    df = spark.createDataFrame([("a", "x" * 512, [1.0]), ("b", "x" * 513, [1.0]), ("c", "x", [1.0, 2.0]), ("d", "x", None)],
                               "event_id string, title string, vector array<float>")
    good, bad = news.split_oversize(df, schemas.MEMORY_TEXT_LIMITS, "vector", 1)
    assert [r["event_id"] for r in good.collect()] == ["a"]
    assert {r["event_id"]: r["reason"] for r in bad.collect()} == {
        "b": "title longer than 512", "c": "vector is not of size 1", "d": "vector is not of size 1"}


def test_last_batch_size(spark):
    df = spark.createDataFrame([("a", 1), ("a", 1), ("a", 2), ("b", 1)], "source string, batch bigint")
    assert {tuple(r) for r in news.last_batch_size(df, "source", "batch").collect()} == {("a", 1), ("b", 1)}


# ---- keys -------------------------------------------------------------------------------------

def test_latest_and_first(spark):
    df = spark.createDataFrame([(1, 1, "a"), (1, 3, None), (1, 2, "c"), (2, 1, "d")], "k int, o int, v string")
    assert {tuple(r) for r in keyed.latest_per_key(df, ["k"], ["o"]).collect()} == {(1, 3, None), (2, 1, "d")}
    assert {tuple(r) for r in keyed.first_per_key(df, ["k"], ["o"]).collect()} == {(1, 1, "a"), (2, 1, "d")}


def test_upsert_replaces_whole_rows(spark):
    base = spark.createDataFrame([(1, "a", 1.0), (2, "b", 2.0)], "k int, v string, w double")
    changes = spark.createDataFrame([(2, 1, "x", 5.0), (2, 2, "y", None), (3, 1, "z", 1.0)], "k int, o int, v string, w double")
    got = {tuple(r) for r in keyed.upsert(base, changes, ["k"], ["o"]).collect()}
    assert got == {(1, "a", 1.0), (2, "y", None), (3, "z", 1.0)}


def test_purge_and_last_n(spark):
    df = spark.createDataFrame([("a", i) for i in range(5)] + [("b", 9)], "k string, t int")
    assert {tuple(r) for r in keyed.last_n(df, ["k"], "t", 2).collect()} == {("a", 3), ("a", 4), ("b", 9)}
    ids = spark.createDataFrame([(0,), (0,), (9,)], "t int")
    assert {r["t"] for r in keyed.purge(df, ids, "t").collect()} == {1, 2, 3, 4}


# ---- enrichment -------------------------------------------------------------------------------

@pytest.fixture
def flaky():
    def make():
        seen = {}

        def call(text):
            seen[text] = seen.get(text, 0) + 1
            if text == "slow":
                time.sleep(3)
            if text == "bad" or (text == "once" and seen[text] == 1):
                raise RuntimeError("no")
            return text.upper()

        return call

    return make


def test_hung_calls_keep_their_places():
    running, most, lock = [0], [0], threading.Lock()

    def hung(text):
        with lock:
            running[0] += 1
            most[0] = max(most[0], running[0])
        time.sleep(1.0)
        with lock:
            running[0] -= 1

    got = enrich._run_calls([str(i) for i in range(20)], hung, 2, 0.05, 0)
    assert [r[1] for r in got] == ["timeout"] * 20 and most[0] == 2


@pytest.mark.parametrize("ordered", [True, False])
def test_fast_calls_pass_a_slow_one_if_order_is_free(ordered):
    ended = []

    def call(text):
        time.sleep(0.6 if text == "slow" else 0.01)
        ended.append(text)
        return text

    got = enrich._run_calls(["slow", *"abcdef"], call, 2, 5.0, 0, ordered)
    assert [r[2] for r in got] == ["slow", *"abcdef"]
    assert (ended.index("slow") >= 5) is not ordered


def test_enrich_keeps_order_and_carries_errors(spark, flaky):
    texts = ["a", "slow", "b", "bad", "once", None, "c"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(texts)], "i int, t string").coalesce(1)
    start = time.time()
    got = enrich.enrich(df, "t", "r", flaky, T.StringType(), capacity=2, timeout_s=0.5).collect()
    assert time.time() - start < 20
    assert [r["i"] for r in got] == list(range(7))
    assert [r["r"]["value"] for r in got] == ["A", None, "B", None, "ONCE", None, "C"]
    assert [r["r"]["error"] for r in got] == [None, "timeout", None, "RuntimeError: no", None, "no input", None]


def test_failed_rows_drop_fail_or_go_to_rejects(spark, flaky):
    df = spark.createDataFrame([("a",), ("bad",)], "t string")
    rows = enrich.enrich(df, "t", "r", flaky, T.StringType())
    good, bad = enrich.split_failed(rows, "r")
    assert [tuple(r) for r in good.collect()] == [("a", "A")]
    assert [tuple(r) for r in bad.collect()] == [("bad", "RuntimeError: no")]
    assert enrich.split_failed(rows, "r", "drop")[1] is None
    with pytest.raises(Exception, match="RuntimeError: no"):
        enrich.split_failed(rows, "r", "fail")[0].collect()
    with pytest.raises(ValueError):
        enrich.split_failed(rows, "r", "other")


def test_scores_and_embeddings_are_repeatable(spark):
    df = spark.createDataFrame([("1", "Title", "some text", 1, "x", 1)], ITEM)
    scored = enrich.flatten_score(enrich.split_failed(enrich.score_news(df), "sentiment")[0], now=F.lit(5))
    a, b = scored.first(), scored.first()
    assert a == b and 1 <= a["sentiment_score"] <= 10 and a["raw_content"] == "some text"
    vec = enrich.embed(scored, "raw_content", enrich.hashed_words_embedder(16)).first()["vector"]["value"]
    assert len(vec) == 16 and sum(v * v for v in vec) == pytest.approx(1.0, abs=1e-6)


def test_reply_problems_become_reasons(spark):
    reply = T.StructType.fromDDL("id int, _reply struct<ok:boolean,error:string,value:string>")
    df = spark.createDataFrame(
        [(1, (True, None, '{"sentiment_score": 3}')), (2, (True, None, "none")), (3, (True, None, '{"sentiment_score": 0}')),
         (4, (True, None, "{}")), (5, (False, "timeout", None)), (6, (True, None, '{"sentiment_score": "7"} '))], reply)
    got = {r["id"]: (r["sentiment"]["ok"], r["sentiment"]["error"]) for r in enrich.parse_replies(df).collect()}
    bad = "score missing or outside 1..10"
    assert got == {1: (True, None), 2: (False, "no readable object"), 3: (False, bad), 4: (False, bad),
                   5: (False, "timeout"), 6: (True, None)}


# ---- settlement -------------------------------------------------------------------------------

MEM = "event_id string, is_settled boolean, win_rate double, `return` double"


def test_first_usable_sell_settles_once(spark):
    memory = spark.createDataFrame([("a", False, 0.0, 0.0), ("b", True, 1.0, 0.5), ("c", False, 0.0, 0.0)], MEM)
    signals = spark.createDataFrame(
        [(1, "SELL", "a", 0.0, 5.0), (2, "SELL", "a", 100.0, 110.0), (3, "SELL", "a", 100.0, 50.0), (4, "SELL", "b", 1.0, 2.0),
         (5, "BUY", "c", 1.0, 2.0), (6, "SELL", "zz", 1.0, 2.0), (7, "SELL", None, 1.0, 2.0), (8, "SELL", "", 1.0, 2.0)],
        "o int, action string, event_id string, buy_price double, sell_price double")
    done = settle.settlements(signals, memory, "o")
    assert {r["event_id"]: r["outcome"] for r in done.collect()} == {"a": "settled", "b": "already_settled", "zz": "not_found"}
    after = {r["event_id"]: tuple(r)[1:] for r in settle.apply_settlements(memory, done).collect()}
    assert after == {"a": (True, 1.0, pytest.approx(0.1)), "b": (True, 1.0, 0.5), "c": (False, 0.0, 0.0)}
    _, refused = settle.sell_signals(signals)
    assert {r["o"]: r["reason"] for r in refused.collect()} == {1: "buy_price not positive", 7: "no event_id", 8: "no event_id"}


def test_settlement_by_age(spark):
    day = settle.DAY_MS
    memory = spark.createDataFrame([(1, 0, 100.0, False), (2, 0, 0.0, False), (3, day, 100.0, False), (4, 0, 100.0, True)],
                                   "id int, timestamp bigint, price_at_t double, is_settled boolean")
    prices = spark.createDataFrame([(day - 5, 150.0), (2 * day, 120.0)], "timestamp bigint, price_at_t double")
    now = F.lit(day + 10).cast("bigint")
    done, refused = settle.settle_by_age(memory, now, prices)
    assert [(r["id"], r["price_after_24h"], r["return_24h"], r["is_settled"]) for r in done.collect()] == [(1, 120.0, 0.2, True)]
    assert [r["id"] for r in refused.collect()] == [2]
    later, _ = settle.settle_by_age(memory, now, prices, price="t_plus_24h")
    assert [(r["id"], r["return_24h"]) for r in later.collect()] == [(1, 0.5)]
    with pytest.raises(ValueError):
        settle.settle_by_age(memory, now, prices, price="x")


# ---- chain ------------------------------------------------------------------------------------

def test_routing(spark):
    values = ['{"result": "0xab"}', '{"result": {"topics": ["t"], "address": "0xA"}}', '{"result": {"x": 1}}', '{"result": null}',
              '{"result": ""}', '{"result": {}}', '{"id": 1}', '{"result": 5}', "broken"]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, value string")
    got = {r["i"]: (r["route"], r["tx_hash"]) for r in chain.route(df).collect()}
    assert got == {0: ("tx", "0xab"), 1: ("log", None), 2: ("other", None), 3: ("empty", None), 4: ("empty", None),
                   5: ("empty", None), 6: ("empty", None), 7: ("other", None), 8: ("empty", None)}
    assert [tuple(r)[:3] for r in chain.logs(chain.route(df)).collect()] == [(1, "0xA", ["t"])]


def test_pool_filter_ignores_case_and_takes_lists_or_tables(spark):
    from newsflow.functions import scalars as S

    rows = spark.createDataFrame(
        [("0xAB", [S.SWAP_TOPIC.upper().replace("0X", "0x"), "z"]), ("0xab", [S.SYNC_TOPIC]), ("0xab", ["other"]), ("0xcd", [S.SWAP_TOPIC])],
        "address string, topics array<string>")
    pools = spark.createDataFrame([("0xaB",), ("0xab",)], "address string")
    assert chain.pool_logs(rows, ["0xaB"]).count() == 2
    assert chain.pool_logs(rows, pools).count() == 2


def test_contract_creations_drop_out(spark):
    rows = spark.createDataFrame([("h1", None, "1", "1", None), ("h2", "0xa", "99999999999999999999", "1", None), ("h3", "0xa", "1", "1", "")],
                                 schemas.MEMPOOL_TX)
    got = [(r["hash"], r["input"], r["gasPrice"]) for r in chain.call_transactions(rows).collect()]
    assert got == [("h2", "0x", "99999999999999999999"), ("h3", "0x", "1")]


# ---- feeds ------------------------------------------------------------------------------------

def test_rss_items(spark):
    body = ("<rss><channel><title>c</title><item><title>A &amp; B</title><link>http://x/1</link>"
            "<description>&lt;p&gt;Hi &lt;b&gt;you&lt;/b&gt;&lt;/p&gt;</description><pubDate>Mon, 01 Jan 2024 08:00:00 +0800</pubDate></item>"
            "<item><title>no date</title><link>http://x/2</link></item></channel></rss>")
    df = spark.createDataFrame([("u1", 200, body), ("u2", 200, body), ("u3", 500, body), ("u4", 200, "not xml")], "url string, status int, body string")
    got = feeds.rss_items(feeds.landed_ok(df), now=F.lit(1)).orderBy("source", "title").collect()
    assert [(r["title"], r["summary"], r["pubDate"], r["source"]) for r in got] == [
        ("A & B", "Hi you", 1704067200000, "u1"), ("no date", "", 0, "u1"), ("A & B", "Hi you", 1704067200000, "u2"), ("no date", "", 0, "u2")]
    assert news.dedup_new(spark.createDataFrame(got), None, ["source"]).count() == 2


def test_rest_posts_ignore_bad_pages(spark):
    df = spark.createDataFrame([('{"results": [{"id": 1, "title": "t"}]}',), ('{"detail": "quota"}',), ("oops",)], "body string")
    assert [(r["id"], r["title"]) for r in feeds.rest_posts(df, "rest").collect()] == [(1, "t")]


# ---- options ----------------------------------------------------------------------------------

def test_options():
    cfg = JobConfig.from_mapping({"kafka_servers": "b:1", "source_topic": "in", "sink_topic": "out", "max_offsets_per_trigger": "5",
                                  "min_partitions": 3, "jdbc_url": "jdbc:x", "jdbc_user": "u", "jdbc_table": "t"})
    options = streams.kafka_source_options(cfg, tuned=True)
    assert options["subscribe"] == "in" and options["startingOffsets"] == "latest" and options["maxOffsetsPerTrigger"] == "5"
    assert options["minPartitions"] == "3" and options["kafka.fetch.min.bytes"] == "1024"
    assert topics.kafka_sink_options(cfg, acks="all") == {"kafka.bootstrap.servers": "b:1", "topic": "out", "kafka.acks": "all"}
    assert topics.jdbc_options(cfg) == {"url": "jdbc:x", "dbtable": "t", "user": "u"}
    with pytest.raises(ValueError):
        topics.jdbc_options(JobConfig())


def test_config():
    assert JobConfig.from_args(["--top_k", "7", "--point_in_time", "false", "--sim_threshold", "0.5"]) == JobConfig(
        top_k=7, point_in_time=False, sim_threshold=0.5)
    with pytest.raises(ValueError):
        JobConfig.from_mapping({"nope": 1})
    assert JobConfig().jdbc_password is None


def test_json_drops_nulls_and_keys_partition(spark):
    df = spark.createDataFrame([("a", None), ("b", 2)], "k string, sell_time bigint")
    assert [tuple(r) for r in topics.to_json_value(df, "k").collect()] == [("a", '{"k":"a"}'), ("b", '{"k":"b","sell_time":2}')]
    rows = spark.createDataFrame([(f"k{i % 5}", i) for i in range(50)], "k string, n int")
    hot = rows.unionByName(spark.createDataFrame([("k1", i) for i in range(100, 300)], "k string, n int"))
    parts = topics.keyed_order(hot, "k", ["n"], 4).withColumn("p", F.spark_partition_id()).collect()
    leaving = [(r["k"], r["n"]) for r in sorted(parts, key=lambda r: r["p"])]  # partition by partition
    assert leaving == sorted(leaving) and len(leaving) == 250
    assert len({r["p"] for r in parts if r["k"] == "k1"}) > 1
    spread = topics.round_robin(rows, 5).withColumn("p", F.spark_partition_id()).groupBy("p").count().collect()
    assert len(spread) == 5


# ---- tables -----------------------------------------------------------------------------------

def kv(spark, rows):
    return spark.createDataFrame(rows, "k bigint, v string")


def test_replayed_batches_leave_no_duplicates(spark, tmp_path):
    root, schema = str(tmp_path / "t"), kv(spark, []).schema
    assert tables.read_appended(spark, root, schema).count() == 0
    tables.write_batch(kv(spark, [(1, "a"), (2, "b")]), root, 0)
    tables.write_batch(kv(spark, [(2, "c")]), root, 1)
    tables.write_batch(kv(spark, [(2, "c")]), root, 1)
    assert tables.read_appended(spark, root, schema).count() == 3
    assert {tuple(r) for r in tables.read_current(spark, root, schema, ["k"]).collect()} == {(1, "a"), (2, "c")}
    assert tables.read_appended(spark, root, schema, before=1).count() == 2


def test_compaction_keeps_the_rows_and_takes_later_batches(spark, tmp_path):
    root, schema = str(tmp_path / "t"), kv(spark, []).schema
    tables.create_table(spark, root, schema)
    tables.create_table(spark, root, schema)
    tables.write_batch(kv(spark, [(1, "a"), (2, "b")]), root, 0)
    assert tables.compact(spark, root, schema, ["k"]) == 1
    tables.write_batch(kv(spark, [(2, "c"), (3, "d")]), root, 1)
    assert {tuple(r) for r in tables.read_current(spark, root, schema, ["k"]).collect()} == {(1, "a"), (2, "c"), (3, "d")}
    tables.compact(spark, root, schema, ["k"])
    assert {tuple(r) for r in tables.read_current(spark, root, schema, ["k"]).collect()} == {(1, "a"), (2, "c"), (3, "d")}
    assert tables.last_batch(spark, root) == 1
    tables.create_table(spark, root, schema, replace=True)
    assert tables.read_current(spark, root, schema, ["k"]).count() == 0


def test_written_frames_keep_rows_and_types(spark):
    df = kv(spark, [(1, "a"), (2, None)])
    back = written(df, "kv")
    assert back.schema == df.schema and {tuple(r) for r in back.collect()} == {(1, "a"), (2, None)}


# ---- model ------------------------------------------------------------------------------------

def test_retrain_backs_up_trains_saves_and_purges(spark, tmp_path):
    from pyspark.ml import PipelineModel

    day, now = settle.DAY_MS, 1704067200000
    rows = [(i, now - (100 + i % 60) * day, 1 + i % 10, [float(i % 7), float(i % 3)], (i % 7) / 10, True) for i in range(150)]
    rows += [(1000, now - 10 * day, 5, [1.0, 1.0], 0.0, True), (1001, now - 100 * day, 5, [1.0, 1.0], 0.0, False),
             (1002, now - 180 * day, 5, [1.0, 1.0], 0.0, True), (1003, now - 90 * day, 5, [1.0, 1.0], 0.0, True)]
    memory = spark.createDataFrame(rows, "id bigint, timestamp bigint, sentiment_score int, vector array<float>, return_24h float, is_settled boolean")
    model_path, backups = str(tmp_path / "model"), str(tmp_path / "backups")
    left = retrain.retrain(memory, now, model_path, backups, trees=5, depth=3)
    assert {r["id"] for r in left.collect()} == {1000, 1001, 1003}
    saved = spark.read.parquet(f"{backups}/backup_20230705_20231003")
    assert saved.count() == 151
    scored = retrain.predict(PipelineModel.load(model_path), left).collect()
    assert len(scored) == 3 and all(r["predicted_return"] is not None for r in scored)
    with pytest.raises(Exception):  # a backup is never overwritten
        retrain.retrain(memory, now, model_path, backups, trees=5, depth=3)


def test_too_few_rows_stop_the_training(spark, tmp_path):
    memory = spark.createDataFrame([(1, 0, 5, [1.0], 0.0, True)], "id bigint, timestamp bigint, sentiment_score int, vector array<float>, return_24h float, is_settled boolean")
    assert retrain.retrain(memory, 120 * settle.DAY_MS, str(tmp_path / "m"), str(tmp_path / "b")) is None
    assert not (tmp_path / "m").exists() and not (tmp_path / "b").exists()
    assert retrain.guarded(memory, 1).count() == 1 and retrain.guarded(memory, 2).count() == 0
