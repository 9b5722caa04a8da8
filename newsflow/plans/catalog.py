"""Every operator as a query over the given tables, with its check in SQL where SQL can say it.

Numbers that come out of floating-point sums are rounded to 6 digits on both sides.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow import schemas
from newsflow.functions import markup, scalars as S
from newsflow.operators import asof, bars as B, cells, chain, decide, enrich, keyed, knn, news, retrain, settle, sparse
from newsflow.plans import inputs as I
from newsflow.plans import oracle_parts as O
from newsflow.session import configure, shared_dir, written
from newsflow.sinks import models, tables, topics
from newsflow.sources import feeds, streams

Query = Callable[[SparkSession, str], DataFrame]
QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}

DIM = 64  # of the given vectors
TEXT_DIM = schemas.VECTOR_DIM
SIM_FREE, SIM_HYBRID = 0.35, 0.15  # thresholds that select something in the given vectors
NOW = I.T0 + I.MONTH_MS
HEADER_SQL = "'" + S.SCORING_HEADER.replace("'", "''").replace("\n", "' || chr(10) || '") + "'"
SCORED = O.SCORED.format(header=HEADER_SQL)


def query(key: str, sql: str | None = None) -> Callable[[Query], Query]:
    def add(build: Query) -> Query:
        def run(spark: SparkSession, sf_dir: str) -> DataFrame:
            return build(configure(spark), sf_dir)

        QUERIES[key] = run
        if sql is not None:
            ORACLES[key] = sql
        return build

    return add


def _ms(name: str) -> "F.Column":
    return S.to_epoch_ms(F.col(name)).alias("message_ms")


def _lit_ms(ms: int):
    return F.lit(ms).cast("bigint")


def _partitions(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))


def _r(c, digits: int = 6):
    return F.round(c, digits)


# ============================================================================ sources

@query("employee_stream_passthrough", f"WITH {O.EMPLOYEES} SELECT * FROM changes")
def employee_stream_passthrough(spark, d):
    messages = topics.to_json_value(I.employee_changes(spark, d), key="offset_id")
    rows = streams.employees(messages, keep=["key"])
    return rows.select(
        F.col("key").cast("bigint").alias("offset_id"), "id", "name", "department", "salary", _ms("message_time")
    )


@query("trade_signals_scan", f"WITH {O.SIGNALS} SELECT action, CAST(event_id AS VARCHAR) AS event_id, buy_price, "
       "sell_price FROM signals")
def trade_signals_scan(spark, d):
    messages = topics.to_json_value(I.signals(spark, d))
    return streams.trade_signals(messages).select("action", "event_id", "buy_price", "sell_price")


@query("memory_scan_filtered", f"WITH {O.MEMORY} SELECT event_id, sentiment_score, ret FROM memory "
       "WHERE is_settled AND sentiment_score >= 8")
def memory_scan_filtered(spark, d):
    return I.memory(spark, d).where("is_settled AND sentiment_score >= 8").select(
        "event_id", "sentiment_score", F.col("return").alias("ret")
    )


@query("rss_items_parse", f"""SELECT md5('https://feed.example/' || doc_id || '[' || text || ']') AS id, '[' || text || ']' AS title,
    text || '!' AS summary, CASE WHEN doc_id % 6 < 2 THEN 0 ELSE {I.T0} + doc_id * 60000 END AS "pubDate",
    'https://feed.example/' || source AS source, {NOW} AS es FROM documents""")
def rss_items_parse(spark, d):
    return feeds.rss_items(I.rss_documents(spark, d), now=_lit_ms(NOW))


@query("rest_posts_flatten", f"""SELECT doc_id AS id, text AS title, source || '.example' AS domain,
    'https://' || source || '.example/' || doc_id AS url,
    strftime(make_timestamp(({I.T0} + doc_id * 60000) * 1000), '%Y-%m-%dT%H:%M:%SZ') AS published_at,
    'rest' AS source_type FROM documents""")
def rest_posts_flatten(spark, d):
    return feeds.rest_posts(I.rest_documents(spark, d), "rest")


@query("html_timeline_extract", f"""SELECT 'Tweet from @user' || conv_id AS title, regexp_replace(text, '^\\s+|\\s+$', '', 'g') AS raw_content,
    'timeline' AS source_type, 'user' || conv_id AS author, {NOW} AS timestamp FROM conversations WHERE role = 'user'""")
def html_timeline_extract(spark, d):
    return feeds.timeline_tweets(I.timeline_pages(spark, d), now=_lit_ms(NOW))


@query("html_news_rows_extract", """SELECT CASE WHEN doc_id % 3 = 0 THEN 'https://other.example' ELSE '' END || '/news/' || doc_id AS link,
    CASE WHEN doc_id % 17 = 0 THEN '' ELSE '[' || text || ']' END AS title,
    CASE WHEN doc_id % 7 <> 0 THEN source END AS source, CASE WHEN doc_id % 2 = 0 THEN lang END AS currency
    FROM documents WHERE doc_id % 19 <> 0""")
def html_news_rows_extract(spark, d):
    return feeds.news_rows(I.news_row_pages(spark, d))


@query("scraped_item_filter", """SELECT CASE WHEN doc_id % 3 = 0 THEN 'https://other.example' ELSE 'https://site.example' END
    || '/news/' || doc_id AS link, '[' || text || ']' AS title, CASE WHEN doc_id % 7 <> 0 THEN source ELSE 'Unknown' END AS source,
    CASE WHEN doc_id % 2 = 0 THEN lang ELSE '' END AS currency
    FROM documents WHERE doc_id % 19 <> 0 AND doc_id % 17 <> 0""")
def scraped_item_filter(spark, d):
    return feeds.scraped_items(I.news_row_pages(spark, d), "https://site.example")


@query("scraped_sentiment_items", f"""SELECT CASE WHEN regexp_matches(lower(text), '(^|\\W)the(\\W|$)') THEN 'ENG' ELSE 'UNKNOWN' END AS asset,
    '[' || text || ']' AS raw_text, 'site-' || CASE WHEN doc_id % 7 <> 0 THEN source ELSE 'Unknown' END AS source, CAST({NOW // 1000} AS BIGINT) AS timestamp
    FROM documents WHERE doc_id % 19 <> 0 AND doc_id % 17 <> 0""")
def scraped_sentiment_items(spark, d):
    pages = I.news_row_pages(spark, d)
    return feeds.sentiment_items(pages, "site-", {"the": "ENG"}, now=_lit_ms(NOW))


@query("ohlcv_bars", f"WITH {O.BARS} SELECT symbol, timestamp, open, high, low, close, volume FROM bars")
def ohlcv_bars(spark, d):
    return I.bars(spark, d)


ROUTES = """CASE WHEN event_type IN ('click', 'view') THEN 'tx' WHEN event_type <> 'error' THEN 'log'
    WHEN event_id % 3 = 1 THEN 'other' ELSE 'empty' END"""


@query("chain_messages_route", f"""WITH {O.CHAIN} SELECT event_id, {ROUTES} AS route,
    CASE WHEN event_type IN ('click', 'view') THEN hash END AS tx_hash FROM chain""")
def chain_messages_route(spark, d):
    return chain.route(I.chain_messages(spark, d)).select("event_id", "route", "tx_hash")


@query("message_router", f"WITH {O.CHAIN} SELECT {ROUTES} AS route, count(*) AS n FROM chain GROUP BY 1")
def message_router(spark, d):
    return news.count_by(chain.route(I.chain_messages(spark, d)), "route", "n")


@query("user_click_parse", """SELECT CAST(user_id AS VARCHAR) AS user_id, CAST(event_id AS VARCHAR) AS item_id,
    event_type AS behavior, strftime(ts, '%Y-%m-%d %H:%M:%S') AS ts, epoch_ms(date_trunc('second', ts)) AS clicked_ms FROM events""")
def user_click_parse(spark, d):
    rows = I.table(spark, d, "events").select(
        F.col("user_id").cast("string").alias("user_id"),
        F.col("event_id").cast("string").alias("item_id"),
        F.col("event_type").alias("behavior"),
        F.date_format("ts", "yyyy-MM-dd HH:mm:ss").alias("ts"),
    )
    parsed = streams.user_clicks(topics.to_json_value(rows))
    return parsed.withColumn("clicked_ms", S.to_epoch_ms(F.col("clicked_at"))).drop("clicked_at")


@query("scraped_sentiment_parse", """SELECT upper(lang) AS asset, text AS raw_text, 'site-' || source AS source,
    (1704067200 + doc_id) * 1000 AS ts_ms FROM documents""")
def scraped_sentiment_parse(spark, d):
    rows = I.table(spark, d, "documents").selectExpr(
        "upper(lang) AS asset", "text AS raw_text", "concat('site-', source) AS source", "1704067200 + doc_id AS timestamp"
    )
    return streams.scraped_sentiment(topics.to_json_value(rows))


# ============================================================================ sinks

@query("signals_to_json", f"""WITH {O.SIGNALS} SELECT offset_id, '{{"action":"' || action || '","trigger_score":' || (offset_id % 10)
    || ',"event_id":"' || event_id || '","buy_price":' || CAST(buy_price AS VARCHAR) || '}}' AS value FROM signals""")
def signals_to_json(spark, d):
    rows = I.signals(spark, d).select(
        "offset_id", "action", F.lit(None).cast("bigint").alias("sell_time"), (F.col("offset_id") % 10).alias("trigger_score"),
        F.col("event_id").cast("string").alias("event_id"), "buy_price",
    )
    value = F.to_json(F.struct(*[c for c in rows.columns if c != "offset_id"])).alias("value")
    return rows.select("offset_id", value)


@query("employee_round_robin", f"WITH {O.EMPLOYEES} SELECT * FROM changes")
def employee_round_robin(spark, d):
    rows = I.employee_changes(spark, d).withColumn("message_time", _ms("message_time"))
    return topics.round_robin(rows.withColumnRenamed("message_time", "message_ms"), _partitions(spark))


@query("employee_projection", f"WITH {O.EMPLOYEES} SELECT id, name, department, salary, message_ms FROM changes")
def employee_projection(spark, d):
    return I.employee_changes(spark, d).select("id", "name", "department", "salary", _ms("message_time"))


@query("employee_upsert", f"""WITH {O.EMPLOYEES}, latest AS (SELECT id, arg_max(name, offset_id) AS name,
    arg_max(department, offset_id) AS department, arg_max(salary, offset_id) AS salary, arg_max(message_ms, offset_id) AS message_ms
    FROM changes GROUP BY id)
    SELECT * FROM latest UNION ALL SELECT c_custkey, c_name, c_mktsegment, c_acctbal, {I.T0} FROM customer
    WHERE c_custkey NOT IN (SELECT id FROM latest)""")
def employee_upsert(spark, d):
    merged = keyed.upsert(I.employee_base(spark, d), I.employee_changes(spark, d), ["id"], ["offset_id"])
    return merged.select("id", "name", "department", "salary", _ms("message_time"))


@query("kline_replace_into", f"""WITH {O.TICKS}, early AS (SELECT * REPLACE (ts_ms - 86400000 AS ts_ms) FROM ticks),
    {O.bars_cte("stored", "early")}, {O.bars_cte("fetched")}
    SELECT symbol, timestamp, open, high, low, close, volume, 'fetched' AS origin FROM fetched UNION ALL
    SELECT symbol, timestamp, open, high, low, close, volume, 'stored' FROM stored ANTI JOIN fetched USING (symbol, timestamp)""")
def kline_replace_into(spark, d):
    """Stored bars that lie a day earlier, overwritten by fetched bars of the same minutes."""
    ticks = I.ticks(spark, d)
    stored = B.ohlcv_bars(
        ticks, ["symbol"], S.to_epoch_ms(F.col("ts")) - settle.DAY_MS, F.col("price"), F.col("volume"),
        B.tick_order(F.col("ts"), F.col("event_id")),
    ).withColumn("origin", F.lit("stored"))
    fetched = I.bars(spark, d).withColumn("origin", F.lit("fetched"))
    return keyed.upsert(stored, fetched, ["symbol", "timestamp"])


@query("memory_append_defaults", f"""WITH {O.MEMORY} SELECT CAST(event_id AS VARCHAR) AS event_id, title, sentiment_score, rsi_14, atr_14,
    price_at_t, pub_date, sentiment_es, CAST(len(vector) AS BIGINT) AS dim, false AS is_settled, 0e0 AS win_rate, 0e0 AS ret FROM memory""")
def memory_append_defaults(spark, d):
    embedded = I.memory(spark, d).withColumnRenamed("event_id", "id").withColumnRenamed("pub_date", "pubDate")
    rows = tables.with_memory_defaults(embedded)
    return rows.withColumn("dim", F.size("vector").cast("bigint")).drop("vector").withColumnRenamed("return", "ret")


PURGE_NOW = I.T0 + 100 * settle.DAY_MS
WINDOW_SQL = (f"is_settled AND sentiment_es >= {PURGE_NOW - 180 * settle.DAY_MS} "
              f"AND sentiment_es < {PURGE_NOW - 90 * settle.DAY_MS}")


def _trained(spark, d):
    return retrain.training_window(I.memory(spark, d), _lit_ms(PURGE_NOW), "sentiment_es")


@query("memory_purge_trained", f"WITH {O.MEMORY} SELECT event_id, sentiment_es, is_settled FROM memory WHERE NOT ({WINDOW_SQL})")
def memory_purge_trained(spark, d):
    kept = keyed.purge(I.memory(spark, d), _trained(spark, d), "event_id")
    return kept.select("event_id", "sentiment_es", "is_settled")


def _chain_logs(spark, d):
    return chain.logs(chain.route(I.chain_messages(spark, d)))


@query("keyed_partitioning", f"""WITH {O.CHAIN} SELECT low_address AS key, blockNumber AS "blockNumber", logIndex AS "logIndex", hash AS "transactionHash",
    row_number() OVER (PARTITION BY low_address ORDER BY blockNumber, logIndex) - 1 AS sequence FROM logs""")
def keyed_partitioning(spark, d):
    rows = _chain_logs(spark, d).withColumn("key", S.normal_hex(F.col("address")))
    ordered = topics.numbered(rows, "key", ["blockNumber", "logIndex"], _partitions(spark))
    return ordered.select("key", "blockNumber", "logIndex", "transactionHash", "sequence")


# ============================================================================ projections, filters, routing

@query("news_drop_blank_title", f"WITH {O.NEWS} SELECT doc_id, title FROM clean")
def news_drop_blank_title(spark, d):
    return news.drop_blank_title(I.news(spark, d)).select("doc_id", "title")


@query("news_fill_summary", f"""WITH {O.NEWS} SELECT doc_id, CASE WHEN summary IS NULL OR regexp_full_match(summary, {O._BLANK})
    THEN title ELSE summary END AS summary FROM news""")
def news_fill_summary(spark, d):
    return news.fill_summary(I.news(spark, d)).select("doc_id", "summary")


@query("news_require_pubdate", f"""WITH {O.NEWS} SELECT doc_id, pubDate AS "pubDate" FROM news WHERE pubDate IS NOT NULL""")
def news_require_pubdate(spark, d):
    return news.require_pubdate(I.news(spark, d)).select("doc_id", "pubDate")


@query("news_freshness_filter", f"""WITH {O.NEWS} SELECT doc_id, pubDate AS "pubDate", es FROM news
    WHERE NOT coalesce(pubDate > 0 AND pubDate + 1800000 < es, false)""")
def news_freshness_filter(spark, d):
    return news.fresh_only(I.news(spark, d), now=F.col("es")).select("doc_id", "pubDate", "es")


@query("extreme_score_gate", f"""WITH {O.NEWS} SELECT doc_id, sentiment_score,
    NOT (sentiment_score < 8 AND sentiment_score > 3) AS backtested FROM news""")
def extreme_score_gate(spark, d):
    return news.extreme_gate(I.news(spark, d)).select("doc_id", "sentiment_score", "backtested")


@query("extreme_score_filter", f"WITH {O.NEWS} SELECT doc_id, sentiment_score FROM news WHERE sentiment_score <= 2 OR sentiment_score >= 8")
def extreme_score_filter(spark, d):
    return news.extreme_only(I.news(spark, d)).select("doc_id", "sentiment_score")


@query("unsettled_due_filter", f"""WITH {O.MEMORY} SELECT event_id, sentiment_es FROM memory
    WHERE NOT is_settled AND sentiment_es <= {NOW} - 86400000""")
def unsettled_due_filter(spark, d):
    return settle.due_unsettled(I.memory(spark, d), _lit_ms(NOW), "sentiment_es").select("event_id", "sentiment_es")


@query("training_window_filter", f"WITH {O.MEMORY} SELECT event_id, sentiment_es FROM memory WHERE {WINDOW_SQL}")
def training_window_filter(spark, d):
    return _trained(spark, d).select("event_id", "sentiment_es")


@query("sell_signal_filter", f"""WITH {O.SIGNALS} SELECT offset_id, event_id, buy_price, sell_price,
    CASE WHEN buy_price <= 0 THEN 'buy_price not positive' END AS reason FROM signals WHERE action = 'SELL'""")
def sell_signal_filter(spark, d):
    good, bad = settle.sell_signals(I.signals(spark, d))
    both = good.withColumn("reason", F.lit(None).cast("string")).unionByName(bad)
    return both.select("offset_id", "event_id", "buy_price", "sell_price", "reason")


@query("dex_log_filter", f"""WITH {O.CHAIN} SELECT hash AS "transactionHash", address, topic0, blockNumber AS "blockNumber", logIndex AS "logIndex"
    FROM logs WHERE {O.WATCHED} AND event_id % 3 < 2""")
def dex_log_filter(spark, d):
    hits = chain.pool_logs(_chain_logs(spark, d), I.target_pools())
    return hits.select("transactionHash", "address", F.col("topics")[0].alias("topic0"), "blockNumber", "logIndex")


@query("mempool_filter", f"""WITH {O.CHAIN} SELECT hash, "to", "gasPrice", "maxPriorityFeePerGas", input FROM bodies WHERE "to" IS NOT NULL""")
def mempool_filter(spark, d):
    return chain.call_transactions(I.transaction_bodies(spark, d))


@query("mempool_tx_lookup", f"""WITH {O.CHAIN} SELECT hash, "to", "gasPrice", "maxPriorityFeePerGas", input FROM bodies
    WHERE "to" IS NOT NULL AND event_type = 'click'""")
def mempool_tx_lookup(spark, d):
    hashes = chain.tx_hashes(chain.route(I.chain_messages(spark, d)))
    return chain.pending_transactions(hashes, I.transaction_bodies(spark, d))


@query("drop_nan_warmup", f"""WITH {O.INDICATORS} SELECT symbol, timestamp, datetime_sh, price_at_t, round(rsi_14, 6) AS rsi_14,
    round(atr_14, 6) AS atr_14, high, low, close FROM klines""")
def drop_nan_warmup(spark, d):
    return I.kline_rows(spark, d).withColumns({"rsi_14": _r("rsi_14"), "atr_14": _r("atr_14")})


@query("min_sample_guard", f"""WITH {O.MEMORY}, train AS (SELECT event_id FROM memory WHERE {WINDOW_SQL})
    SELECT event_id FROM train WHERE (SELECT count(*) FROM train) >= 100""")
def min_sample_guard(spark, d):
    return retrain.guarded(_trained(spark, d).select("event_id"), 100)


def _silent_on_empty():
    """A model that hands back its input as the reply, and fails on empty input."""

    def call(text: str) -> str:
        if not text:
            raise ValueError("empty reply")
        return text

    return call


REASON_SQL = """CASE shape WHEN 2 THEN 'no readable object' WHEN 3 THEN 'ValueError: empty reply'
    WHEN 4 THEN 'score missing or outside 1..10' WHEN 5 THEN 'score missing or outside 1..10' WHEN 6 THEN 'no readable object' END"""


@query("drop_failed_enrichment", f"""WITH {O.REPLIES} SELECT doc_id, score AS sentiment_score, {REASON_SQL} AS reason FROM replies""")
def drop_failed_enrichment(spark, d):
    """Good rows with their score, failed rows with their reason."""
    replied = enrich.enrich(
        I.model_replies(spark, d), "reply", "_reply", _silent_on_empty, enrich.REPLY_TYPE, capacity=8
    )
    parsed, r = enrich.parse_replies(replied), F.col("sentiment")
    return parsed.select(
        "doc_id", F.when(r["ok"], r["value"]["sentiment_score"]).alias("sentiment_score"), F.when(~r["ok"], r["error"]).alias("reason")
    )


@query("incremental_watermark_filter", """SELECT doc_id AS id, source FROM documents WHERE doc_id > (SELECT max(page_id) FROM pages)""")
def incremental_watermark_filter(spark, d):
    mark = I.table(spark, d, "pages").agg(F.max("page_id")).scalar()
    posts = I.table(spark, d, "documents").select(F.col("doc_id").alias("id"), "source")
    return news.new_above(posts, mark)


@query("first_page_preview", """SELECT doc_id, text FROM documents ORDER BY doc_id DESC LIMIT 3""")
def first_page_preview(spark, d):
    return news.first_rows(I.table(spark, d, "documents").select("doc_id", "text"), [F.col("doc_id").desc()], 3)


# ============================================================================ joins

@query("asof_price_features", f"""WITH {O.NEWS}, {O.INDICATORS} SELECT n.doc_id, n.symbol, n.pubDate AS "pubDate", k.price_at_t,
    round(k.rsi_14, 6) AS rsi_14, round(k.atr_14, 6) AS atr_14
    FROM news n ASOF JOIN klines k ON n.symbol = k.symbol AND n.pubDate >= k.timestamp""")
def asof_price_features(spark, d):
    rows = I.news(spark, d).select("doc_id", "symbol", "pubDate")
    joined = asof.asof_join(
        rows, I.kline_rows(spark, d), "pubDate", "timestamp", ["symbol"], ["rsi_14", "atr_14", "price_at_t"]
    )
    return joined.withColumns({"rsi_14": _r("rsi_14"), "atr_14": _r("atr_14")})


HITS_HYBRID = O.MEMORY + """,
pairs AS (SELECT q.event_id AS q_id, m.event_id AS m_id, m.ret, list_cosine_similarity(q.vector, m.vector) AS sim
    FROM memory q JOIN memory m ON m.sentiment_score = q.sentiment_score AND m.rsi_14 >= round(q.rsi_14 - 5, 2)
    AND m.is_settled AND m.sentiment_es < q.sentiment_es),
hits AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY round(sim, 10) DESC, m_id) AS rank FROM pairs QUALIFY rank <= 5)"""
HIT_SQL = "SELECT q_id, m_id, round(sim, 6) AS sim, CAST(rank AS BIGINT) AS rank FROM hits"


def _hit_columns(hits: DataFrame) -> DataFrame:
    return hits.select("q_id", "m_id", _r("sim").alias("sim"), F.col("rank").cast("bigint").alias("rank"))


def _history(spark, d) -> tuple[DataFrame, DataFrame]:
    m = I.memory(spark, d)
    q = m.select(F.col("event_id").alias("id"), "sentiment_score", "rsi_14", "sentiment_es", "vector")
    return q, decide.similar_history(q, m)


@query("knn_hybrid_top5", f"WITH {HITS_HYBRID} {HIT_SQL}")
def knn_hybrid_top5(spark, d):
    return _hit_columns(_history(spark, d)[1])


FREE_PAIRS = O.MEMORY + """,
pairs AS (SELECT q.event_id AS q_id, m.event_id AS m_id, m.ret, list_cosine_similarity(q.vector, m.vector) AS sim
    FROM memory q JOIN memory m ON m.is_settled AND m.event_id <> q.event_id
    WHERE NOT (q.sentiment_score < 8 AND q.sentiment_score > 3)),
hits AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY round(sim, 10) DESC, m_id) AS rank FROM pairs QUALIFY rank <= 10)"""


@query("knn_settled_top10", f"WITH {FREE_PAIRS} {HIT_SQL}")
def knn_settled_top10(spark, d):
    m = I.memory(spark, d)
    asked = news.extreme_gate(m).where("backtested")
    return _hit_columns(
        knn.knn_join(
            asked, m.where("is_settled"), 10, q_id="event_id", m_id="event_id", q_vec="vector", m_vec="vector",
            bounds=[("event_id", "!=", "event_id")],
        )
    )


@query("semantic_search_top2", f"""WITH {O.words_cte("q", "benchmark", "item_id", "text", TEXT_DIM)}, {O.words_cte("m", "documents", "doc_id", "text", TEXT_DIM)},
    q_len AS (SELECT item_id, sqrt(sum(w * w)) AS len FROM q GROUP BY 1), m_len AS (SELECT doc_id, sqrt(sum(w * w)) AS len FROM m GROUP BY 1),
    dots AS (SELECT item_id, doc_id, sum(q.w * m.w) AS dot FROM q JOIN m USING (slot) GROUP BY 1, 2),
    pairs AS (SELECT item_id AS q_id, doc_id AS m_id, dot / (q_len.len * m_len.len) AS sim FROM dots JOIN q_len USING (item_id) JOIN m_len USING (doc_id)),
    hits AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY round(sim, 10) DESC, m_id) AS rank FROM pairs QUALIFY rank <= 2) {HIT_SQL}""")
def semantic_search_top2(spark, d):
    q, m = (
        written(sparse.hashed_words(enrich.spread(I.table(spark, d, name).select(ident, "text"), _partitions(spark)), ident, "text", TEXT_DIM), name)
        for name, ident in (("benchmark", "item_id"), ("documents", "doc_id"))
    )
    return _hit_columns(sparse.top_k(q, m, 2))


@query("knn_ivf_approx")
def knn_ivf_approx(spark, d):
    """Search in stored cells. The cells are made, and the number to probe is measured, on the first call over the
    given vectors; later calls only search."""
    m = I.memory(spark, d)
    names = dict(q_id="event_id", m_id="event_id", q_vec="vector", m_vec="vector")
    others = [("event_id", "!=", "event_id")]
    root = f"{shared_dir(spark)}/cells-{I.fingerprint(spark, d, 'embeddings')}"
    if cells.settings(spark, root) is None:
        cells.create(m, root, "event_id", "vector")
        cells.append(m.where("is_settled"), root, 0, "event_id", "vector")
        cells.calibrate(spark, root, m.schema, 5, "event_id", "vector", bounds=others)
    return _hit_columns(cells.search(m, root, m.schema, 5, **names, bounds=others))


ALL_HITS = O.MEMORY + """,
pairs AS (SELECT q.event_id AS q_id, m.event_id AS m_id, list_cosine_similarity(q.vector, m.vector) AS sim
    FROM memory q JOIN memory m ON m.is_settled AND m.event_id <> q.event_id),
hits AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY round(sim, 10) DESC, m_id) AS rank FROM pairs QUALIFY rank <= 5)"""


@query("knn_ivf_all_cells", f"WITH {ALL_HITS} {HIT_SQL}")
def knn_ivf_all_cells(spark, d):
    """The approximate search with every cell probed, which is exact."""
    m = I.memory(spark, d)
    return _hit_columns(
        knn.knn_ivf(
            m, m.where("is_settled"), 5, q_id="event_id", m_id="event_id", q_vec="vector", m_vec="vector",
            bounds=[("event_id", "!=", "event_id")], nlist=128, nprobe=128,
        )
    )


@query("settle_by_event_id", f"WITH {O.SETTLED} SELECT event_id, round(rate, 6) AS rate, win, outcome FROM done")
def settle_by_event_id(spark, d):
    done = settle.settlements(I.signals(spark, d), I.memory(spark, d), "offset_id")
    return done.withColumn("rate", _r("rate"))


@query("memory_after_settlement", f"""WITH {O.SETTLED} SELECT m.event_id, m.is_settled OR coalesce(outcome = 'settled', false) AS is_settled,
    round(CASE WHEN outcome = 'settled' THEN rate ELSE ret END, 6) AS ret,
    CASE WHEN outcome = 'settled' THEN win ELSE m.win_rate END AS win_rate FROM memory m LEFT JOIN done USING (event_id)""")
def memory_after_settlement(spark, d):
    m = I.memory(spark, d)
    after = settle.apply_settlements(m, settle.settlements(I.signals(spark, d), m, "offset_id"))
    return after.select("event_id", "is_settled", _r("return").alias("ret"), "win_rate")


@query("news_dedup_seen", f"""WITH {O.NEWS}, seen AS (SELECT md5(text) AS id FROM documents JOIN labels USING (doc_id))
    SELECT id, min(doc_id) AS doc_id FROM news WHERE id NOT IN (SELECT id FROM seen) GROUP BY id""")
def news_dedup_seen(spark, d):
    labelled = I.table(spark, d, "documents").join(I.table(spark, d, "labels"), "doc_id")
    seen = labelled.select(S.news_id(F.lit(None).cast("string"), F.col("text")).alias("id"))
    return news.dedup_new(I.news(spark, d).select("id", "doc_id"), seen, ["doc_id"])


AGED = f"""NOT is_settled AND sentiment_es <= {NOW} - 86400000"""


def _price_memory(spark, d):
    return I.memory(spark, d).withColumnRenamed("sentiment_es", "timestamp")


@query("settle_24h_price_cross", f"""WITH {O.MEMORY}, {O.BARS}, last AS (SELECT symbol, arg_max(close, timestamp) AS p FROM bars GROUP BY symbol)
    SELECT event_id, price_at_t, p AS price_after_24h, round((p - price_at_t) / price_at_t, 6) AS return_24h, true AS is_settled
    FROM memory JOIN last USING (symbol) WHERE {AGED} AND price_at_t <> 0""")
def settle_24h_price_cross(spark, d):
    prices = I.bars(spark, d).withColumnRenamed("close", "price_at_t")
    done, _ = settle.settle_by_age(_price_memory(spark, d), _lit_ms(NOW), prices, by=["symbol"])
    return done.select("event_id", "price_at_t", "price_after_24h", _r("return_24h").alias("return_24h"), "is_settled")


@query("settle_24h_price_later", f"""WITH {O.MEMORY}, {O.BARS}, due AS (SELECT * FROM memory WHERE {AGED})
    SELECT m.event_id, m.price_at_t, b.close AS price_after_24h, round((b.close - m.price_at_t) / m.price_at_t, 6) AS return_24h
    FROM due m ASOF JOIN bars b ON m.symbol = b.symbol AND m.sentiment_es + 86400000 >= b.timestamp
    WHERE m.price_at_t <> 0 AND b.timestamp > m.sentiment_es""")
def settle_24h_price_later(spark, d):
    prices = I.bars(spark, d).withColumnRenamed("close", "price_at_t")
    done, _ = settle.settle_by_age(
        _price_memory(spark, d), _lit_ms(NOW), prices, price="t_plus_24h", by=["symbol"]
    )
    return done.select("event_id", "price_at_t", "price_after_24h", _r("return_24h").alias("return_24h"))


def _scored(spark, d):
    asked = enrich.score_news(enrich.spread(news.clean(I.news(spark, d)).drop("sentiment_score"), _partitions(spark)))
    good, _ = enrich.split_failed(asked, "sentiment", "drop")
    return enrich.flatten_score(good, now=F.col("es"))


@query("enrich_sentiment", f"""WITH {SCORED} SELECT doc_id, sentiment_score, 'digest ' || sentiment_score AS sentiment_reason,
    summary AS raw_content, es AS sentiment_es FROM scored""")
def enrich_sentiment(spark, d):
    return _scored(spark, d).select("doc_id", "sentiment_score", "sentiment_reason", "raw_content", "sentiment_es")


@query("enrich_embedding", f"""WITH {O.words_cte("v", "documents", "doc_id", "text", TEXT_DIM)} SELECT doc_id, slot, round(w, 6) AS weight FROM v""")
def enrich_embedding(spark, d):
    docs = enrich.spread(I.table(spark, d, "documents").select("doc_id", "text"), _partitions(spark))
    asked = enrich.embed(docs, "text", enrich.hashed_words_embedder(TEXT_DIM), capacity=8)
    good, _ = enrich.split_failed(asked, "vector", "drop")
    slots = good.select("doc_id", F.posexplode("vector").alias("slot", "weight")).where("weight <> 0")
    return slots.select("doc_id", F.col("slot").cast("bigint").alias("slot"), _r(F.col("weight").cast("double")).alias("weight"))


# ============================================================================ aggregates

STATS_SQL = f""",
stats AS (SELECT m.event_id AS id, m.sentiment_score, count(*) FILTER (sim > {SIM_HYBRID}) AS valid_matches,
    coalesce(max(sim) FILTER (sim > {SIM_HYBRID}), 0) AS max_similarity,
    count(*) FILTER (sim > {SIM_HYBRID} AND hits.ret > 0) AS win_count
    FROM memory m LEFT JOIN hits ON hits.q_id = m.event_id GROUP BY 1, 2),
rated AS (SELECT *, CASE WHEN valid_matches > 0 THEN win_count / valid_matches ELSE 0e0 END AS win_rate FROM stats)"""


@query("backtest_stats", f"""WITH {HITS_HYBRID}{STATS_SQL} SELECT id, valid_matches, round(max_similarity, 6) AS max_similarity,
    win_count, round(win_rate, 6) AS win_rate FROM rated""")
def backtest_stats(spark, d):
    q, hits = _history(spark, d)
    stats = decide.backtest_stats(hits, q.select("id"), "id", SIM_HYBRID)
    return stats.withColumns({"max_similarity": _r("max_similarity"), "win_rate": _r("win_rate")})


@query("execute_buy_decision", f"""WITH {FREE_PAIRS}, stats AS (SELECT q_id AS id, max(sim) FILTER (sim > {SIM_FREE}) AS best,
    count(*) FILTER (sim > {SIM_FREE}) AS n, count(*) FILTER (sim > {SIM_FREE} AND ret > 0) AS won FROM hits GROUP BY 1)
    SELECT m.event_id AS id, NOT (sentiment_score < 8 AND sentiment_score > 3) AS backtested,
    CASE WHEN sentiment_score < 8 AND sentiment_score > 3 THEN NULL WHEN best > {SIM_FREE} AND won / n > 0.65 THEN 'EXECUTE_BUY' ELSE 'HOLD' END AS decision,
    CASE WHEN best > {SIM_FREE} AND won / n > 0.65 THEN round(won / n, 6) END AS win_rate_calc
    FROM memory m LEFT JOIN stats ON stats.id = m.event_id""")
def execute_buy_decision(spark, d):
    m = I.memory(spark, d)
    scored = m.select(F.col("event_id").alias("id"), "sentiment_score", "vector", "sentiment_es")
    gated = decide.analysis_decisions(
        scored, m, m_id="event_id", ret="return", sim_threshold=SIM_FREE, bounds=[("event_id", "!=", "id")]
    )
    return gated.select("id", "backtested", "decision", _r("win_rate_calc").alias("win_rate_calc"))


@query("news_count_by_source", "SELECT source, count(*) AS total FROM documents GROUP BY 1")
def news_count_by_source(spark, d):
    return news.count_by(I.table(spark, d, "documents"), "source")


def _fetches(spark, d):
    """News with the number of the fetch that brought it."""
    return I.table(spark, d, "documents").select("doc_id", "source", F.floor(F.col("doc_id") / 100).alias("batch"))


@query("last_batch_size_by_source", """WITH n AS (SELECT source, doc_id // 100 AS batch, count(*) AS n FROM documents GROUP BY 1, 2)
    SELECT source, arg_max(n, batch) AS batch_size FROM n GROUP BY 1""")
def last_batch_size_by_source(spark, d):
    return news.last_batch_size(_fetches(spark, d), "source", "batch")


@query("fetch_new_count", "SELECT doc_id // 100 AS batch, count(*) AS new_rows FROM documents GROUP BY 1")
def fetch_new_count(spark, d):
    return news.count_by(_fetches(spark, d), "batch", "new_rows")


@query("win_rate_summary", f"""WITH {O.SETTLED} SELECT sentiment_score, count(*) AS n, round(avg(win), 6) AS avg_win, round(avg(rate), 6) AS avg_return
    FROM done JOIN memory USING (event_id) WHERE outcome = 'settled' GROUP BY 1""")
def win_rate_summary(spark, d):
    m = I.memory(spark, d)
    done = settle.settlements(I.signals(spark, d), m, "offset_id").where("outcome = 'settled'").join(m.select("event_id", "sentiment_score"), "event_id")
    return settle.win_rate_summary(done).withColumns({"avg_win": _r("avg_win"), "avg_return": _r("avg_return")})


# ============================================================================ windows and order

@query("rsi_14", f"WITH {O.INDICATORS} SELECT symbol, timestamp, round(rsi_14, 6) AS rsi_14 FROM indicators")
def rsi_14(spark, d):
    return B.indicators(I.bars(spark, d), ["symbol"]).select("symbol", "timestamp", _r("rsi_14").alias("rsi_14"))


@query("atr_14", f"WITH {O.INDICATORS} SELECT symbol, timestamp, round(atr_14, 6) AS atr_14 FROM indicators")
def atr_14(spark, d):
    return B.indicators(I.bars(spark, d), ["symbol"]).select("symbol", "timestamp", _r("atr_14").alias("atr_14"))


@query("true_range", f"WITH {O.INDICATORS} SELECT symbol, timestamp, round(true_range, 6) AS true_range FROM indicators")
def true_range(spark, d):
    return B.indicators(I.bars(spark, d), ["symbol"]).select("symbol", "timestamp", _r("true_range").alias("true_range"))


@query("latest_feature_row", f"""WITH {O.INDICATORS} SELECT symbol, timestamp, price_at_t, round(rsi_14, 6) AS rsi_14, round(atr_14, 6) AS atr_14
    FROM klines QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY timestamp DESC) = 1""")
def latest_feature_row(spark, d):
    last = keyed.latest_per_key(I.kline_rows(spark, d), ["symbol"], ["timestamp"])
    return last.select("symbol", "timestamp", "price_at_t", _r("rsi_14").alias("rsi_14"), _r("atr_14").alias("atr_14"))


@query("last_n_bars", f"""WITH {O.BARS} SELECT symbol, timestamp, close FROM bars
    QUALIFY row_number() OVER (PARTITION BY symbol ORDER BY timestamp DESC) <= 100""")
def last_n_bars(spark, d):
    return keyed.last_n(I.bars(spark, d), ["symbol"], "timestamp", 100).select("symbol", "timestamp", "close")


@query("latest_per_key", f"""WITH {O.EMPLOYEES} SELECT * FROM changes
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY offset_id DESC) = 1""")
def latest_per_key(spark, d):
    last = keyed.latest_per_key(I.employee_changes(spark, d), ["id"], ["offset_id"])
    return last.select("offset_id", "id", "name", "department", "salary", _ms("message_time"))


@query("first_seen_per_id", f"""WITH {O.NEWS} SELECT id, doc_id, source FROM news
    QUALIFY row_number() OVER (PARTITION BY id ORDER BY doc_id) = 1""")
def first_seen_per_id(spark, d):
    return keyed.first_per_key(I.news(spark, d).select("id", "doc_id", "source"), ["id"], ["doc_id"])


@query("ordered_emission", "SELECT event_type AS topic_partition, event_id AS offset_id, value FROM events")
def ordered_emission(spark, d):
    rows = I.table(spark, d, "events").select(
        F.col("event_type").alias("topic_partition"), F.col("event_id").alias("offset_id"), "value"
    )
    return topics.in_input_order(rows, "topic_partition", "offset_id")


# ============================================================================ set operations

@query("union_feeds", """SELECT 'documents' AS feed, source, text AS title FROM documents UNION ALL
    SELECT 'conversations', role, text FROM conversations UNION ALL SELECT 'benchmark', 'item', text FROM benchmark""")
def union_feeds(spark, d):
    def feed(name, source):
        return I.table(spark, d, name).select(F.lit(name).alias("feed"), source.alias("source"), F.col("text").alias("title"))

    return news.union_feeds(
        feed("documents", F.col("source")), feed("conversations", F.col("role")), feed("benchmark", F.lit("item"))
    )


@query("union_heterogeneous_news", f"""WITH {O.NEWS} SELECT id, title, summary, pubDate AS "pubDate", source, es FROM news UNION ALL
    SELECT CAST(doc_id AS VARCHAR), text, NULL, {I.T0} + doc_id * 60000, 'https://' || source || '.example/' || doc_id, NULL FROM documents UNION ALL
    SELECT md5('user' || conv_id || regexp_replace(text, '^\\s+|\\s+$', '', 'g')), 'Tweet from @user' || conv_id,
    regexp_replace(text, '^\\s+|\\s+$', '', 'g'), {NOW}, 'timeline', {NOW} FROM conversations WHERE role = 'user'""")
def union_heterogeneous_news(spark, d):
    return news.union_news(I.news(spark, d), rest_posts_flatten(spark, d), html_timeline_extract(spark, d))


# ============================================================================ scalar functions

@query("news_id_md5", f"""SELECT page_id, md5(url || html) AS id FROM pages""")
def news_id_md5(spark, d):
    return I.table(spark, d, "pages").select("page_id", S.news_id(F.col("url"), F.col("html")).alias("id"))


@query("html_to_text", """WITH bare AS (SELECT page_id, regexp_replace(regexp_replace(html,
    '<(script|style)[^>]*>.*?</(script|style)>|<!--.*?-->', '', 'gs'), '<[/!a-zA-Z][^>]*>', '', 'g') AS t FROM pages)
    SELECT page_id, regexp_replace(replace(replace(replace(replace(replace(replace(t, '&copy;', chr(169)), '&middot;', chr(183)),
    '&lt;', '<'), '&gt;', '>'), '&quot;', '"'), '&#39;', chr(39)), '&amp;?', '&', 'g') AS text FROM bare""")
def html_to_text(spark, d):
    pages = enrich.spread(I.table(spark, d, "pages").select("page_id", "html"), _partitions(spark))
    return pages.select("page_id", markup.html_to_text(F.col("html")).alias("text"))


@query("rfc822_to_epoch_ms", """SELECT event_id, CASE event_type WHEN 'error' THEN 0 WHEN 'view' THEN 0
    ELSE epoch_ms(date_trunc('second', ts)) END AS ms FROM events""")
def rfc822_to_epoch_ms(spark, d):
    ts = F.col("ts").cast("timestamp")
    wall = "EEE, d MMM yyyy HH:mm:ss"
    text = (
        F.when(F.col("event_type") == "click", F.concat(F.date_format(ts, wall), F.lit(" GMT")))
        .when(F.col("event_type") == "purchase", F.concat(F.date_format(ts + F.expr("INTERVAL 8 HOURS"), wall), F.lit(" +0800")))
        .when(F.col("event_type") == "signup", F.concat(F.date_format(ts - F.expr("INTERVAL 5 HOURS"), "dd MMM yyyy HH:mm:ss"), F.lit(" EST")))
        .when(F.col("event_type") == "view", F.date_format(ts, "yyyy/MM/dd"))
    )
    return I.table(spark, d, "events").select("event_id", S.rfc822_to_epoch_ms(text).alias("ms"))


@query("kline_datetime_sh", """SELECT event_id, strftime(ts + INTERVAL 8 HOUR, '%Y-%m-%d %H:%M:%S') AS datetime_sh FROM events""")
def kline_datetime_sh(spark, d):
    return I.table(spark, d, "events").select("event_id", S.shanghai_datetime(S.to_epoch_ms(F.col("ts"))).alias("datetime_sh"))


@query("llm_json_extract", f"""WITH {O.REPLIES} SELECT doc_id, CASE WHEN shape = 5 THEN (doc_id % 2) * 11 ELSE score END AS sentiment_score,
    why AS sentiment_reason FROM replies WHERE shape IN (0, 1, 4, 5)""")
def llm_json_extract(spark, d):
    parsed = I.model_replies(spark, d).withColumn("r", S.model_reply(F.col("reply"), "sentiment_score BIGINT, sentiment_reason STRING"))
    return parsed.where("r.sentiment_reason IS NOT NULL").select("doc_id", "r.*")


@query("prompt_build", f"""WITH {O.NEWS} SELECT doc_id, {HEADER_SQL} || 'Title: ' || title || chr(10) || 'Summary: ' || summary AS prompt FROM clean""")
def prompt_build(spark, d):
    rows = news.clean(I.news(spark, d))
    return rows.select("doc_id", S.scoring_prompt(S.title_and_summary(F.col("title"), F.col("summary"))).alias("prompt"))


@query("cosine_similarity", f"""WITH {O.MEMORY} SELECT a.event_id, round(list_cosine_similarity(a.vector, b.vector), 6) AS sim
    FROM memory a JOIN memory b ON b.event_id = a.event_id + 1""")
def cosine_similarity(spark, d):
    a = I.memory(spark, d).select("event_id", "vector")
    b = a.select((F.col("event_id") - 1).alias("event_id"), F.col("vector").alias("next"))
    return a.join(b, "event_id").select("event_id", _r(S.cosine_similarity(F.col("vector"), F.col("next"))).alias("sim"))


@query("vector_cast", f"""WITH {O.MEMORY} SELECT event_id, CAST(len(vector) AS BIGINT) AS dim, round(list_sum(vector), 6) AS total FROM memory""")
def vector_cast(spark, d):
    messages = topics.to_json_value(I.memory(spark, d).select("event_id", "vector"))
    typed = messages.select(F.from_json("value", "event_id BIGINT, vector ARRAY<DOUBLE>").alias("m")).select("m.*")
    cast = typed.withColumn("vector", S.as_vector(F.col("vector")))
    total = F.aggregate("vector", F.lit(0.0), lambda acc, x: acc + x.cast("double"))
    return cast.select("event_id", F.size("vector").cast("bigint").alias("dim"), _r(total).alias("total"))


@query("feature_concat", f"""WITH {O.MEMORY} SELECT event_id, CAST(len(vector) + 1 AS BIGINT) AS width, CAST(sentiment_score AS DOUBLE) AS first,
    round(vector[len(vector)], 6) AS last, round(sentiment_score + list_sum(vector), 6) AS total FROM memory""")
def feature_concat(spark, d):
    rows = I.memory(spark, d).withColumn("f", S.feature_array(F.col("sentiment_score"), F.col("vector")))
    total = F.aggregate("f", F.lit(0.0), lambda acc, x: acc + x)
    return rows.select(
        "event_id", F.size("f").cast("bigint").alias("width"), F.col("f")[0].alias("first"),
        _r(F.element_at("f", -1)).alias("last"), _r(total).alias("total"),
    )


@query("return_rate", f"""WITH {O.SIGNALS} SELECT offset_id, CASE WHEN buy_price <> 0 THEN round((sell_price - buy_price) / buy_price, 6) END AS rate FROM signals""")
def return_rate(spark, d):
    return I.signals(spark, d).select("offset_id", _r(S.return_rate(F.col("buy_price"), F.col("sell_price"))).alias("rate"))


@query("win_flag", f"""WITH {O.SIGNALS} SELECT offset_id, CASE WHEN buy_price <> 0 AND (sell_price - buy_price) / buy_price > 0 THEN 1e0 ELSE 0e0 END AS win FROM signals""")
def win_flag(spark, d):
    return I.signals(spark, d).select("offset_id", S.win_flag(S.return_rate(F.col("buy_price"), F.col("sell_price"))).alias("win"))


@query("decision_action", f"""WITH {O.NEWS} SELECT doc_id, CASE WHEN sentiment_score > 8 THEN 'BUY' WHEN sentiment_score < 2 THEN 'SELL' ELSE 'HOLD' END AS action FROM news""")
def decision_action(spark, d):
    return I.news(spark, d).select("doc_id", S.decision_action(F.col("sentiment_score")).alias("action"))


@query("url_absolutise", """SELECT page_id, 'https://site.example' || regexp_extract(url, '^https?://[^/]*(.*)$', 1) AS link FROM pages UNION ALL
    SELECT page_id, url FROM pages""")
def url_absolutise(spark, d):
    pages = I.table(spark, d, "pages")
    local = pages.select("page_id", F.regexp_extract("url", "^https?://[^/]*(.*)$", 1).alias("link"))
    both = local.unionByName(pages.select("page_id", F.col("url").alias("link")))
    return both.select("page_id", S.absolute_url(F.col("link"), "https://site.example/").alias("link"))


@query("hex_normalise", """SELECT event_id, CASE WHEN event_type = 'error' THEN '0x' ELSE '0x' || md5(event_type) END AS hex FROM events""")
def hex_normalise(spark, d):
    raw = F.when(F.col("event_type") != "error", F.unhex(F.md5("event_type")))
    return I.table(spark, d, "events").select("event_id", S.hex_text(raw).alias("hex"))


@query("event_signature_topics", f"""WITH {O.CHAIN} SELECT hash AS "transactionHash", CASE event_id % 3
    WHEN 0 THEN 'Swap(address,address,int256,int256,uint160,uint128,int24)' WHEN 1 THEN 'Sync(uint112,uint112)' END AS signature FROM logs""")
def event_signature_topics(spark, d):
    topic = F.lower(F.col("topics")[0])
    named = F.coalesce(*[F.when(topic == t, F.lit(s)) for s, t in S.EVENT_TOPICS.items()])
    return _chain_logs(spark, d).select("transactionHash", named.alias("signature"))


@query("default_lookup", f"""WITH {O.NEWS} SELECT doc_id, coalesce(summary, 'unknown') AS summary FROM news""")
def default_lookup(spark, d):
    return I.news(spark, d).select("doc_id", S.or_default(F.col("summary")).alias("summary"))


@query("rsi_floor_round", f"""WITH {O.INDICATORS} SELECT symbol, timestamp, round(round(rsi_14, 6) - 5, 2) AS floor FROM klines""")
def rsi_floor_round(spark, d):
    return I.kline_rows(spark, d).select("symbol", "timestamp", S.rsi_floor(_r("rsi_14")).alias("floor"))


# ============================================================================ model

@query("training_set", f"""WITH {O.MEMORY} SELECT event_id, CAST(len(vector) + 1 AS BIGINT) AS width, round(sentiment_score + list_sum(vector), 6) AS total,
    ret AS label FROM memory WHERE {WINDOW_SQL}""")
def training_set(spark, d):
    rows = retrain.training_set(_trained(spark, d), label="return")
    total = F.aggregate("features", F.lit(0.0), lambda acc, x: acc + x)
    return rows.select("event_id", F.size("features").cast("bigint").alias("width"), _r(total).alias("total"), "label")


@query("predict_return")
def predict_return(spark, d):
    """Score every unsettled row by the newest stored model. The first call over the given vectors trains and
    publishes it; later calls only score."""
    root = f"{shared_dir(spark)}/return-model-{I.fingerprint(spark, d, 'embeddings')}"
    if models.latest(spark, root) is None:
        train = retrain.training_set(_trained(spark, d), label="return")
        if retrain.enough(train, 1):
            models.publish(retrain.fit(train), root, 0)
    rows = models.predict(models.Loaded(root).current(spark), I.memory(spark, d).where("NOT is_settled"))
    return rows.select("event_id", _r("predicted_return").alias("predicted_return"))


# ============================================================================ whole flows

FLOW = f"""WITH {SCORED}, {O.INDICATORS}, {O.MEMORY}, {O.words_cte("v", "scored", "doc_id", "summary", DIM)},
featured AS (SELECT n.doc_id, n.id, n.sentiment_score, n.pubDate, n.es, k.price_at_t, round(k.rsi_14, 6) AS rsi_14
    FROM scored n ASOF JOIN klines k ON n.symbol = k.symbol AND n.pubDate >= k.timestamp),
q_len AS (SELECT doc_id, sqrt(sum(w * w)) AS len FROM v GROUP BY 1),
m_len AS (SELECT event_id, sqrt(list_sum(list_transform(vector, lambda x: x * x))) AS len FROM memory),
pairs AS (SELECT f.doc_id AS q_id, m.event_id AS m_id, any_value(m.ret) AS ret, sum(v.w * m.vector[v.slot + 1]) / any_value(q_len.len * m_len.len) AS sim
    FROM featured f JOIN memory m ON m.sentiment_score = f.sentiment_score AND m.rsi_14 >= round(f.rsi_14 - 5, 2) AND m.is_settled AND m.sentiment_es < f.es
    JOIN v USING (doc_id) JOIN q_len USING (doc_id) JOIN m_len ON m_len.event_id = m.event_id GROUP BY 1, 2),
hits AS (SELECT *, row_number() OVER (PARTITION BY q_id ORDER BY round(sim, 10) DESC, m_id) AS rank FROM pairs QUALIFY rank <= 5),
rated AS (SELECT f.*, count(sim) FILTER (sim > {SIM_HYBRID}) AS n, coalesce(max(sim) FILTER (sim > {SIM_HYBRID}), 0) AS best,
    count(*) FILTER (sim > {SIM_HYBRID} AND ret > 0) AS won FROM featured f LEFT JOIN hits ON hits.q_id = f.doc_id GROUP BY ALL)
SELECT id AS event_id, CASE WHEN sentiment_score > 8 THEN 'BUY' WHEN sentiment_score < 2 THEN 'SELL' ELSE 'HOLD' END AS action,
    'ETH' AS token, pubDate AS "pubDate", es AS sentiment_es, sentiment_score AS trigger_score, price_at_t AS buy_price FROM rated"""


def trading_stats(spark: SparkSession, d: str) -> DataFrame:
    """All of the trading flow but the decision.

    Price features come first, so that no model is asked about news without a bar; all model
    answers are written once.
    """
    rows = news.require_pubdate(news.clean(I.news(spark, d))).drop("sentiment_score")
    featured = asof.asof_join(
        rows, I.kline_rows(spark, d), "pubDate", "timestamp", ["symbol"], ["rsi_14", "atr_14", "price_at_t"]
    ).withColumn("rsi_14", _r("rsi_14"))
    scored, _ = enrich.split_failed(enrich.score_news(featured), "sentiment", "drop")
    asked = enrich.embed(
        enrich.flatten_score(scored, now=F.col("es")), "raw_content", enrich.hashed_words_embedder(DIM), capacity=8
    )
    embedded = written(enrich.split_failed(asked, "vector", "drop")[0], "embedded")
    # copies of one item carry the same id, but are asked about at their own times
    history = decide.similar_history(embedded, I.memory(spark, d), q_id="doc_id")
    return decide.backtest_stats(history, embedded.drop("vector"), "doc_id", SIM_HYBRID)


def _signals(stats: DataFrame, mode: str) -> DataFrame:
    rows = decide.trade_signals(stats, mode, SIM_HYBRID, now=_lit_ms(NOW))
    return rows.select("event_id", "action", "token", "pubDate", "sentiment_es", "trigger_score", "buy_price")


@query("trading_signals_score_only", FLOW)
def trading_signals_score_only(spark, d):
    return _signals(trading_stats(spark, d), "score_only")


@query("trading_signals_strict", f"{FLOW} WHERE best > {SIM_HYBRID} AND won / n > 0.65")
def trading_signals_strict(spark, d):
    return _signals(trading_stats(spark, d), "strict")
