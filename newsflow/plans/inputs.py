"""Messages and tables of the domain, derived by Spark from the given parquet tables.

Every frame uses all rows and whole texts of its table. ``doc_id % n`` only decides which rows
show a defect (blank title, unknown date, ...), never which rows take part.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.functions import scalars as S
from newsflow.operators import bars as B

T0 = 1704067200000  # 2024-01-01 00:00 UTC in ms
MONTH_MS = 2592000000
SYMBOLS = ("click", "error", "purchase", "signup", "view")
PER_PAGE = 20
POOLS = 20  # pools seen in the chain logs
TARGET_POOLS = 5  # pools that are watched


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def fingerprint(spark: SparkSession, sf_dir: str, name: str) -> str:
    """Names what is derived from a table: other files, or files of another size or time, give another name."""
    files = table(spark, sf_dir, name).select("_metadata.file_path", "_metadata.file_size", "_metadata.file_modification_time").distinct()
    found = files.agg(F.sort_array(F.collect_list(F.struct("*"))).alias("files")).select(F.md5(F.to_json("files"))).first()[0]
    return f"{name}-{found}"


def symbol_of(number: str) -> str:
    cases = " ".join(f"WHEN {i} THEN '{s}'" for i, s in enumerate(SYMBOLS))
    return f"CASE {number} % {len(SYMBOLS)} {cases} END"


def news(spark: SparkSession, sf_dir: str) -> DataFrame:
    """NewsItem rows with an id per title, blanks, absent summaries, and null, zero or stale dates."""
    return (
        table(spark, sf_dir, "documents")
        .selectExpr(
            "doc_id",
            "CASE WHEN doc_id % 17 = 0 THEN ' \t\n ' ELSE text END AS title",
            "CASE WHEN doc_id % 11 = 0 THEN NULL WHEN doc_id % 13 = 0 THEN ' \t' ELSE text END AS summary",
            f"CASE WHEN doc_id % 23 = 0 THEN NULL WHEN doc_id % 29 = 0 THEN 0L "
            f"ELSE {T0}L + (doc_id * 2592000L) % {MONTH_MS}L END AS pubDate",
            f"{T0}L + (doc_id * 2592000L) % {MONTH_MS}L + (doc_id % 60) * 60000L AS es",
            "source",
            "1 + (doc_id * 7) % 10 AS sentiment_score",
            f"{symbol_of('doc_id')} AS symbol",
        )
        .withColumn("id", S.news_id(F.lit(None).cast("string"), F.col("title")))
    )


def ticks(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").select(
        F.col("event_type").alias("symbol"),
        F.col("ts").cast("timestamp").alias("ts"),
        "event_id",
        F.col("value").alias("price"),
        F.get_json_object("props", "$.k").cast("double").alias("volume"),
    )


def bars(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Minute bars of every symbol."""
    return B.ohlcv_bars(
        ticks(spark, sf_dir), ["symbol"], S.to_epoch_ms(F.col("ts")), F.col("price"), F.col("volume"),
        B.tick_order(F.col("ts"), F.col("event_id")),
    )


def kline_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return B.kline_features(bars(spark, sf_dir), ["symbol"])


def memory(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "embeddings").selectExpr(
        "vec_id AS event_id",
        "concat('memory ', vec_id) AS title",
        "CAST(1 + label AS BIGINT) AS sentiment_score",
        "CAST(30 + vec_id % 41 AS DOUBLE) AS rsi_14",
        "CAST(1 + vec_id % 3 AS DOUBLE) AS atr_14",
        "CAST(CASE WHEN vec_id % 9 = 0 THEN 0 ELSE 90 + vec_id % 21 END AS DOUBLE) AS price_at_t",
        f"{T0}L + vec_id * 5184000L AS pub_date",
        f"{T0}L + vec_id * 5184000L AS sentiment_es",
        "embedding AS vector",
        "vec_id % 5 <> 0 AS is_settled",
        "CAST(0 AS DOUBLE) AS win_rate",
        "(((vec_id * 37) % 200) - 100) / CAST(1000 AS DOUBLE) AS `return`",
        f"{symbol_of('vec_id')} AS symbol",
    )


def signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").selectExpr(
        "event_id AS offset_id",
        "CASE event_type WHEN 'purchase' THEN 'BUY' WHEN 'click' THEN 'SELL' ELSE 'HOLD' END AS action",
        "user_id AS event_id",
        "CASE WHEN event_id % 13 = 0 THEN 0D ELSE 100D + event_id % 7 END AS buy_price",
        "100D + value / 10 AS sell_price",
    )


def employee_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "orders").selectExpr(
        "o_orderkey AS offset_id",
        "o_custkey AS id",
        "concat('cust-', o_custkey) AS name",
        "o_orderpriority AS department",
        "o_totalprice AS salary",
        "CAST(o_orderdate AS TIMESTAMP) AS message_time",
    )


def employee_base(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "customer").selectExpr(
        "c_custkey AS id",
        "c_name AS name",
        "c_mktsegment AS department",
        "c_acctbal AS salary",
        f"timestamp_millis({T0}L) AS message_time",
    )


def model_replies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Replies in all the shapes a text model gives."""
    return table(spark, sf_dir, "documents").selectExpr(
        "doc_id",
        r"""CASE doc_id % 7
        WHEN 0 THEN concat('```json\n{"sentiment_score": ', 1 + doc_id % 10, ', "sentiment_reason": "r', doc_id, '"}\n```')
        WHEN 1 THEN concat('Sure: {"sentiment_score": ', 1 + doc_id % 10, ', "sentiment_reason": "a {b} c"} done')
        WHEN 2 THEN concat('no object in ', source)
        WHEN 3 THEN ''
        WHEN 4 THEN '{"sentiment_reason": "score is absent"}'
        WHEN 5 THEN concat('{"sentiment_score": ', (doc_id % 2) * 11, ', "sentiment_reason": "out of range"}')
        ELSE '{"sentiment_score": 5, "sentiment_reason": ' END AS reply""",
    )


# ---- landed web responses -------------------------------------------------------------------

def _escaped(text):
    for raw, entity in (("&", "&amp;"), ("<", "&lt;"), (">", "&gt;")):
        text = F.replace(text, F.lit(raw), F.lit(entity))
    return text


def _pages(rows: DataFrame, keys: list[str], order: str, part) -> DataFrame:
    """Concatenate the parts of each page; a page holds at most ``PER_PAGE`` rows."""
    return rows.groupBy(*keys).agg(
        F.array_join(F.transform(F.array_sort(F.collect_list(F.struct(order, part.alias("p")))), lambda s: s["p"]), "")
        .alias("parts")
    )


def rss_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("_page", F.floor(F.col("doc_id") / PER_PAGE))
    sent = F.timestamp_millis(F.lit(T0) + F.col("doc_id") * 60000)
    date = F.when(F.col("doc_id") % 6 == 0, F.lit("")).otherwise(
        F.concat(
            F.lit("<pubDate>"),
            F.when(F.col("doc_id") % 6 == 1, F.lit("not a date"))
            .when(F.col("doc_id") % 6 == 2, F.concat(F.date_format(sent, "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" GMT")))
            .otherwise(
                F.concat(
                    F.date_format(sent + F.expr("INTERVAL 8 HOURS"), "EEE, dd MMM yyyy HH:mm:ss"), F.lit(" +0800")
                )
            ),
            F.lit("</pubDate>"),
        )
    )
    item = F.concat(
        F.lit("<item><title>"), _escaped(F.concat(F.lit("["), F.col("text"), F.lit("]"))),
        F.lit("</title><link>https://feed.example/"), F.col("doc_id"), F.lit("</link><description>"),
        _escaped(F.concat(F.lit("<p class='x'>"), _escaped(F.col("text")), F.lit("</p><!-- c --><b>!</b>"))),
        F.lit("</description>"), date, F.lit("</item>"),
    )
    pages = _pages(docs, ["source", "_page"], "doc_id", item)
    return pages.select(
        F.concat(F.lit("https://feed.example/"), F.col("source")).alias("url"),
        F.concat(F.lit("<rss><channel><title>feed</title>"), F.col("parts"), F.lit("</channel></rss>")).alias("body"),
    )


def rest_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents").withColumn("_page", F.floor(F.col("doc_id") / PER_PAGE))
    post = F.struct(
        F.col("doc_id").alias("id"),
        F.col("text").alias("title"),
        F.concat(F.col("source"), F.lit(".example")).alias("domain"),
        F.concat(F.lit("https://"), F.col("source"), F.lit(".example/"), F.col("doc_id")).alias("url"),
        F.date_format(F.timestamp_millis(F.lit(T0) + F.col("doc_id") * 60000), "yyyy-MM-dd'T'HH:mm:ss'Z'").alias(
            "published_at"
        ),
    )
    return docs.groupBy("_page").agg(F.to_json(F.struct(F.collect_list(post).alias("results"))).alias("body"))


def timeline_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Conversations as timelines: user turns have content, the others are bare items."""
    turns = table(spark, sf_dir, "conversations").withColumn("_page", F.floor(F.col("turn") / PER_PAGE))
    content = F.concat(
        F.lit('<div class="tweet-content media-body" dir="auto"> '), _escaped(F.col("text")), F.lit(" </div>")
    )
    item = F.concat(
        F.lit('<div class="timeline-item"><a class="tweet-link" href="/x"></a>'),
        F.when(F.col("role") == "user", content).otherwise(F.lit("<span>repost</span>")),
        F.lit("</div>"),
    )
    pages = _pages(turns, ["conv_id", "_page"], "turn", item)
    return pages.select(
        F.concat(F.lit("user"), F.col("conv_id")).alias("account"),
        F.concat(F.lit("<html><body><div class='timeline'>"), F.col("parts"), F.lit("</div></body></html>")).alias("html"),
    )


def news_row_pages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents as rows of a news table with missing titles, sources and title links."""
    docs = table(spark, sf_dir, "documents").withColumn("_page", F.floor(F.col("doc_id") / PER_PAGE))
    n = F.col("doc_id")
    host = F.when(n % 3 == 0, "https://other.example").otherwise("")
    source = F.when(n % 7 == 0, "").otherwise(
        F.concat(F.lit('<span class="si-source-domain"> '), F.col("source"), F.lit(" </span>"))
    )
    title = F.when(n % 17 == 0, "").otherwise(_escaped(F.concat(F.lit("["), F.col("text"), F.lit("]"))))
    link = F.when(n % 19 == 0, "<b>sponsored</b>").otherwise(
        F.concat(
            F.lit('<a class="nc-title" href="'), host, F.lit("/news/"), n, F.lit('"><span class="title-text"><span>'),
            title, F.lit("</span><span>x</span></span>"), source, F.lit("</a>"),
        )
    )
    currency = F.when(n % 2 == 0, F.concat(F.lit('<div class="nc-currency"><a>'), F.col("lang"), F.lit("</a></div>"))).otherwise("")
    row = F.concat(F.lit('<div class="news-row news-row-link">'), link, currency, F.lit("</div>"))
    return _pages(docs, ["_page"], "doc_id", row).select(F.col("parts").alias("html"))


# ---- chain messages -------------------------------------------------------------------------

POOL_SQL = f"concat('0x', md5(CAST(user_id % {POOLS} AS VARCHAR(20))), '00000000')"


def chain_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Typed columns behind the chain messages."""
    return table(spark, sf_dir, "events").selectExpr(
        "event_id",
        "event_type",
        f"CASE WHEN event_id % 2 = 0 THEN upper({POOL_SQL}) ELSE {POOL_SQL} END AS address",
        f"CASE WHEN event_id % 3 = 0 THEN '{S.SWAP_TOPIC}' WHEN event_id % 3 = 1 THEN '{S.SYNC_TOPIC}' "
        "ELSE concat('0x', md5('other')) END AS topic0",
        "concat('0x', md5(CAST(event_id AS VARCHAR(20)))) AS hash",
        "19000000L + CAST(floor(event_id / 8) AS BIGINT) AS blockNumber",
        "event_id % 8 AS logIndex",
        "value",
    )


def chain_messages(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw messages: hashes (click, view), logs (purchase, signup), empty and foreign ones (error)."""
    log = F.struct(
        "address",
        F.array("topic0", F.col("hash")).alias("topics"),
        F.lit("0x00").alias("data"),
        F.col("hash").alias("transactionHash"),
        "blockNumber",
        "logIndex",
    )
    value = (
        F.when(F.col("event_type").isin("click", "view"), F.to_json(F.struct(F.col("hash").alias("result"))))
        .when(F.col("event_type") != "error", F.to_json(F.struct(log.alias("result"))))
        .when(F.col("event_id") % 3 == 0, F.lit('{"result": null}'))
        .when(F.col("event_id") % 3 == 1, F.lit('{"result": {"number": 7}}'))
        .otherwise(F.lit('{"id": 1}'))
    )
    return chain_events(spark, sf_dir).select("event_id", value.alias("value"))


def transaction_bodies(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Transaction bodies: other hashes than announced (view), contract creations, absent inputs."""
    return (
        chain_events(spark, sf_dir)
        .selectExpr(
            "CASE WHEN event_type = 'view' THEN concat('0x', md5(hash)) ELSE hash END AS hash",
            "CASE WHEN event_id % 7 = 0 THEN NULL ELSE address END AS `to`",
            "CAST(1000000000 + event_id AS STRING) AS gasPrice",
            "CAST(event_id % 5 AS STRING) AS maxPriorityFeePerGas",
            "CASE WHEN event_id % 4 = 0 THEN NULL ELSE concat('0x', md5(event_type)) END AS input",
        )
    )


def target_pools() -> list[str]:
    from hashlib import md5

    return [f"0x{md5(str(i).encode()).hexdigest()}00000000" for i in range(TARGET_POOLS)]
