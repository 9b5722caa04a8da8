"""Landed web responses to news rows: RSS, REST pages and HTML pages."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.functions import markup, scalars as S

_RSS = (
    "struct<channel:struct<item:array<struct<title:string,link:string,description:string,pubDate:string>>>>"
)
_POST = "struct<id:bigint,title:string,domain:string,url:string,published_at:string>"
_REST = f"struct<results:array<{_POST}>>"

# Elements and classes that hold the fields of the two page kinds.
TWEET_ROW = ("div", "timeline-item")
TWEET_PICKS = (markup.Pick("text", (("div", "tweet-content"),)),)
NEWS_ROW = (None, "news-row")
NEWS_PICKS = (
    markup.Pick("link", (("a", "nc-title"),), attr="href"),
    markup.Pick("title", (("a", "nc-title"), (None, "title-text"), ("span", None)), first_child=True),
    markup.Pick("source", (("a", "nc-title"), (None, "si-source-domain"))),
    markup.Pick("currency", ((None, "nc-currency"), ("a", None))),
)


def landed_ok(responses: DataFrame) -> DataFrame:
    """Responses with status 200; any other status gives no items."""
    return responses.where("status = 200")


def rss_items(responses: DataFrame, now: Column | None = None) -> DataFrame:
    """NewsItem rows of RSS documents ``(url, body)``: clean summary, date in ms (0 if unknown)."""
    items = responses.select(
        F.col("url").alias("source"), F.explode(F.from_xml(F.col("body"), _RSS)["channel"]["item"]).alias("i")
    )
    return items.select(
        S.news_id(F.col("i.link"), F.col("i.title")).alias("id"),
        F.col("i.title").alias("title"),
        markup.html_to_text(F.col("i.description")).alias("summary"),
        S.rfc822_to_epoch_ms(F.col("i.pubDate")).alias("pubDate"),
        "source",
        (S.now_ms() if now is None else now).alias("es"),
    )


def rest_posts(responses: DataFrame, source_type: str, keep: list[str] = []) -> DataFrame:
    """Posts of REST pages ``(body)``, with the columns ``keep`` of their page."""
    posts = responses.select(*keep, F.explode(F.from_json(F.col("body"), _REST)["results"]).alias("p"))
    return posts.select("p.*", F.lit(source_type).alias("source_type"), *keep)


def timeline_tweets(pages: DataFrame, now: Column | None = None, source_type: str = "timeline") -> DataFrame:
    """Tweets of HTML pages ``(account, html)``: one row per timeline item that has content."""
    at = S.now_ms() if now is None else now
    items = pages.select("account", F.explode(markup.html_rows(F.col("html"), TWEET_ROW, TWEET_PICKS)).alias("t"))
    return items.where("t.text IS NOT NULL").select(
        F.concat(F.lit("Tweet from @"), F.col("account")).alias("title"),
        F.col("t.text").alias("raw_content"),
        F.lit(source_type).alias("source_type"),
        F.col("account").alias("author"),
        at.alias("timestamp"),
    )


def news_rows(pages: DataFrame) -> DataFrame:
    """Raw scraped items of HTML pages ``(html)``; rows without a title link drop out."""
    items = pages.select(F.explode(markup.html_rows(F.col("html"), NEWS_ROW, NEWS_PICKS)).alias("r"))
    return items.where("r.link IS NOT NULL").select("r.*")


def scraped_items(pages: DataFrame, host: str) -> DataFrame:
    """Scraped items with defaults and absolute links."""
    from newsflow.operators.news import keep_scraped

    return keep_scraped(news_rows(pages)).withColumn("link", S.absolute_url(F.col("link"), host))


def sentiment_items(pages: DataFrame, prefix: str, keywords: dict[str, str] | None = None,
                    now: Column | None = None) -> DataFrame:
    """SentimentData rows of HTML pages: titles with an asset tag, collection time in seconds."""
    at = S.now_ms() if now is None else now
    rows = news_rows(pages).select(
        S.strip_blank(F.col("title")).alias("raw_text"),
        S.strip_blank(S.or_default(F.col("source"), "Unknown")).alias("source"),
    )
    return rows.where(F.length("raw_text") > 0).select(
        S.asset_tag(F.col("raw_text"), keywords or {}).alias("asset"),
        "raw_text",
        F.concat(F.lit(prefix), F.col("source")).alias("source"),
        F.floor(at / 1000).alias("timestamp"),
    )
