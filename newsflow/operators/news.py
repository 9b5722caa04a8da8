"""Cleaning, filtering, deduplication and union of news."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow import schemas
from newsflow.functions import scalars as S
from newsflow.operators.keyed import first_per_key

FRESH_FOR_MS = 30 * 60 * 1000


def drop_blank_title(news: DataFrame) -> DataFrame:
    return news.where(S.is_filled(F.col("title")))


def fill_summary(news: DataFrame) -> DataFrame:
    """A blank or absent summary becomes the title."""
    return news.withColumn(
        "summary", F.when(S.is_filled(F.col("summary")), F.col("summary")).otherwise(F.col("title"))
    )


def require_pubdate(news: DataFrame) -> DataFrame:
    return news.where(F.col("pubDate").isNotNull())


def fresh_only(news: DataFrame, now: Column | None = None, window_ms: int = FRESH_FOR_MS) -> DataFrame:
    """Drop items published more than ``window_ms`` before ``now``; an unknown date (0) passes."""
    p = F.col("pubDate")
    limit = S.now_ms() if now is None else now
    return news.where(~F.coalesce((p > 0) & (p + window_ms < limit), F.lit(False)))


def clean(news: DataFrame) -> DataFrame:
    return fill_summary(drop_blank_title(news))


def extreme_gate(scored: DataFrame, score: str = "sentiment_score") -> DataFrame:
    """Mark the rows whose score is extreme enough for a back-test (<= 3 or >= 8)."""
    s = F.col(score)
    return scored.withColumn("backtested", ~((s < 8) & (s > 3)))


def extreme_only(scored: DataFrame, score: str = "sentiment_score") -> DataFrame:
    """Keep scores of at most 2 or at least 8."""
    s = F.col(score)
    return scored.where((s <= 2) | (s >= 8))


def dedup_new(items: DataFrame, seen: DataFrame | None, order: list[str], key: str = "id") -> DataFrame:
    """First sighting of each id that is not in ``seen``.

    The batch is reduced to one row per id first, so a hot id reaches the anti-join once.
    """
    firsts = first_per_key(items, [key], order)
    return firsts if seen is None else firsts.join(seen.select(key).distinct(), key, "left_anti")


def new_above(items: DataFrame, last_id: Column, key: str = "id") -> DataFrame:
    """Rows above a stored high-water mark; a null mark lets all rows pass."""
    return items.where(last_id.isNull() | (F.col(key) > last_id))


def keep_scraped(items: DataFrame) -> DataFrame:
    """Scraped rows with a title and a link; absent source and currency get their defaults."""
    return items.select(
        S.strip_blank(F.col("title")).alias("title"),
        F.col("link"),
        S.strip_blank(S.or_default(F.col("source"), "Unknown")).alias("source"),
        S.strip_blank(S.or_default(F.col("currency"), "")).alias("currency"),
    ).where((F.length("title") > 0) & (F.length("link") > 0))


def first_rows(items: DataFrame, order: list[str], n: int = 3) -> DataFrame:
    """The first ``n`` rows in a stated order (a report, not a step)."""
    return items.orderBy(*order).limit(n)


def union_feeds(*feeds: DataFrame) -> DataFrame:
    out = feeds[0]
    for feed in feeds[1:]:
        out = out.unionByName(feed)
    return out


def from_rest(posts: DataFrame, strict_schema: bool = False) -> DataFrame:
    """REST posts in the NewsItem shape. ``strict_schema`` leaves the publication date unknown."""
    published = S.to_epoch_ms(F.try_to_timestamp(F.col("published_at")))
    return posts.select(
        F.col("id").cast("string").alias("id"),
        "title",
        F.lit(None).cast("string").alias("summary"),
        (F.lit(None).cast("bigint") if strict_schema else published).alias("pubDate"),
        F.col("url").alias("source"),
        F.lit(None).cast("bigint").alias("es"),
    )


def from_tweets(tweets: DataFrame, strict_schema: bool = False) -> DataFrame:
    """Tweets in the NewsItem shape; their id comes from author and text."""
    sent = F.col("timestamp")
    return tweets.select(
        S.news_id(F.col("author"), F.col("raw_content")).alias("id"),
        "title",
        F.col("raw_content").alias("summary"),
        (F.lit(None).cast("bigint") if strict_schema else sent).alias("pubDate"),
        F.col("source_type").alias("source"),
        sent.alias("es"),
    )


def union_news(rss: DataFrame, rest: DataFrame, tweets: DataFrame, strict_schema: bool = False) -> DataFrame:
    """The three shapes of the shared news topic as one NewsItem frame."""
    names = schemas.NEWS_ITEM.fieldNames()
    return union_feeds(
        rss.select(names),
        from_rest(rest, strict_schema).select(names),
        from_tweets(tweets, strict_schema).select(names),
    )


def split_oversize(rows: DataFrame, limits: dict[str, int], vector: str | None = None,
                   dim: int | None = None) -> tuple[DataFrame, DataFrame]:
    """Rows that fit the declared lengths, and the others with a reason."""
    checks = [F.when(F.length(c) > n, F.lit(f"{c} longer than {n}")) for c, n in limits.items()]
    if vector is not None:
        bad = F.coalesce(F.size(vector), F.lit(-1)) != dim
        checks.append(F.when(bad, F.lit(f"{vector} is not of size {dim}")))
    marked = rows.withColumn("reason", F.coalesce(*checks))
    return marked.where("reason IS NULL").drop("reason"), marked.where("reason IS NOT NULL")


# ---- counts -------------------------------------------------------------------------------

def count_by(rows: DataFrame, label: str, name: str = "total") -> DataFrame:
    return rows.groupBy(label).agg(F.count(F.lit(1)).alias(name))


def last_batch_size(rows: DataFrame, label: str, batch: str) -> DataFrame:
    """Number of rows of the newest batch of each label."""
    per_batch = rows.groupBy(label, batch).agg(F.count(F.lit(1)).alias("n"))
    return per_batch.groupBy(label).agg(F.max_by("n", batch).alias("batch_size"))
