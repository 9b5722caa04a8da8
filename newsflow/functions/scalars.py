"""Column expressions. All of them run inside the JVM."""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column
from pyspark.sql import functions as F

# First topic (keccak-256 of the signature) of two pool events.
SWAP_TOPIC = "0xc42079f94a6350d7e6235f29174924f928cc2ac818eb64fed8004e115fbcca67"
SYNC_TOPIC = "0x1c411e9a96e071241c2f21f7726b17ae89e3cab4c78be50e062b03a9fffbbad1"
EVENT_TOPICS = {
    "Swap(address,address,int256,int256,uint160,uint128,int24)": SWAP_TOPIC,
    "Sync(uint112,uint112)": SYNC_TOPIC,
}

# Zone names of RFC 822 dates and their offsets.
RFC822_ZONES = {
    "UT": "+0000",
    "UTC": "+0000",
    "GMT": "+0000",
    "Z": "+0000",
    "EST": "-0500",
    "EDT": "-0400",
    "CST": "-0600",
    "CDT": "-0500",
    "MST": "-0700",
    "MDT": "-0600",
    "PST": "-0800",
    "PDT": "-0700",
}
_RFC822_PATTERNS = (
    "d MMM yyyy HH:mm:ss Z",
    "d MMM yyyy HH:mm Z",
    "d MMM yy HH:mm:ss Z",
    "d MMM yy HH:mm Z",
)


# ---- text ---------------------------------------------------------------------------------

def is_filled(text: Column) -> Column:
    """True when the text holds any character above U+0020 (so tabs and newlines count as blank)."""
    return F.coalesce(text.rlike("[^\\x00-\\x20]"), F.lit(False))


def strip_blank(text: Column) -> Column:
    """Cut every leading and trailing character up to U+0020."""
    return F.regexp_replace(text, "^[\\x00-\\x20]+|[\\x00-\\x20]+$", "")


def or_default(value: Column, default: str = "unknown") -> Column:
    return F.coalesce(value, F.lit(default))


def preview(text: Column, n: int = 40) -> Column:
    """Text for a log line. Never an input of another operator."""
    return F.concat(F.substring(text, 1, n), F.lit("..."))


def news_id(link: Column, title: Column) -> Column:
    """Identity of a news item: md5 of link and title, absent parts as empty text."""
    return F.md5(F.concat(F.coalesce(link, F.lit("")), F.coalesce(title, F.lit(""))))


def absolute_url(link: Column, host: str) -> Column:
    return F.when(link.startswith("/"), F.concat(F.lit(host.rstrip("/")), link)).otherwise(link)


def hex_text(raw: Column) -> Column:
    """Bytes as lower-case hex with the 0x mark; nothing gives the empty mark."""
    return F.coalesce(F.concat(F.lit("0x"), F.lower(F.hex(raw))), F.lit("0x"))


def normal_hex(text: Column) -> Column:
    """Hex text in lower case with the 0x mark; nothing gives the empty mark."""
    low = F.lower(text)
    return F.coalesce(F.when(low.startswith("0x"), low).otherwise(F.concat(F.lit("0x"), low)), F.lit("0x"))


# ---- time ---------------------------------------------------------------------------------

def now_ms() -> Column:
    return F.unix_millis(F.current_timestamp())


def to_epoch_ms(ts: Column) -> Column:
    return F.unix_millis(ts.cast("timestamp"))


def rfc822_to_epoch_ms(text: Column) -> Column:
    """RFC 822 date to epoch milliseconds; 0 when absent or unreadable."""
    s = F.regexp_replace(text, "\\([^)]*\\)", " ")
    s = F.trim(F.regexp_replace(s, "\\s+", " "))
    s = F.regexp_replace(s, "^[A-Za-z]+\\s*,?\\s*(?=[0-9])", "")
    zone = F.upper(F.regexp_extract(s, "([A-Za-z]+)$", 1))
    pairs = [F.lit(x) for kv in RFC822_ZONES.items() for x in kv]
    offset = F.try_element_at(F.create_map(*pairs), zone)
    s = F.when(offset.isNotNull(), F.concat(F.regexp_replace(s, "\\s*[A-Za-z]+$", " "), offset)).otherwise(s)
    parsed = F.coalesce(*[F.try_to_timestamp(s, F.lit(p)) for p in _RFC822_PATTERNS])
    return F.coalesce(F.unix_millis(parsed), F.lit(0).cast("bigint"))


def shanghai_datetime(ms: Column) -> Column:
    """Wall clock in Shanghai; needs the session zone UTC."""
    return F.date_format(
        F.from_utc_timestamp(F.timestamp_millis(ms), "Asia/Shanghai"), "yyyy-MM-dd HH:mm:ss"
    )


def day_label(ms: Column) -> Column:
    return F.date_format(F.timestamp_millis(ms), "yyyyMMdd")


# ---- model dialogue -----------------------------------------------------------------------

def title_and_summary(title: Column, summary: Column) -> Column:
    return F.concat(F.lit("Title: "), title, F.lit("\nSummary: "), summary)


REPLY_FORM = (
    'Answer with {"sentiment_score": n, "sentiment_reason": "..."} alone: n from 1 (the price will fall) to 10 '
    "(it will rise), and why in one short sentence.\n\n"
)
SCORING_HEADER = "A news item follows. Judge what it means for the ETH price.\n" + REPLY_FORM
ANALYSIS_HEADER = "A message from the ETH market follows, as it was posted. Judge the mood of its author towards the price.\n" + REPLY_FORM


def scoring_prompt(content: Column, header: str = SCORING_HEADER) -> Column:
    """Ask for one JSON object with a 1..10 score and a short reason."""
    return F.concat(F.lit(header), content)


def analysis_prompt(message: Column) -> Column:
    """The same for a whole message that has neither title nor summary."""
    return scoring_prompt(message, ANALYSIS_HEADER)


def json_object_text(reply: Column) -> Column:
    """The part from the first opening to the last closing brace, null when there is none."""
    cut = F.regexp_extract(reply, "(?s)(\\{.*\\})", 1)
    return F.when(cut != "", cut)


def model_reply(reply: Column, schema) -> Column:
    """Parsed reply struct, null when no readable object is inside."""
    return F.from_json(json_object_text(reply), schema)


def valid_score(score: Column) -> Column:
    """The score as BIGINT when it is a whole number in 1..10, else null."""
    n = score.try_cast("bigint")
    return F.when(n.between(1, 10), n)


# ---- numbers ------------------------------------------------------------------------------

def return_rate(buy: Column, sell: Column) -> Column:
    """(sell - buy) / buy, null when buy is zero."""
    return F.try_divide(sell - buy, buy)


def win_flag(rate: Column) -> Column:
    return F.when(rate > 0, F.lit(1.0)).otherwise(F.lit(0.0))


def rsi_floor(rsi: Column, slack: float = 5.0) -> Column:
    """Lower RSI limit of the hybrid search, two decimals, half up."""
    return F.round(rsi - F.lit(slack), 2)


def decision_action(score: Column) -> Column:
    return F.when(score > 8, "BUY").when(score < 2, "SELL").otherwise("HOLD")


def buy_decision(max_similarity: Column, win_rate: Column, sim: float = 0.9, win: float = 0.65) -> Column:
    return F.when((max_similarity > sim) & (win_rate > win), "EXECUTE_BUY").otherwise("HOLD")


# ---- vectors ------------------------------------------------------------------------------

def as_vector(values: Column) -> Column:
    return values.cast("array<float>")


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def cosine_similarity(a: Column, b: Column) -> Column:
    """Cosine of two arrays, null when one of them has no length."""
    return F.try_divide(dot(a, b), F.sqrt(dot(a, a)) * F.sqrt(dot(b, b)))


def feature_array(score: Column, vector: Column) -> Column:
    """Score first, then the vector, as doubles."""
    return F.concat(F.array(score.cast("double")), vector.cast("array<double>"))


# ---- tags ---------------------------------------------------------------------------------

def asset_tag(text: Column, keywords: dict[str, str], default: str = "UNKNOWN") -> Column:
    """Tag of the first keyword found as a word in the text."""
    low = F.lower(text)
    return reduce(
        lambda rest, kv: F.when(low.rlike(f"(^|\\W){kv[0].lower()}(\\W|$)"), kv[1]).otherwise(rest),
        reversed(list(keywords.items())),
        F.lit(default),
    )
