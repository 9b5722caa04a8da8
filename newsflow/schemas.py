"""Row types of every stream and table."""

from pyspark.sql import types as T


_TEXT, _LONG, _DOUBLE, _TIME = T.StringType(), T.LongType(), T.DoubleType(), T.TimestampType()
_INT, _FLOAT, _BOOL = T.IntegerType(), T.FloatType(), T.BooleanType()
_TEXTS, _FLOATS, _MAP = T.ArrayType(_TEXT), T.ArrayType(_FLOAT), T.MapType(_TEXT, _TEXT)


def _row(columns: dict[str, T.DataType]) -> T.StructType:
    return T.StructType([T.StructField(name, kind) for name, kind in columns.items()])


# Field names and types of the messages and tables.
NEWS_ITEM = _row({
    "id": _TEXT, "title": _TEXT, "summary": _TEXT, "pubDate": _LONG, "source": _TEXT, "es": _LONG,
})
WEB_RESPONSE = _row({
    "url": _TEXT, "status": _INT, "body": _TEXT,
})
NEWS_REST = _row({
    "id": _LONG, "title": _TEXT, "domain": _TEXT, "url": _TEXT, "published_at": _TEXT,
    "source_type": _TEXT,
})
NEWS_TWEET = _row({
    "title": _TEXT, "raw_content": _TEXT, "source_type": _TEXT, "author": _TEXT,
    "timestamp": _LONG,
})
SCRAPED_ITEM = _row({
    "title": _TEXT, "link": _TEXT, "source": _TEXT, "currency": _TEXT,
})
SENTIMENT_DATA = _row({
    "asset": _TEXT, "raw_text": _TEXT, "source": _TEXT, "timestamp": _LONG,
})
SCORED_NEWS = _row({
    "id": _TEXT, "title": _TEXT, "summary": _TEXT, "pubDate": _LONG, "source": _TEXT, "es": _LONG,
    "sentiment_score": _LONG, "sentiment_reason": _TEXT, "raw_content": _TEXT,
    "sentiment_es": _LONG,
})
KLINE = _row({
    "timestamp": _LONG, "open": _DOUBLE, "high": _DOUBLE, "low": _DOUBLE, "close": _DOUBLE,
    "volume": _DOUBLE,
})
KLINE_FEATURES = _row({
    "timestamp": _LONG, "datetime_sh": _TEXT, "price_at_t": _DOUBLE, "rsi_14": _DOUBLE,
    "atr_14": _DOUBLE, "high": _DOUBLE, "low": _DOUBLE, "close": _DOUBLE,
})
MEMORY = _row({
    "event_id": _TEXT, "title": _TEXT, "sentiment_score": _LONG, "rsi_14": _DOUBLE,
    "atr_14": _DOUBLE, "price_at_t": _DOUBLE, "pub_date": _LONG, "sentiment_es": _LONG,
    "vector": _FLOATS, "is_settled": _BOOL, "win_rate": _DOUBLE, "return": _DOUBLE,
})
MEMORY_V1 = _row({
    "id": _LONG, "raw_content": _TEXT, "sentiment_score": _INT, "sentiment_reason": _TEXT,
    "timestamp": _LONG, "vector": _FLOATS, "price_at_t": _FLOAT, "price_after_24h": _FLOAT,
    "return_24h": _FLOAT, "is_settled": _BOOL,
})
LOG_MEMORY = _row({
    "id": _LONG, "raw_log": _TEXT, "vector": _FLOATS, "extra": _MAP,
})
TRADE_SIGNAL = _row({
    "action": _TEXT, "token": _TEXT, "pubDate": _LONG, "sentiment_es": _LONG, "buy_time": _LONG,
    "sell_time": _LONG, "trigger_score": _LONG, "timestamp": _LONG, "event_id": _TEXT,
    "buy_price": _DOUBLE, "sell_price": _DOUBLE,
})
EMPLOYEE = _row({
    "id": _LONG, "name": _TEXT, "department": _TEXT, "salary": _DOUBLE, "message_time": _TIME,
})
USER_CLICK = _row({
    "user_id": _TEXT, "item_id": _TEXT, "behavior": _TEXT, "ts": _TEXT,
})
MEMPOOL_TX = _row({
    "hash": _TEXT, "to": _TEXT, "gasPrice": _TEXT, "maxPriorityFeePerGas": _TEXT, "input": _TEXT,
})
DEX_LOG = _row({
    "address": _TEXT, "topics": _TEXTS, "data": _TEXT, "transactionHash": _TEXT,
    "blockNumber": _LONG, "logIndex": _LONG,
})
MODEL_REPLY = _row({
    "sentiment_score": _TEXT, "sentiment_reason": _TEXT,
})

# Declared lengths of text columns in memory tables elsewhere; our tables keep texts of any length.
MEMORY_TEXT_LIMITS = {"event_id": 128, "title": 512}
VECTOR_DIM = 768
