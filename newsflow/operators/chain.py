"""Messages of a chain subscription: routing, pending transactions and pool logs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow import schemas
from newsflow.functions import scalars as S

_LOG_MESSAGE = f"struct<result:{schemas.DEX_LOG.simpleString()}>"


def route(messages: DataFrame, value: str = "value") -> DataFrame:
    """Adds ``route``: tx for a text result, log for an object with topics, empty or other."""
    result = F.try_variant_get(F.try_parse_json(F.col(value)), "$.result", "variant")
    parsed = messages.withColumn("_r", result).withColumn("_kind", F.schema_of_variant(F.col("_r")))
    # objects are never turned into text, which would cost more than all the rest
    whole = F.try_variant_get(F.col("_r"), "$", "string")
    parsed = parsed.withColumn("_text", F.when(~F.col("_kind").startswith("OBJECT"), whole))
    kind, text = F.col("_kind"), F.col("_text")
    topics = F.try_variant_get(F.col("_r"), "$.topics", "variant")
    target = (
        F.when(kind.isNull() | kind.isin("VOID", "OBJECT<>") | text.isin("", "[]", "0", "false"), "empty")
        .when(kind == "STRING", "tx")
        .when(kind.startswith("OBJECT") & topics.isNotNull(), "log")
        .otherwise("other")
    )
    routed = F.struct(target.alias("route"), F.when(kind == "STRING", F.nullif(text, F.lit(""))).alias("tx_hash"))
    # as a generator the parse runs once; as plain columns every later filter would repeat it
    return parsed.select(*[f"`{c}`" for c in messages.columns], F.inline(F.array(routed)))


def tx_hashes(routed: DataFrame) -> DataFrame:
    return routed.where("route = 'tx'")


def logs(routed: DataFrame, value: str = "value") -> DataFrame:
    """Typed log rows of the routed messages."""
    rest = [c for c in routed.columns if c not in (value, "route", "tx_hash")]
    log = F.from_json(F.col(value), _LOG_MESSAGE)["result"]
    return routed.where("route = 'log'").select(*rest, F.inline(F.array(log)))


def pool_logs(rows: DataFrame, pools: list[str] | DataFrame, topics: tuple[str, ...] = (S.SWAP_TOPIC, S.SYNC_TOPIC)) -> DataFrame:
    """Logs of the given pools whose first topic is one of ``topics``; case is ignored.

    A list of pools becomes a filter, a table of pools (column ``address``) a semi-join.
    """
    hit = rows.where(F.lower(F.col("topics")[0]).isin([t.lower() for t in topics]))
    if isinstance(pools, DataFrame):
        wanted = pools.select(F.lower("address").alias("_a")).distinct()
        return hit.join(wanted, F.lower(hit["address"]) == F.col("_a"), "left_semi")
    return hit.where(F.lower("address").isin([p.lower() for p in pools]))


def pending_transactions(hashes: DataFrame, bodies: DataFrame) -> DataFrame:
    """Bodies of the announced hashes; unknown hashes and contract creations drop out."""
    names = schemas.MEMPOOL_TX.fieldNames()
    found = hashes.select(F.col("tx_hash").alias("hash")).join(bodies, "hash")
    return call_transactions(found).select(names)


def call_transactions(bodies: DataFrame) -> DataFrame:
    """Transactions with a receiver; an absent or empty input becomes the empty mark."""
    text = F.when(F.length("input") > 0, F.col("input"))
    return bodies.where(F.length("to") > 0).withColumn("input", F.coalesce(text, F.lit("0x")))


def keyed_payload(rows: DataFrame, key: str) -> DataFrame:
    """``key`` and JSON ``value`` columns for a keyed topic."""
    return rows.select(F.col(key).alias("key"), F.to_json(F.struct("*")).alias("value"))
