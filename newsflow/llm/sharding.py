"""Placement by a permutation-filled lookup table.

Every shard prefers the slots of a prime-sized table in its own order, given by an offset and a step
from digests of its name. The shards take turns, each claiming its best slot that is still free, until
the table is full: shares differ by one slot at most, and when a shard leaves, few slots change hands
besides its own. The table's size is a parameter, so broadcasting it is bounded, and a document finds
its shard by one look-up, without a shuffle.

Defined results: a null ``doc_id`` goes to one fixed slot; repeated rows go to the same shard; an
empty table gives no rows.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pandas as pd
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

SLOTS = 65_537  # prime, some hundred slots for each of the shards below
SHARDS = tuple(f"shard-{i:03d}" for i in range(256))


def _digest(salt: str, name: str) -> int:
    return int.from_bytes(hashlib.blake2b(f"{salt}:{name}".encode(), digest_size=8).digest(), "little")


def fill(shards: tuple[str, ...] = SHARDS, slots: int = SLOTS) -> np.ndarray:
    """The shard number of every slot. ``slots`` must be prime, and no fewer than the shards."""
    if slots < len(shards) or not shards or any(slots % p == 0 for p in range(2, int(slots**0.5) + 1)):
        raise ValueError("the table needs a prime number of slots, one for each shard at least")
    at = [_digest("offset", s) % slots for s in shards]
    step = [_digest("step", s) % (slots - 1) + 1 for s in shards]
    table = np.full(slots, -1, np.int32)
    claimed = 0
    while claimed < slots:
        for shard in range(min(len(shards), slots - claimed)):
            slot = at[shard]
            while table[slot] >= 0:
                slot = (slot + step[shard]) % slots
            table[slot] = shard
            at[shard] = (slot + step[shard]) % slots
            claimed += 1
    return table


def place(docs: DataFrame, table: np.ndarray, shards: tuple[str, ...] = SHARDS) -> DataFrame:
    """``doc_id, slot, shard, shard_name`` for every row."""
    names = np.array(shards, dtype=object)[table]
    lookup = docs.sparkSession.createDataFrame(
        pd.DataFrame({"slot": np.arange(len(table)), "shard": table.astype(np.int64), "shard_name": names}),
        "slot long, shard long, shard_name string",
    )
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"))
    rows = rows.withColumn("slot", F.pmod(F.xxhash64("doc_id"), F.lit(len(table))).cast("long"))
    return rows.join(F.broadcast(lookup), "slot", "left").select("doc_id", "slot", "shard", "shard_name")
