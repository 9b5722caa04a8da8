"""Exact deduplication over an index of live digests in sharded cuckoo filters.

Texts are equal when they are the same after all white space is deleted. The SHA-256 of what is left
is the key; within a group of equal texts the longest original (in code points) stays, then the
smallest ``doc_id``. The index takes further documents and gives documents back (``LiveIndex.insert``
and ``LiveIndex.delete``).

Defined results: a null text is an empty one, and all empty texts are one group; a null ``doc_id``
loses against any other; rows that repeat a ``doc_id`` count each, and all of those that stay are
kept; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import SPACES, parts_for, texts
from newsflow.llm.cuckoo import NO_DOC, LiveIndex, document
from newsflow.session import written

EACH = 1 << 16  # digests in one shard


def members(docs: DataFrame) -> DataFrame:
    """``key`` (the digest), ``doc_id``, and the rank among equal texts, for every row."""
    blanks = SPACES.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = batch.column(1).to_pylist()
            keys = [hashlib.sha256(t.encode().translate(None, blanks)).digest() for t in found]
            yield pa.record_batch(
                [pa.array(keys, pa.binary()), batch.column(0), pa.array([len(t) for t in found], pa.int64())],
                names=["key", "doc_id", "first"],
            )

    ranked = texts(docs).mapInArrow(run, "key binary, doc_id long, first long")
    return ranked.withColumn("second", F.coalesce(-F.col("doc_id"), F.lit(NO_DOC)))


def build(docs: DataFrame, each: int = EACH) -> LiveIndex:
    """An index of all documents, in shards of about ``each`` digests."""
    rows = written(members(docs), "digests")
    return LiveIndex(parts_for(docs.sparkSession, rows.count(), each), rows).insert(rows)


def verdicts(index: LiveIndex) -> DataFrame:
    """One row per live document: ``doc_id, keep_id, group_size, kept, text_sha256``."""
    groups = index.entries.select("key", document("second", -1).alias("keep_id"), F.col("n").alias("group_size"))
    return index.members.join(groups, "key").select(
        "doc_id", "keep_id", "group_size", F.expr("doc_id <=> keep_id").alias("kept"), F.lower(F.hex("key")).alias("text_sha256")
    )
