"""Line deduplication that can be taken back.

A line's key is the line without white space at its ends and with A-Z in lower case. Keys of at least
``min_chars`` code points that at least ``min_docs`` documents hold lose all their lines, except in
the largest ``doc_id`` that holds them. Sharded cuckoo filters say which keys are live; behind them
exact tables count each key's documents, so inserting documents and deleting them again restores
every count (``LiveIndex``), and the lines of the others with it.

Defined results: a null or empty text is one empty line; a null ``doc_id`` is one document that loses
against any other; rows that repeat a ``doc_id`` are one document, and each of them loses the lines
that the document loses; an empty table gives no rows.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.llm.common import SPACES, parts_for, texts
from newsflow.llm.cuckoo import NO_DOC, LiveIndex, document
from newsflow.session import written

MIN_CHARS, MIN_DOCS = 20, 3
EACH = 1 << 18  # rows of lines for one shard


def line_key(line: str) -> bytes:
    """128 bits of the key; two of a trillion lines agree by chance once in 10^14 corpora."""
    return hashlib.md5(line.strip(SPACES).encode().lower(), usedforsecurity=False).digest()


def members(docs: DataFrame, min_chars: int = MIN_CHARS) -> DataFrame:
    """One row for each document and long enough key in it."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            keys, holders = [], []
            for doc, text in zip(batch.column(0).to_pylist(), batch.column(1).to_pylist(), strict=True):
                own = {line_key(x) for x in text.split("\n") if len(x) >= min_chars and len(x.strip(SPACES)) >= min_chars}
                keys += own
                holders += [doc] * len(own)
            yield pa.record_batch([pa.array(keys, pa.binary()), pa.array(holders, pa.int64())], names=["key", "doc_id"])

    rows = texts(docs).mapInArrow(run, "key binary, doc_id long").distinct()
    return rows.select("key", "doc_id", F.lit(0).cast("long").alias("first"), F.coalesce("doc_id", F.lit(NO_DOC)).alias("second"))


def build(docs: DataFrame, min_chars: int = MIN_CHARS, each: int = EACH) -> LiveIndex:
    rows = written(members(docs, min_chars), "lines")
    return LiveIndex(parts_for(docs.sparkSession, rows.count(), each), rows).insert(rows)


def dropped_keys(index: LiveIndex, min_docs: int = MIN_DOCS) -> DataFrame:
    """``_llm_doc, _llm_dropped``: the keys that each document loses."""
    common = index.entries.where(F.col("n") >= min_docs).select("key", document("second").alias("_keeper"))
    lost = index.members.join(common, "key").where(F.expr("NOT doc_id <=> _keeper"))
    return lost.groupBy(F.col("doc_id").alias("_llm_doc")).agg(F.collect_list("key").alias("_llm_dropped"))


def apply(docs: DataFrame, dropped: DataFrame) -> DataFrame:
    """``docs`` with the lost lines cut out of ``text``, and ``_llm_lines``, ``_llm_lost``: how many lines
    there were and went."""
    at = docs.columns.index("text")
    schema = T.StructType([*docs.schema.fields, T.StructField("_llm_lines", T.LongType()), T.StructField("_llm_lost", T.LongType())])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            kept, before, lost = [], [], []
            for text, keys in zip(batch.column(at).to_pylist(), batch.column(batch.num_columns - 1).to_pylist(), strict=True):
                lines = (text or "").split("\n")
                gone = set(keys or ())
                stay = [x for x in lines if line_key(x) not in gone] if gone else lines
                kept.append("\n".join(stay) if gone else text)
                before.append(len(lines))
                lost.append(len(lines) - len(stay))
            columns = [*batch.columns[:-1], pa.array(before, pa.int64()), pa.array(lost, pa.int64())]
            columns[at] = pa.array(kept, batch.column(at).type)
            yield pa.record_batch(columns, names=[f.name for f in schema])

    same = F.col("doc_id").cast("long").eqNullSafe(F.col("_llm_doc"))
    return docs.join(dropped, same, "left").drop("_llm_doc").mapInArrow(run, schema)


def dedup_lines(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``doc_id, text, n_lines, n_dropped``."""
    cut = apply(docs.select("doc_id", "text"), dropped_keys(build(docs, min_chars), min_docs))
    return cut.select("doc_id", F.coalesce("text", F.lit("")).alias("text"), F.col("_llm_lines").alias("n_lines"), F.col("_llm_lost").alias("n_dropped"))


def without_repeats(docs: DataFrame, min_chars: int = MIN_CHARS, min_docs: int = MIN_DOCS) -> DataFrame:
    """``docs`` with the lost lines cut out of ``text``, all other columns as they are."""
    return apply(docs, dropped_keys(build(docs, min_chars), min_docs)).drop("_llm_lines", "_llm_lost")
