"""Exact histogram of encoded lengths, and what it says about every context limit.

Documents are encoded where they are read; only their lengths leave the tasks, added up before the
shuffle. A row per distinct length answers every limit: between two lengths that occur, the number of
longer documents does not change, so truncated totals are linear there (see ``at_limits``).

Defined results: a null or empty text has length 0; repeated rows count each; an empty table gives an
empty histogram.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsflow.llm.bpe import Codec, read_spec
from newsflow.llm.common import texts

RANGE = 1024  # lengths in one range of the two-level sums


def lengths(docs: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, n_tokens`` of each whole text, without special tokens."""
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(spec.value)
        for batch in batches:
            sizes = [len(ids) // 4 for ids in codec.encode(batch.column(1))]
            yield pa.record_batch([batch.column(0), pa.array(sizes, pa.int64())], names=["doc_id", "n_tokens"])

    return texts(docs).mapInArrow(run, "doc_id long, n_tokens long")


def histogram(counted: DataFrame) -> DataFrame:
    """``n_tokens, n_docs``."""
    return counted.groupBy("n_tokens").agg(F.count("*").alias("n_docs"))


def suffix_sums(hist: DataFrame, width: int = RANGE) -> DataFrame:
    """A row per length that occurs, taken as a context limit.

    ``n_docs`` of exactly that length, ``docs_over`` longer ones, ``tokens_upto`` in documents that
    fit, ``tokens_over`` in the others, ``truncated_total`` if every document is cut at the limit,
    and ``share_fitting``. Sums run inside ranges of ``width`` lengths and over the ranges' totals, so
    no task sorts the whole histogram.
    """
    rows = hist.select("n_tokens", "n_docs", F.floor(F.col("n_tokens") / width).alias("_range"))
    longer = Window.orderBy(F.desc("_range")).rowsBetween(Window.unboundedPreceding, -1)
    ranges = rows.groupBy("_range").agg(F.sum("n_docs").alias("_d"), F.sum(F.expr("n_docs * n_tokens")).alias("_t"))
    every = Window.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    ranges = ranges.select(
        "_range", F.coalesce(F.sum("_d").over(longer), F.lit(0)).alias("_docs"), F.coalesce(F.sum("_t").over(longer), F.lit(0)).alias("_tokens"),
        F.sum("_d").over(every).alias("_all_docs"), F.sum("_t").over(every).alias("_all_tokens"),
    )
    within = Window.partitionBy("_range").orderBy(F.desc("n_tokens")).rowsBetween(Window.unboundedPreceding, -1)
    over = lambda what, base: F.coalesce(F.sum(F.expr(what)).over(within), F.lit(0)) + F.col(base)
    summed = rows.join(ranges, "_range").select(
        "n_tokens", "n_docs", "_all_docs", "_all_tokens", over("n_docs", "_docs").alias("docs_over"), over("n_docs * n_tokens", "_tokens").alias("tokens_over"),
    )
    return summed.select(
        F.col("n_tokens").alias("context_limit"), "n_docs", "docs_over",
        (F.col("_all_tokens") - F.col("tokens_over")).alias("tokens_upto"), "tokens_over",
        F.expr("_all_tokens - tokens_over + docs_over * n_tokens").alias("truncated_total"),
        F.expr("(_all_docs - docs_over) / _all_docs").alias("share_fitting"),
    )


def at_limits(sums: DataFrame, limits: list[int]) -> list[dict[str, int]]:
    """Totals for any limits, from the longest length that occurs at or below each."""
    out = []
    for limit in limits:
        below = sums.where(F.col("context_limit") <= limit).orderBy(F.desc("context_limit")).first()
        first = sums.orderBy("context_limit").first()
        if below is None:  # every document is longer
            over = 0 if first is None else first.n_docs + first.docs_over
            out.append({"limit": limit, "docs_over": over, "tokens_upto": 0, "truncated_total": over * limit})
        else:
            total = below.tokens_upto + below.docs_over * limit
            out.append({"limit": limit, "docs_over": below.docs_over, "tokens_upto": below.tokens_upto, "truncated_total": total})
    return out


def quantiles(sums: DataFrame, shares: list[float]) -> list[int | None]:
    """The smallest length that at least each share of the documents does not exceed."""
    found = [sums.where(F.col("share_fitting") >= q).agg(F.min("context_limit")).first()[0] for q in shares]
    return [None if x is None else int(np.int64(x)) for x in found]
