"""The corpus pipeline: documents in, packed training sequences out.

Every stage works on all that the one before kept, and all but the last give back the columns of
documents. ``n_chars`` follows the text. Each stage's rows are written and read again, so a lost
executor costs no more than its own stage.

Defined results: null texts pass as they are (packing takes them as empty); documents whose text
becomes empty stay; further columns are carried along; rows that repeat a ``doc_id`` are one document;
an empty table passes every stage.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from newsflow.llm import line_dedup, near_dup, packing, pii, toxicity
from newsflow.llm.common import configure
from newsflow.llm.queries import WORD_TOKENIZER
from newsflow.session import written


def _counted(docs: DataFrame) -> DataFrame:
    if "n_chars" not in docs.columns:
        return docs
    return docs.withColumn("n_chars", F.when(F.col("text").isNull(), F.col("n_chars")).otherwise(F.length("text")).cast(docs.schema["n_chars"].dataType))


def drop_toxic(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Drops the documents with a toxic sentence; labels kept for testing don't train."""
    labels = configure(spark).read.parquet(f"{sf_dir}/labels.parquet")
    return toxicity.keep_clean(docs, toxicity.train(docs, labels.where(~toxicity.held_out())))


def drop_repeated_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Cuts lines that three documents share, but in the last of them."""
    configure(spark)
    return _counted(line_dedup.without_repeats(docs))


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Keeps the smallest doc_id of each class of near copies."""
    configure(spark)
    return near_dup.keep_one(docs)


def redact_personal_data(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Replaces personal data and secrets by their kind."""
    configure(spark)
    return _counted(pii.redact(docs, pii.train(docs)))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of at most 4,096 tokens with their ids and their place in a sequence."""
    configure(spark)
    return packing.pack(docs, WORD_TOKENIZER)


STAGES = [
    ("toxicity", drop_toxic),
    ("line_dedup", drop_repeated_lines),
    ("near_duplicates", drop_near_copies),
    ("pii", redact_personal_data),
    ("packing", pack_sequences),
]

#: Trained scores, word hashes and tokenizers have no SQL; the stages are tested against brute force.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = configure(spark).read.parquet(f"{sf_dir}/documents.parquet")
    for name, stage in STAGES:
        docs = written(stage(spark, docs, sf_dir), name)
    return docs
