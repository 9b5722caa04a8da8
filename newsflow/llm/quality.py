"""Quality rules: figures of each text, and line frequency across the documents of a host.

Lines are normalised (white space at the ends stripped, A-Z in lower case) and hashed. For each host
the documents that hold a line are counted, copies of one text as one document. Lines held by more
than ``min_docs`` documents of the host are boilerplate, however large the host; a ``share`` above zero
also asks for more than this part of the host's documents. ``without_boilerplate`` takes these lines out
of the texts. A document that fails the rules on its own figures is rejected; so is a depleted one, of
which less than ``least_words`` words or less than ``least_share`` of its words are left without them. ``judge``
reads each text once: what it needs of the lines are their keys and numbers of words.

Defined results: a null or empty text has no words and fails; a null host is a host of its own; rows
that repeat a ``doc_id`` are judged each by their own text; an empty table gives no rows; a text of
boilerplate alone becomes empty, and a null text stays null.
"""

from __future__ import annotations

import hashlib
from collections import Counter
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.llm.common import SPACES, whole_text
from newsflow.session import written

SYMBOLS = "#*$%&|<>"
MIN_WORDS, MAX_REPEATED = 50, 0.5
MIN_DOCS, SHARE = 50, 0.0
LEAST_WORDS, LEAST_SHARE = 50, 0.5

_FIGURES = (
    "doc_id long, n_words long, word_chars long, n_symbols long, n_dup_lines long, n_repeat_words long, "
    "host string, content binary, keys array<binary>, words array<int>"
)


def line_key(line: bytes) -> bytes:
    return hashlib.md5(line.strip(SPACES.encode()).lower(), usedforsecurity=False).digest()


def cut(text: str, gone: list[bytes] | None) -> str:
    """``text`` without the lines whose keys are ``gone``."""
    if not gone:
        return text
    keys = set(gone)
    return "\n".join(x for x in text.split("\n") if line_key(x.encode()) not in keys)


def repeated_words(words: list[bytes]) -> int:
    """Words that lie in a window of three found twice or more."""
    grams = list(zip(words, words[1:], words[2:], strict=False))
    if len(set(grams)) == len(grams):
        return 0
    counts = Counter(grams)
    total = end = 0
    for i, gram in enumerate(grams):
        if counts[gram] > 1:
            total += i + 3 - max(i, end)
            end = i + 3
    return total


def held_lines(docs: DataFrame, host: str = "source") -> DataFrame:
    """``host``, a digest of the text (``content``) and its distinct lines that have words (``keys``), by row."""
    blanks = SPACES.encode()

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            contents, keys = [], []
            for text in batch.column(1).to_pylist():
                data = text.encode()
                contents.append(hashlib.md5(data, usedforsecurity=False).digest())
                keys.append(list({line_key(x) for x in data.split(b"\n") if x.strip(blanks)}))
            columns = [batch.column(0), pa.array(contents, pa.binary()), pa.array(keys, pa.list_(pa.binary()))]
            yield pa.record_batch(columns, names=["host", "content", "keys"])

    rows = docs.select(F.col(host).cast("string").alias("host"), whole_text().alias("text"))
    return rows.mapInArrow(run, "host string, content binary, keys array<binary>")


def boilerplate(held: DataFrame, min_docs: int = MIN_DOCS, share: float = SHARE) -> DataFrame:
    """``host, key``: lines above their host's limit. Counts are added up before the shuffle."""
    distinct = held.groupBy("host", "content").agg(F.first("keys").alias("keys"))
    hosts = distinct.groupBy("host").agg(F.count("*").alias("n_docs"))
    counted = distinct.select("host", F.explode("keys").alias("key")).groupBy("host", "key").agg(F.count("*").alias("n_held"))
    counted = counted.where(F.col("n_held") > min_docs)
    if share <= 0:
        return counted.select("host", "key")
    above = counted.alias("l").join(hosts.alias("h"), F.expr("l.host <=> h.host")).where(F.col("n_held") > share * F.col("n_docs"))
    return above.select("l.host", "key")


def with_gone(docs: DataFrame, host: str, min_docs: int, share: float) -> DataFrame:
    """``docs`` and ``_llm_gone``: the keys of the boilerplate lines of each text, or null.

    The keys are written by host and text, so where few texts have such lines they are broadcast and no
    text is shuffled.
    """
    held = written(held_lines(docs, host), "lines")
    common = boilerplate(held, min_docs, share).select(F.col("host").alias("_host"), F.col("key").alias("_key"))
    lines = held.select("host", "content", F.explode("keys").alias("key")).join(common, F.expr("key = _key AND host <=> _host"))
    gone = lines.groupBy(F.col("host").alias("_llm_host"), F.col("content").alias("_llm_content")).agg(F.collect_set("key").alias("_llm_gone"))
    same = F.col(host).cast("string").eqNullSafe(F.col("_llm_host")) & (F.unhex(F.md5(whole_text())) == F.col("_llm_content"))
    return docs.join(written(gone, "gone"), same, "left").drop("_llm_host", "_llm_content")


def without_boilerplate(docs: DataFrame, host: str = "source", min_docs: int = MIN_DOCS, share: float = SHARE) -> DataFrame:
    """``docs`` with the boilerplate lines of each row's host cut out of ``text``, all other columns as they are."""
    at, schema = docs.columns.index("text"), T.StructType(docs.schema.fields)
    names = [f.name for f in schema]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            gone = batch.column(batch.num_columns - 1).to_pylist()
            columns = list(batch.columns[:-1])
            texts = [text and cut(text, keys) for text, keys in zip(columns[at].to_pylist(), gone, strict=True)]
            columns[at] = pa.array(texts, columns[at].type)
            yield pa.record_batch(columns, names=names)

    return with_gone(docs, host, min_docs, share).mapInArrow(run, schema)


def figures(docs: DataFrame, host: str = "source") -> DataFrame:
    """The figures of every row's text; its host and a digest of it (``content``); the ``keys`` of its distinct lines that
    have words, and how many ``words`` it holds in lines of each key."""
    symbols, blanks = SYMBOLS.encode(), SPACES.encode()
    kinds = [pa.int64()] * 6 + [pa.string(), pa.binary(), pa.list_(pa.binary()), pa.list_(pa.int32())]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            out: list[list] = [[] for _ in kinds]
            for doc, text, at in zip(*(c.to_pylist() for c in batch.columns), strict=True):
                data = text.encode()
                words = data.split()
                spaces = len(data) - len(data.translate(None, blanks))
                raw = Counter(x for x in data.split(b"\n") if x.strip(blanks))
                held: Counter[bytes] = Counter()
                for line, n in raw.items():
                    held[line_key(line)] += n * len(line.split())
                values = (
                    doc, len(words), len(text) - spaces, len(data) - len(data.translate(None, symbols)), raw.total() - len(raw),
                    repeated_words(words), at, hashlib.md5(data, usedforsecurity=False).digest(), list(held), list(held.values()),
                )
                for column, value in zip(out, values, strict=True):
                    column.append(value)
            yield pa.record_batch([pa.array(c, k) for c, k in zip(out, kinds, strict=True)], names=[c.split()[0] for c in _FIGURES.split(", ")])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), whole_text().alias("text"), F.col(host).cast("string").alias("host"))
    return rows.mapInArrow(run, _FIGURES)


def lost_words(judged: DataFrame, min_docs: int, share: float) -> DataFrame:
    """``_host, _content, n_lost``: the words of each text that lie in boilerplate lines of its host; copies once."""
    common = boilerplate(judged, min_docs, share).select(F.col("host").alias("_common"), F.col("key").alias("_key"))
    once = judged.groupBy("host", "content").agg(F.first(F.arrays_zip("keys", "words")).alias("lines"))
    lines = once.select("host", "content", F.inline("lines")).join(common, F.expr("keys = _key AND host <=> _common"))
    return lines.groupBy(F.col("host").alias("_host"), F.col("content").alias("_content")).agg(F.sum("words").alias("n_lost"))


def judge(
    docs: DataFrame, host: str = "source", min_docs: int = MIN_DOCS, share: float = SHARE,
    least_words: int = LEAST_WORDS, least_share: float = LEAST_SHARE,
) -> DataFrame:
    """The figures, ``base_failed``, ``n_boilerplate_words`` and ``kept`` of every row."""
    judged = written(figures(docs, host), "figures")
    same = F.expr("host <=> _host AND content = _content")
    rows = judged.drop("keys", "words").join(written(lost_words(judged, min_docs, share), "lost"), same, "left")
    lost = F.coalesce("n_lost", F.lit(0).cast("long"))
    left = F.col("n_words") - lost
    failed = (F.col("n_words") < MIN_WORDS) | (F.col("n_repeat_words") > MAX_REPEATED * F.col("n_words"))
    depleted = (left < least_words) | (left < least_share * F.col("n_words"))
    return rows.select(
        "doc_id", "n_words", "word_chars", "n_symbols", "n_dup_lines", "n_repeat_words", failed.alias("base_failed"),
        (~failed & ~depleted).alias("kept"), lost.alias("n_boilerplate_words"),
    )
