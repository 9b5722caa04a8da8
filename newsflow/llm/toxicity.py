"""Toxicity by multiple-instance learning.

Only documents carry labels; sentences are the instances. A sentence's score is a logistic function of
its distinct words and their first letters (hashed), and a document is toxic if at least one of its
sentences is: ``1 - prod(1 - score)``. Weights are trained through that noisy-or from document labels
by Adagrad with an L1 penalty, in one task, on at most ``sample`` labelled documents (those with the
smallest hash of their id, so the same ones on every run). That task is handed the texts in order and
keeps of them only the numbers of each sentence's words. Scoring reads every whole text where it is
stored. The sentences that carry a document over the threshold are located by their offsets.

Defined results: a null or empty text is one sentence without words; a label that is null, or whose
document is absent, teaches nothing; a document with several labels is toxic if one says so; without
any label all documents get the same small score; repeated rows are scored each; an empty table gives
no rows.
"""

from __future__ import annotations

import re
import zlib
from array import array
from collections.abc import Iterable, Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.common import texts

BITS = 18
SAMPLE = 8_000  # labelled documents that train the model
THRESHOLD = 0.3
LEAST_DOCS = 5  # documents of the sample that must hold a feature
LEAST_WORDS = 5  # shorter sentences join the next one
STEMS = (4, 5, 6)
PRIOR = -6.0
KEPT = 100_000  # chunks that training remembers
SLICE = 256  # texts that are cut at once

_STRIP = ".,;:!?…\"'()[]{}|%&$#*<>«»“”„"
_ENDS = frozenset(".!?…\x00")


@dataclass(frozen=True)
class Model:
    weights: np.ndarray  # one per hashed feature
    bias: float


class Words(dict):
    """Numbers the words of chunks between white space: ``2 * word + 1`` if the chunk ends a sentence.

    Word 0 is no word. ``clear`` forgets the chunks, but not the words' numbers.
    """

    def __init__(self) -> None:
        self.numbers: dict[str, int] = {"": 0}
        self._hashed, self._sizes = array("i"), array("b", [0])  # the hashed features of the latest words, and how many each has

    def __missing__(self, chunk: str) -> int:
        word = chunk.strip(_STRIP + "\x00").lower()
        number = self.numbers.setdefault(word, new := len(self.numbers))
        if number == new:
            hashed = [zlib.crc32(word.encode())] + [zlib.crc32(b"^" + word[:k].encode()) for k in STEMS if len(word) > k]
            self._hashed.extend([h & (1 << BITS) - 1 for h in hashed])
            self._sizes.append(len(hashed))
        self[chunk] = code = 2 * number + (chunk[-1] in _ENDS)
        return code

    def features(self) -> tuple[np.ndarray, np.ndarray]:
        """Hashed features of the words numbered since the last call, and the place of each one's word among these."""
        sizes, hashed = np.array(self._sizes, np.int64), np.array(self._hashed, np.int64)
        self._hashed, self._sizes = array("i"), array("b")
        return hashed, np.repeat(np.arange(len(sizes)), sizes)


def bags(words: Words, found: list[str], first: int = 0) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Distinct ``(word, sentence)`` pairs, and the document of each sentence (from 0 on)."""
    codes, sentence_of, docs, sentence = [], [], [], first
    for doc, text in enumerate(found):
        own = np.fromiter(map(words.__getitem__, text.replace("\n", " \x00 ").split()), np.int64)
        ends, last = [], 0
        for end in (np.flatnonzero(own & 1) + 1).tolist():
            if end - last >= LEAST_WORDS:
                ends.append(end)
                last = end
        if not ends or last < len(own):
            ends.append(len(own))
        codes.append(own >> 1)
        sentence_of.append(np.repeat(np.arange(sentence, sentence + len(ends)), np.diff([0, *ends])))
        docs.append(np.full(len(ends), doc))
        sentence += len(ends)
    if not found:
        return np.empty(0, np.int64), np.empty(0, np.int64), np.empty(0, np.int64)
    key = np.concatenate(sentence_of) << 32 | np.concatenate(codes)
    key = np.unique(key[key & 0xFFFFFFFF > 0])
    return key & 0xFFFFFFFF, key >> 32, np.concatenate(docs)


def fit(found: list[str], labels: list[int], steps: int = 200, rate: float = 0.3, l1: float = 1e-4) -> Model:
    """Trains on whole texts and their labels."""
    return fit_slices(((found[at : at + SLICE], labels[at : at + SLICE]) for at in range(0, len(found), SLICE)), steps, rate, l1)


def fit_slices(slices: Iterable[tuple[list[str], list[int]]], steps: int = 200, rate: float = 0.3, l1: float = 1e-4) -> Model:
    """Trains on whole texts and their labels, given some at a time; keeps the numbers of their words only."""
    words, parts, doc, y = Words(), [], [np.empty(0, np.int64)], []
    holders, first = np.zeros(1, np.int64), 0  # documents with each word; sentences before the slice
    for found, labels in slices:
        word, sentence, own = bags(words, found)
        pairs = np.unique(word << 32 | own[sentence])
        seen = np.bincount(pairs >> 32, minlength=len(holders))
        seen[: len(holders)] += holders
        holders = seen
        parts.append((first, first + len(own), word.astype(np.int32), sentence.astype(np.int32)))
        doc.append(own + len(y))
        first += len(own)
        y += labels
        if len(words) > KEPT:
            words.clear()
    features, owner = words.features()
    words = None
    doc, y, n = np.concatenate(doc), np.array(y, float), len(y)
    weights, bias = np.zeros(1 << BITS), PRIOR
    if not 0 < y.sum() < n:
        return Model(weights.astype(np.float32), bias)
    common = np.bincount(features, holders[owner], 1 << BITS) >= LEAST_DOCS
    features, owner = features[common[features]], owner[common[features]]
    used = np.zeros(len(holders), bool)
    used[owner] = True
    parts = [(start, end, word[used[word]], sentence[used[word]]) for start, end, word, sentence in parts]
    z, size = np.zeros(len(doc)), np.full(1 << BITS, 1e-8)
    bias_size = 1e-8
    for _ in range(steps):
        value = np.bincount(owner, weights[features], len(holders))
        for start, end, word, sentence in parts:
            z[start:end] = bias + np.bincount(sentence, value[word], end - start)
        total = np.bincount(doc, np.logaddexp(0, z), n)  # -log of the chance that no sentence is toxic
        slope = np.where(y > 0, -np.exp(-total) / np.maximum(-np.expm1(-total), 1e-9), 1.0) / n
        pull = slope[doc] / (1 + np.exp(-z))
        pulled = np.zeros(len(holders))
        for start, end, word, sentence in parts:
            np.add.at(pulled, word.astype(np.intp), pull[start:end][sentence])
        grad = np.bincount(features, pulled[owner], 1 << BITS)
        size += grad * grad
        bias_size += pull.sum() ** 2
        step = rate / np.sqrt(size)
        weights -= step * grad
        weights = np.sign(weights) * np.maximum(np.abs(weights) - step * l1, 0)
        bias -= rate * pull.sum() / np.sqrt(bias_size)
    return Model(weights.astype(np.float32), float(bias))


def train(docs: DataFrame, labels: DataFrame, sample: int = SAMPLE) -> Model:
    """Fits on at most ``sample`` of the labelled documents; ``labels`` has ``doc_id, toxic``."""
    known = labels.where("doc_id IS NOT NULL AND toxic IS NOT NULL").groupBy("doc_id").agg(F.max("toxic").alias("_toxic"))
    known = known.select(F.col("doc_id").cast("long").alias("_doc"), F.col("_toxic").cast("int"))
    chosen = known.orderBy(F.xxhash64("_doc"), "_doc").limit(sample)  # ids and labels only, bounded by the parameter
    rows = texts(docs).join(F.broadcast(chosen), F.col("doc_id") == F.col("_doc")).select("doc_id", "text", "_toxic")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cut = (batch.slice(at, SLICE) for batch in batches for at in range(0, batch.num_rows, SLICE))
        model = fit_slices((part.column(1).to_pylist(), part.column(2).to_pylist()) for part in cut)
        at = np.flatnonzero(model.weights)
        yield pa.record_batch(
            [pa.array([-1, *at.tolist()], pa.int32()), pa.array([model.bias, *model.weights[at].tolist()], pa.float64())], names=["feature", "weight"]
        )

    ordered = rows.repartition(1).sortWithinPartitions("doc_id", "text")  # Spark sorts, so Python holds a batch of texts at a time
    fitted = ordered.mapInArrow(run, "feature int, weight double").collect()
    weights = np.zeros(1 << BITS, np.float32)
    for row in fitted:
        if row.feature >= 0:
            weights[row.feature] = row.weight
    return Model(weights, next((r.weight for r in fitted if r.feature < 0), PRIOR))


def sentences(text: str) -> list[tuple[int, int]]:
    """Code point offsets of the sentences that ``bags`` makes of ``text``."""
    out, start, last, count = [], None, 0, 0
    for m in re.finditer(r"\n|\S+", text):
        if m[0] != "\n":
            start, last = m.start() if start is None else start, m.end()
        count += 1
        if count >= LEAST_WORDS and (m[0] == "\n" or m[0][-1] in _ENDS):
            out.append((last if start is None else start, last))
            start, count = None, 0
    if count or not out:
        out.append((last if start is None else start, last))
    return out


class Scorer:
    """Scores texts with a model; remembers at most ``kept`` chunks."""

    def __init__(self, model: Model, kept: int = 300_000) -> None:
        self.model, self.kept = model, kept
        self.forget()

    def forget(self) -> None:
        self.words, self.values = Words(), np.zeros(0)

    def logits(self, found: list[str]) -> tuple[np.ndarray, np.ndarray]:
        """Each sentence's logit, and its document."""
        if len(self.words) > self.kept:
            self.forget()
        word, sentence, doc = bags(self.words, found)
        if (new := len(self.words.numbers) - len(self.values)) > 0:
            features, owner = self.words.features()
            self.values = np.append(self.values, np.bincount(owner, self.model.weights[features], new))
        return self.model.bias + np.bincount(sentence, self.values[word], len(doc)), doc

    def score(self, found: list[str]) -> tuple[list[float], list[np.ndarray]]:
        """Each document's score, and the scores of its sentences."""
        z, doc = self.logits(found)
        scores = -np.expm1(-np.bincount(doc, np.logaddexp(0, z), len(found)))
        return scores.tolist(), np.split(1 / (1 + np.exp(-z)), np.flatnonzero(np.diff(doc)) + 1)


def score(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """``doc_id, score, predicted, offending``: spans of sentences that alone reach the threshold, or
    the worst one, for documents that do."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Model(*shared.value))
        for batch in batches:
            found = batch.column(1).to_pylist()
            scores, spans = [], []
            for at in range(0, len(found), SLICE):
                part = found[at : at + SLICE]
                own, each = scorer.score(part)
                scores += own
                for text, s, parts in zip(part, own, each, strict=True):
                    hits = [] if s < threshold else np.flatnonzero(parts >= min(threshold, parts.max())).tolist()
                    where = sentences(text) if hits else []
                    spans.append([{"start": where[i][0], "end": where[i][1], "score": float(parts[i])} for i in hits])
            kind = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("score", pa.float64())]))
            yield pa.record_batch(
                [batch.column(0), pa.array(scores, pa.float64()), pa.array([int(s >= threshold) for s in scores], pa.int32()), pa.array(spans, kind)],
                names=["doc_id", "score", "predicted", "offending"],
            )

    return texts(docs).mapInArrow(run, "doc_id long, score double, predicted int, offending array<struct<start: long, end: long, score: double>>")


def keep_clean(docs: DataFrame, model: Model, threshold: float = THRESHOLD) -> DataFrame:
    """The rows of ``docs``, all columns as they are, whose score stays below the threshold."""
    shared = docs.sparkSession.sparkContext.broadcast((model.weights, model.bias))
    at = docs.columns.index("text")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        scorer = Scorer(Model(*shared.value))
        for batch in batches:
            found = [t or "" for t in batch.column(at).to_pylist()]
            stay = [s < threshold for i in range(0, len(found), SLICE) for s in scorer.score(found[i : i + SLICE])[0]]
            yield batch.filter(pa.array(stay, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)


def held_out() -> F.Column:
    """Whether a document's labels are kept for testing."""
    return F.crc32(F.col("doc_id").cast("string")) % 4 == 2
