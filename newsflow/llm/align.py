"""Alignment of two tokenizers' tokens over the same bytes.

Each text is encoded by both tokenizers. Within a batch, ``merge_asof`` by document finds for each token's
start the other side's token that covers it; both directions together give every overlapping pair. Offsets
where tokens of both sides end cut the text into groups, and the pairs that end there are the links. How
often two ids are linked is counted over the corpus.

Two tokens that end together agree in the bytes they share, so one's bytes end with the other's. The two
vocabularies therefore fix all pairs of ids that can ever be linked, a few hundred thousand, however large the
corpus is. Links are kept as the numbers of such pairs, and the table of their counts is broadcast.

Defined results: texts that are null or empty, or that a tokenizer does not give back byte by byte, have no
tokens; rows that repeat a ``doc_id`` count each; an empty table gives no rows. Long texts are aligned in
pieces between offsets where both sides end.
"""

from __future__ import annotations

import hashlib
import json
import re
from collections.abc import Iterator
from functools import cached_property

import numpy as np
import pandas as pd
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.bpe import Codec, byte_chars, read_spec
from newsflow.llm.common import texts
from newsflow.session import written

SPACE_MARK = "▁"  # stands for a space in pieces
WINDOW = 200_000  # tokens of one side that are aligned at once
KEPT = 300_000  # distinct words that a task remembers

ALIGNED = "doc_id long, n_a long, n_b long, n_groups long, groups_sha256 string, links binary"


class PlainCodec(Codec):
    """As ``Codec``; the strings of special tokens are plain text."""

    @property
    def library(self):
        found = super().library
        found.encode_special_tokens = True
        return found


class PieceCodec:
    """Encodes whole texts by a sentencepiece model, remembering words.

    No piece of such a model holds a space mark after another character, so words with the spaces before
    them encode apart from each other. A model with other pieces is given whole texts.
    """

    def __init__(self, model: bytes, kept: int = KEPT) -> None:
        import sentencepiece

        self.pieces = sentencepiece.SentencePieceProcessor(model_proto=model)
        names = [self.pieces.id_to_piece(i) for i in range(self.pieces.get_piece_size())]
        self.by_words = not any(SPACE_MARK in n.lstrip(SPACE_MARK) for n in names)
        self.kept = kept
        self.known: dict[str, bytes] = {}

    def vocabulary(self) -> list[bytes]:
        out = []
        for i in range(self.pieces.get_piece_size()):
            name = self.pieces.id_to_piece(i)
            out.append(bytes([int(name[3:5], 16)]) if self.pieces.is_byte(i) else name.replace(SPACE_MARK, " ").encode())
        return out

    def encode(self, texts: list[str]) -> list[bytes]:
        """The ids of each non-empty text as little-endian unsigned 32-bit integers."""
        split = [self._words(t) for t in texts]
        if len(self.known) > self.kept:
            self.known.clear()
        if new := list(set().union(*split).difference(self.known)):
            for word, ids in zip(new, self.pieces.encode(new, num_threads=1), strict=True):
                self.known[word] = np.array(ids if word else [self.pieces.piece_to_id(SPACE_MARK)], "<u4").tobytes()
        return [b"".join(map(self.known.__getitem__, words)) for words in split]

    def _words(self, text: str) -> list[str]:
        """Words of the text with all but one of the spaces before them, which the model adds again; a last
        single space leaves an empty word."""
        if not self.by_words:
            return [text]
        if "  " not in text and text[:1] != " " and text[-1:] != " ":
            return text.split(" ")
        return [run[1:] for run in re.findall(" +[^ ]*", " " + text)]


class Vocabularies:
    """The bytes of both sides' tokens, and every pair of ids that can end together."""

    def __init__(self, spec: str, model: bytes) -> None:
        self.spec, self.model = spec, model

    @cached_property
    def a_bytes(self) -> list[bytes]:
        parsed = json.loads(self.spec)
        byte_of = {c: i for i, c in enumerate(byte_chars())}
        vocab: dict[str, int] = parsed["model"]["vocab"]
        out = [b""] * (1 + max([*vocab.values(), *[t["id"] for t in parsed["added_tokens"]]]))
        for name, i in vocab.items():
            out[i] = bytes(byte_of[c] for c in name) if all(c in byte_of for c in name) else name.encode()
        return out

    @cached_property
    def b_bytes(self) -> list[bytes]:
        return PieceCodec(self.model).vocabulary()

    @cached_property
    def pairs(self) -> np.ndarray:
        """``a << 32 | b`` of all pairs whose bytes end alike, ascending."""
        out: set[int] = set()
        for mine, other, key in ((self.a_bytes, self.b_bytes, lambda i, j: i << 32 | j), (self.b_bytes, self.a_bytes, lambda i, j: j << 32 | i)):
            ids: dict[bytes, list[int]] = {}
            for j, data in enumerate(other):
                if data:
                    ids.setdefault(data, []).append(j)
            for i, data in enumerate(mine):
                for start in range(len(data)):
                    out.update(key(i, j) for j in ids.get(data[start:], ()))
        return np.array(sorted(out), np.int64)


def vocabularies(tokenizer: str, model: str) -> Vocabularies:
    """Side A is a byte-level ``tokenizers`` file, side B a sentencepiece model."""
    with open(model, "rb") as file:
        return Vocabularies(read_spec(tokenizer), file.read())


def overlaps(a: pd.DataFrame, b: pd.DataFrame) -> pd.DataFrame:
    """``a, b``: the positions in ``a`` and ``b`` of every two tokens that share bytes, ascending.

    Both hold ``doc, start`` of each token, ascending by both; ``start`` counts on from document to document.
    Each side's tokens follow each other without gaps.
    """
    left = pd.DataFrame({"doc": a.doc, "start": a.start, "a": np.arange(len(a))})
    right = pd.DataFrame({"doc": b.doc, "start": b.start, "b": np.arange(len(b))})
    covered = pd.merge_asof(left, right, on="start", by="doc")
    covering = pd.merge_asof(right, left.assign(found=left.start), on="start", by="doc")
    covering = covering[covering.start.to_numpy() != covering.found.to_numpy()]  # those of equal starts are there already
    met = np.concatenate([covered.a.to_numpy() * len(b) + covered.b.to_numpy(), covering.a.to_numpy() * len(b) + covering.b.to_numpy()])
    met.sort(kind="stable")
    return pd.DataFrame({"a": met // max(len(b), 1), "b": met % max(len(b), 1)})


class Vocabulary:
    """Tokens' bytes side by side, to join many at once."""

    def __init__(self, names: list[bytes]) -> None:
        self.sizes = np.array(list(map(len, names)), np.int64)
        self.flat, self.starts = np.frombuffer(b"".join(names), np.uint8), np.cumsum(self.sizes) - self.sizes

    def spells(self, ids: np.ndarray, text: bytes) -> bool:
        """Whether the tokens' bytes, joined, are ``text``."""
        sizes = self.sizes[ids]
        if sizes.sum() != len(text):
            return False
        at = np.repeat(self.starts[ids] - np.cumsum(sizes) + sizes, sizes) + np.arange(len(text))
        return bool((self.flat[at] == np.frombuffer(text, np.uint8)).all())


class Aligner:
    """Aligns the texts of a task."""

    def __init__(self, vocab: Vocabularies, pairs: np.ndarray) -> None:
        self.a, self.b, self.pairs = PlainCodec(vocab.spec), PieceCodec(vocab.model), pairs
        self.of_a, self.of_b = Vocabulary(vocab.a_bytes), Vocabulary(vocab.b_bytes)
        # an id in decimal with what may follow it: a token of its group and side, the other side, the next group
        most = max(len(self.of_a.sizes), len(self.of_b.sizes))
        self.shown = [np.array([f"{i}{end}" for i in range(most)], object) for end in (",", "|", ";")]

    def align(self, texts: list[str]) -> list[tuple[int, int, int, str, bytes]]:
        """``n_a, n_b, n_groups, groups_sha256, links`` of each text."""
        out: list[tuple[int, int, int, str, bytes]] = [(0, 0, 0, "", b"")] * len(texts)
        full = [i for i, t in enumerate(texts) if t]
        coded_a, coded_b = self.a.encode([" " + texts[i] for i in full]), self.b.encode([texts[i] for i in full])
        held: list[tuple[int, np.ndarray, np.ndarray]] = []
        tokens = 0
        for i, a, b in zip(full, coded_a, coded_b, strict=True):
            a, b = np.frombuffer(a, "<u4"), np.frombuffer(b, "<u4")
            whole = (" " + texts[i]).encode()
            if not (self.of_a.spells(a, whole) and self.of_b.spells(b, whole)):
                continue
            if len(a) > WINDOW:
                out[i] = self._long(a, b)
                continue
            held.append((i, a, b))
            tokens += len(a)
            if tokens > WINDOW:
                self._batch(held, out)
                held, tokens = [], 0
        if held:
            self._batch(held, out)
        return out

    def _batch(self, held: list[tuple[int, np.ndarray, np.ndarray]], out: list) -> None:
        for (i, a, b), (shown, links) in zip(held, self._groups([(a, b) for _, a, b in held]), strict=True):
            out[i] = (len(a), len(b), len(links) // 4, hashlib.sha256(shown[:-1].encode()).hexdigest(), links)

    def _long(self, a: np.ndarray, b: np.ndarray) -> tuple[int, int, int, str, bytes]:
        """One long text in windows; each ends where tokens of both sides end."""
        ends_a, ends_b = np.cumsum(self.of_a.sizes[a]), np.cumsum(self.of_b.sizes[b])
        digest, links, at_a, at_b, tail = hashlib.sha256(), [], 0, 0, ""
        while at_a < len(a):
            size = WINDOW
            while True:
                stop_a = min(at_a + size, len(a))
                shared = np.flatnonzero(np.isin(ends_a[at_a:stop_a], ends_b[at_b:]))
                if len(shared) or stop_a == len(a):
                    break
                size *= 2
            stop_a = at_a + int(shared[-1]) + 1
            stop_b = int(np.searchsorted(ends_b, ends_a[stop_a - 1])) + 1
            ((shown, found),) = self._groups([(a[at_a:stop_a], b[at_b:stop_b])])
            digest.update((tail + shown[:-1]).encode())
            links.append(found)
            at_a, at_b, tail = stop_a, stop_b, shown[-1:]
        joined = b"".join(links)
        return len(a), len(b), len(joined) // 4, digest.hexdigest(), joined

    @staticmethod
    def _tokens(ids: list[np.ndarray], sizes: np.ndarray) -> pd.DataFrame:
        joined = np.concatenate(ids).astype(np.int64)
        ends = np.cumsum(sizes[joined])
        return pd.DataFrame({"doc": np.repeat(np.arange(len(ids)), list(map(len, ids))), "id": joined, "start": ends - sizes[joined], "end": ends})

    def _groups(self, texts: list[tuple[np.ndarray, np.ndarray]]) -> list[tuple[str, bytes]]:
        """The groups of each text as ``a1,a2|b1;a3|b2,b3;`` and its links as numbers of pairs, 32 bits each."""
        a, b = self._tokens([t[0] for t in texts], self.of_a.sizes), self._tokens([t[1] for t in texts], self.of_b.sizes)
        id_a, id_b = a.id.to_numpy(), b.id.to_numpy()
        met = overlaps(a, b)
        ends = a.end.to_numpy()[met.a] == b.end.to_numpy()[met.b]
        last_a, last_b = met.a.to_numpy()[ends], met.b.to_numpy()[ends]  # tokens that end a group
        codes = np.searchsorted(self.pairs, id_a[last_a] << 32 | id_b[last_b]).astype("<u4")
        # where each token stands when groups follow each other, side A of a group before side B
        ends_a, ends_b = np.zeros(len(a), np.int64), np.zeros(len(b), np.int64)
        ends_a[last_a], ends_b[last_b] = 1, 1
        before_b, until_a = np.append(0, last_b + 1), last_a + 1
        place_a = np.arange(len(a)) + before_b[np.cumsum(ends_a) - ends_a]
        place_b = np.arange(len(b)) + until_a[np.cumsum(ends_b) - ends_b]
        more, other, done = self.shown
        shown = np.empty(len(a) + len(b), object)
        shown[place_a], shown[place_b] = more[id_a], more[id_b]
        shown[place_a[last_a]], shown[place_b[last_b]] = other[id_a[last_a]], done[id_b[last_b]]
        # the parts of each text
        of_a, of_b = ([0, *np.cumsum([len(t[side]) for t in texts]).tolist()] for side in (0, 1))
        at_link = np.searchsorted(last_a, of_a)
        flat = shown.tolist()
        return [
            ("".join(flat[of_a[i] + of_b[i] : of_a[i + 1] + of_b[i + 1]]), codes[at_link[i] : at_link[i + 1]].tobytes())
            for i in range(len(texts))
        ]


def align(docs: DataFrame, vocab: Vocabularies) -> DataFrame:
    """``doc_id, n_a, n_b, n_groups, groups_sha256, links`` of each whole text.

    ``links`` holds the numbers of the linked pairs in order, as little-endian unsigned 32-bit integers.
    """
    shared = docs.sparkSession.sparkContext.broadcast((vocab.spec, vocab.model, vocab.pairs))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        spec, model, pairs = shared.value
        aligner = Aligner(Vocabularies(spec, model), pairs)
        for batch in batches:
            for at in range(0, batch.num_rows, 128):
                part = batch.slice(at, 128)
                columns = list(zip(*aligner.align(part.column(1).to_pylist()), strict=True))
                kinds = (pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.binary())
                made = [pa.array(c, k) for c, k in zip(columns, kinds, strict=True)]
                yield pa.record_batch([part.column(0), *made], names=[c.split()[0] for c in ALIGNED.split(", ")])

    return texts(docs).mapInArrow(run, ALIGNED)


def pair_counts(aligned: DataFrame, vocab: Vocabularies) -> DataFrame:
    """``pair, n``: how many links of the corpus hold each pair; added up in the tasks first."""
    most = len(vocab.pairs)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(most, np.int64)
        for batch in batches:
            codes = np.frombuffer(b"".join(batch.column(0).to_pylist()), "<u4")
            total += np.bincount(codes, minlength=most)
        found = np.flatnonzero(total)
        yield pa.record_batch([pa.array(found), pa.array(total[found])], names=["pair", "n"])

    return aligned.select("links").mapInArrow(run, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))


def id_pairs(counts: DataFrame, vocab: Vocabularies) -> DataFrame:
    """``a, b, n`` of the linked ids."""
    spark = counts.sparkSession
    table = pa.table({"pair": np.arange(len(vocab.pairs)), "a": vocab.pairs >> 32, "b": vocab.pairs & 0xFFFFFFFF})
    return counts.join(spark.createDataFrame(table), "pair").select("a", "b", "n")


def rate(aligned: DataFrame, counts: DataFrame, vocab: Vocabularies) -> DataFrame:
    """``n_links, n_best, count_sum`` beside the aligned documents, in place of their links.

    ``n_best`` counts links whose pair no other pair of the same B id exceeds, ``count_sum`` adds up the
    counts of all links. The counts are a row per pair that the vocabularies allow, so they are broadcast.
    """
    total = np.zeros(len(vocab.pairs), np.int64)
    found = counts.toArrow()
    total[found.column("pair").to_numpy()] = found.column("n").to_numpy()
    of_b = vocab.pairs & 0xFFFFFFFF
    highest = np.zeros(int(of_b.max(initial=0)) + 1, np.int64)
    np.maximum.at(highest, of_b, total)
    shared = aligned.sparkSession.sparkContext.broadcast((total, total == highest[of_b]))
    names = ["doc_id", "n_a", "n_b", "n_groups", "n_links", "n_best", "count_sum", "groups_sha256"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        count, best = shared.value
        for batch in batches:
            doc, n_a, n_b, n_groups, sha, links = batch.columns
            rows = []
            for data in links.to_pylist():
                codes = np.frombuffer(data, "<u4")
                rows.append((len(codes), int(best[codes].sum()), int(count[codes].sum())))
            rated = [pa.array([r[i] for r in rows], pa.int64()) for i in range(3)]
            yield pa.record_batch([doc, n_a, n_b, n_groups, *rated, sha], names=names)

    return aligned.mapInArrow(run, ", ".join(f"{n} {'string' if n == 'groups_sha256' else 'long'}" for n in names))


def alignment(docs: DataFrame, vocab: Vocabularies) -> DataFrame:
    """Alignment and rated links of every document; texts are encoded once."""
    aligned = written(align(docs, vocab), "aligned")
    return rate(aligned, written(pair_counts(aligned, vocab), "pairs"), vocab)
