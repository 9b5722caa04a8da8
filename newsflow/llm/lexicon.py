"""Encoding and decoding with a minimal acyclic transducer of frequent words.

Spark counts the words of the whole corpus. The most frequent ones (at most ``size``, which bounds
what the driver receives) become a minimal automaton whose arcs carry numbers: the numbers along a
word's path add up to its place in the table of ids, so words share suffixes and keep their own
outputs. Executors fetch the file once and map it into memory, so the workers of a machine share its
pages. Words that the automaton does not hold are merged exactly.

Defined results: a null or empty text has no ids and decodes to an empty text; repeated rows are
encoded each; an empty table gives an empty lexicon, with which every word is merged.
"""

from __future__ import annotations

import json
import os
import tempfile
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import SparkFiles
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.bpe import KEPT, LONG, Codec, byte_chars, large, read_spec, sliced
from newsflow.llm.common import most_counted, texts

SIZE = 1 << 17  # words in the automaton


class Transducer:
    """Arrays of the automaton. ``keys`` (state * 256 + byte) are sorted; states follow their targets."""

    NAMES = ("keys", "targets", "numbers", "final", "ends", "ids")

    def __init__(self, arrays: dict[str, np.ndarray], root: int) -> None:
        self.root = root
        self.__dict__ |= arrays

    @classmethod
    def build(cls, words: list[bytes], ids: list[bytes]) -> Transducer:
        """From distinct words in byte order and their ids; equal subtrees are registered once."""
        register: dict[tuple, int] = {}
        states: list[tuple] = []
        path: list[list] = [[False, []]]
        before = b""

        def freeze(depth: int) -> int:
            state = -1
            while len(path) > depth:
                final, arcs = path.pop()
                made = (final, tuple(arcs))
                state = register.setdefault(made, len(states))
                if state == len(states):
                    states.append(made)
                if path:
                    path[-1][1].append((before[len(path) - 1], state))
            return state

        for word in words:
            common = len(os.path.commonprefix([before, word]))
            freeze(common + 1)
            path.extend([False, []] for _ in word[common:])
            path[-1][0] = True
            before = word
        root = freeze(0)
        below: list[int] = []  # words from each state on
        keys, targets, numbers = [], [], []
        for state, (final, arcs) in enumerate(states):
            n = int(final)
            for byte, target in arcs:
                keys.append(state << 8 | byte)
                targets.append(target)
                numbers.append(n)
                n += below[target]
            below.append(n)
        arrays = {
            "keys": np.array([*keys, 1 << 62], "<i8"), "targets": np.array([*targets, 0], "<i8"),
            "numbers": np.array([*numbers, 0], "<i8"), "final": np.array([f for f, _ in states], "<i8"),
            "ends": np.cumsum([0, *(len(x) // 4 for x in ids)]).astype("<i8"),
            "ids": np.frombuffer(b"".join(ids), "<u4").astype("<i8"),
        }
        return cls(arrays, root)

    def save(self, path: str) -> None:
        arrays = [getattr(self, n) for n in self.NAMES]
        head = json.dumps({"root": self.root, "sizes": [len(a) for a in arrays]}).encode()
        with open(path, "wb") as file:
            file.write(head.ljust(512))
            for a in arrays:
                file.write(a.tobytes())

    @classmethod
    def open(cls, path: str) -> Transducer:
        """Maps the file; only the pages that words touch are read."""
        with open(path, "rb") as file:
            head = json.loads(file.read(512))
        data = np.memmap(path, "<i8", "r", 512) if sum(head["sizes"]) else np.empty(0, "<i8")
        cuts = np.cumsum(head["sizes"])
        return cls(dict(zip(cls.NAMES, np.split(data, cuts[:-1]), strict=True)), head["root"])

    def find(self, words: list[bytes]) -> np.ndarray:
        """Each word's number, or -1. All words walk at once, one byte a step."""
        sizes = np.fromiter(map(len, words), np.int64, len(words))
        raw = np.frombuffer(b"".join(words), np.uint8).astype(np.int64)
        starts = np.cumsum(sizes) - sizes
        out = np.full(len(words), -1)
        at = np.arange(len(words))
        state, number, step = np.full(len(words), self.root), np.zeros(len(words), np.int64), 0
        while len(at):
            ended = sizes[at] == step
            stop = ended & (self.final[state] == 1)
            out[at[stop]] = number[stop]
            at, state, number = at[~ended], state[~ended], number[~ended]
            key = state << 8 | raw[starts[at] + step]
            arc = np.searchsorted(self.keys, key)
            known = self.keys[arc] == key
            at, arc = at[known], arc[known]
            state, number, step = self.targets[arc], number[known] + self.numbers[arc], step + 1
        return out


class LexiconCodec(Codec):
    """Words by the transducer where it holds them, by exact merging else."""

    def __init__(self, spec: str, transducer: Transducer, kept: int = KEPT) -> None:
        super().__init__(spec, kept)
        self.transducer = transducer

    def encode_words(self, words: list[str]) -> list[bytes]:
        raw = [w.encode() for w in words]
        t, found = self.transducer, self.transducer.find(raw)
        data = t.ids.astype("<u4").tobytes()
        ends = (t.ends * 4).tolist()
        out = [data[ends[i] : ends[i + 1]] if i >= 0 else b"" for i in found.tolist()]
        missing = np.flatnonzero(found < 0).tolist()
        for i, ids in zip(missing, self.merges.encode([raw[i] for i in missing]), strict=True):
            out[i] = ids
        return out


class Decoder:
    """Texts of ids, special tokens included; bytes that are no UTF-8 become U+FFFD."""

    def __init__(self, spec: str) -> None:
        content = json.loads(spec)
        byte_of = {c: b for b, c in enumerate(byte_chars())}
        pieces = {i: bytes(map(byte_of.__getitem__, token)) for token, i in content["model"]["vocab"].items()}
        pieces |= {t["id"]: t["content"].encode() for t in content["added_tokens"]}
        self.pieces = pa.array([pieces.get(i) for i in range(max(pieces) + 1)], pa.large_binary())

    def decode(self, ids: list[bytes]) -> list[str]:
        """The text of each of some rows of ids."""
        ends = np.cumsum([0, *map(len, ids)]) // 4
        joined = pa.array(np.frombuffer(b"".join(ids), "<u4"))
        return [text.decode("utf-8", "replace") for text in sliced(self.pieces, joined, ends)]


def word_counts(words: list[str], times: np.ndarray) -> pa.Table:
    """``word, n`` from the words of pieces, a zero byte between two pieces, and how often each piece occurs."""
    coded = pa.array(words, pa.string()).dictionary_encode()
    at = coded.indices.to_numpy()
    between = at == coded.dictionary.index("\x00").as_py()
    n = np.zeros(len(coded.dictionary), np.int64)
    np.add.at(n, at[~between], times[np.cumsum(between)[~between]])
    return pa.table({"word": coded.dictionary, "n": n}).filter(n > 0)


def count_words(docs: DataFrame, tokenizer: str, held: int = 150_000) -> DataFrame:
    """``word, n`` over whole texts. Each task cuts only a batch's distinct pieces into words, and adds up the words of
    some batches, until it holds more than ``held``, before Spark does."""
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(spec.value)
        counted: list[pa.Table] = []

        def flush() -> Iterator[pa.RecordBatch]:
            if counted:
                added = pa.concat_tables(counted).group_by("word").aggregate([("n", "sum")])
                yield from added.select(["word", "n_sum"]).rename_columns(["word", "n"]).to_batches()
                counted.clear()

        for batch in batches:
            for _, pieces, _ in codec.pieces(large(batch.column(0))):
                counts = pieces.value_counts()
                found = counts.field("values").to_numpy(zero_copy_only=False).tolist()
                times = counts.field("counts").to_numpy()
                if not codec.plain("".join(found)):
                    plain = np.fromiter(map(codec.plain, found), bool, len(found))
                    found, times = [p for p, is_plain in zip(found, plain, strict=True) if is_plain], times[plain]
                counted.append(word_counts(codec.words(found), times))
            if sum(map(len, counted)) > held:
                yield from flush()
        yield from flush()

    counted = texts(docs).select("text").mapInArrow(run, "word string, n long")
    return counted.groupBy("word").agg(F.sum("n").alias("n"))


def build(docs: DataFrame, tokenizer: str, size: int = SIZE) -> str:
    """Compiles the ``size`` most frequent words; gives the name of the file that executors fetch."""
    top = most_counted(count_words(docs, tokenizer).where("word <> ''"), size)
    words = sorted(row.word.encode() for row in top.select("word").toLocalIterator() if len(row.word) <= LONG)
    ids = Codec(read_spec(tokenizer)).merges.encode(words)
    name = f"lexicon-{uuid.uuid4().hex}"
    path = os.path.join(tempfile.mkdtemp(), name)
    Transducer.build(words, ids).save(path)
    docs.sparkSession.sparkContext.addFile(path)
    return name


def encode(docs: DataFrame, tokenizer: str, lexicon: str) -> DataFrame:
    """``doc_id, ids``: the ids of the whole text as little-endian unsigned 32-bit integers."""
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = LexiconCodec(spec.value, Transducer.open(SparkFiles.get(lexicon)))
        for batch in batches:
            ids = codec.encode(batch.column(1))
            yield pa.record_batch([batch.column(0), pa.array(ids, pa.binary())], names=["doc_id", "ids"])

    return texts(docs).mapInArrow(run, "doc_id long, ids binary")


def decode(encoded: DataFrame, tokenizer: str) -> DataFrame:
    """``doc_id, ids, text`` of encoded rows."""
    spec = encoded.sparkSession.sparkContext.broadcast(read_spec(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        decoder = Decoder(spec.value)
        for batch in batches:
            out = decoder.decode(batch.column(1).to_pylist())
            yield pa.record_batch([batch.column(0), batch.column(1), pa.array(out, pa.string())], names=["doc_id", "ids", "text"])

    return encoded.select("doc_id", "ids").mapInArrow(run, "doc_id long, ids binary, text string")


def round_trip(docs: DataFrame, tokenizer: str, lexicon: str) -> DataFrame:
    """``encode`` and ``decode`` in one pass: ``doc_id, ids, text``, the text from the ids alone."""
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(tokenizer))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, decoder = LexiconCodec(spec.value, Transducer.open(SparkFiles.get(lexicon))), Decoder(spec.value)
        for batch in batches:
            ids = codec.encode(batch.column(1))
            out = decoder.decode(ids)
            yield pa.record_batch([batch.column(0), pa.array(ids, pa.binary()), pa.array(out, pa.string())], names=["doc_id", "ids", "text"])

    return texts(docs).mapInArrow(run, "doc_id long, ids binary, text string")


def digests(decoded: DataFrame) -> DataFrame:
    return decoded.select(
        "doc_id", (F.octet_length("ids") / 4).cast("long").alias("n_tokens"),
        F.sha2("ids", 256).alias("ids_sha256"), F.sha2("text", 256).alias("decoded_sha256"),
    )
