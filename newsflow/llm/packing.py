"""Cost-balanced packing of documents into training sequences.

Documents are encoded where they are read, and packed in blocks of about ``block_tokens`` tokens in
the order of the input, so nothing is shuffled and a lost task makes the same pieces again. In a
block, a document's whole sequences are cut off first; what is left of each document is assigned in
descending order of its cost (linear plus quadratic attention cost) to the sequence of lowest cost
that still has room for it. The sequences of a block have exactly the room for its tokens: full ones,
and for the last tokens ones of a power of two, which need no padding. A rest that fits nowhere as a
whole is cut at the sequences with the lowest cost.

Defined results: a null or empty text is the end token alone; ties are broken by the order of input;
repeated rows are packed each; an empty table has no pieces.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.llm.bpe import KEPT, Codec, read_spec
from newsflow.llm.common import texts

CAPACITY = 4096
END_ID = 2
BLOCK_TOKENS = 1 << 20
LINEAR, QUADRATIC = 1.0, 1.0 / 2048  # attention costs as much as the rest at about 2,048 tokens

SCHEMA = "doc_id long, start long, length long, ids binary, doc_tokens long, sequence_id long, offset long"


def cost(length: int, linear: float = LINEAR, quadratic: float = QUADRATIC) -> float:
    """Estimated cost of one piece of ``length`` tokens that attends to itself."""
    return linear * length + quadratic * length * length


def rooms(tokens: int, capacity: int = CAPACITY) -> list[int]:
    """Sizes of the sequences that hold exactly ``tokens`` tokens without padding."""
    rest = tokens % capacity
    return [capacity] * (tokens // capacity) + [1 << b for b in range(rest.bit_length() - 1, -1, -1) if rest >> b & 1]


def assign(lengths: list[int], sizes: list[int], linear: float = LINEAR, quadratic: float = QUADRATIC) -> list[tuple[int, int, int, int, int]]:
    """Pieces ``(document, start, length, sequence, offset)``; the sizes add up to the lengths.

    A heap holds the open sequences by cost. Those too full for the whole document are set aside; if
    none has room, the document fills them from the lowest cost on.
    """
    order = sorted(range(len(lengths)), key=lambda i: (-cost(lengths[i], linear, quadratic), i))
    used = [0] * len(sizes)
    heap = [(0.0, s) for s in range(len(sizes))]
    out: list[tuple[int, int, int, int, int]] = []

    def put(doc: int, start: int, length: int, spent: float, seq: int) -> None:
        out.append((doc, start, length, seq, used[seq]))
        used[seq] += length
        if used[seq] < sizes[seq]:
            heapq.heappush(heap, (spent + cost(length, linear, quadratic), seq))

    for doc in order:
        left, aside, home = lengths[doc], [], None
        while heap:
            spent, seq = heapq.heappop(heap)
            if sizes[seq] - used[seq] >= left:
                home = (spent, seq)
                break
            aside.append((spent, seq))
        if home:
            put(doc, 0, left, *home)
        for item in aside:
            heapq.heappush(heap, item)
        start = 0
        while not home and left:
            spent, seq = heapq.heappop(heap)
            part = min(left, sizes[seq] - used[seq])
            put(doc, start, part, spent, seq)
            start, left = start + part, left - part
    return out


def pack_block(ids: list[np.ndarray], capacity: int, linear: float, quadratic: float) -> list[tuple[int, int, int, int, int]]:
    """Pieces of one block, with sequences numbered from 0."""
    out: list[tuple[int, int, int, int, int]] = []
    rests, sequence = [], 0
    for doc, x in enumerate(ids):
        for start in range(0, len(x) - capacity + 1, capacity):
            out.append((doc, start, capacity, sequence, 0))
            sequence += 1
        if len(x) % capacity:
            rests.append((doc, len(x) // capacity * capacity, len(x) % capacity))
    sizes = rooms(sum(n for _, _, n in rests), capacity)
    for i, start, length, seq, offset in assign([n for _, _, n in rests], sizes, linear, quadratic):
        out.append((rests[i][0], rests[i][1] + start, length, sequence + seq, offset))
    return out


def pack(
    docs: DataFrame, tokenizer: str, capacity: int = CAPACITY, end_id: int | None = END_ID,
    block_tokens: int = BLOCK_TOKENS, linear: float = LINEAR, quadratic: float = QUADRATIC,
) -> DataFrame:
    """One row per piece with its ids (little-endian unsigned 32-bit integers).

    ``tokenizer`` is the path of a public ``tokenizers`` file. ``capacity`` must be a power of two.
    ``sequence_id`` is unique over the table; every sequence lies within one block.
    """
    spec = docs.sparkSession.sparkContext.broadcast(read_spec(tokenizer))
    tail = b"" if end_id is None else int(end_id).to_bytes(4, "little")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec = Codec(spec.value, KEPT)
        sequence = TaskContext.get().partitionId() << 32
        names: list[int | None] = []
        ids: list[np.ndarray] = []
        tokens = 0

        def flush() -> pa.RecordBatch:
            nonlocal names, ids, tokens, sequence
            pieces = pack_block(ids, capacity, linear, quadratic)
            doc, start, length, seq, offset = (list(x) for x in zip(*pieces, strict=True)) if pieces else ([],) * 5
            out = pa.record_batch(
                [
                    pa.array([names[d] for d in doc], pa.int64()), pa.array(start, pa.int64()), pa.array(length, pa.int64()),
                    pa.array([ids[d][s : s + n].tobytes() for d, s, n in zip(doc, start, length, strict=True)], pa.binary()),
                    pa.array([len(ids[d]) for d in doc], pa.int64()),
                    pa.array([sequence + s for s in seq], pa.int64()), pa.array(offset, pa.int64()),
                ],
                names=["doc_id", "start", "length", "ids", "doc_tokens", "sequence_id", "offset"],
            )
            sequence += max(seq, default=-1) + 1
            names, ids, tokens = [], [], 0
            return out

        for batch in batches:
            names_in = batch.column(0).to_pylist()
            for name, data in zip(names_in, codec.encode(batch.column(1)), strict=True):
                names.append(name)
                ids.append(np.frombuffer(data + tail, "<u4"))
                tokens += len(ids[-1])
                if tokens >= block_tokens:
                    yield flush()
        if names:
            yield flush()

    return texts(docs).mapInArrow(run, SCHEMA)


def digests(pieces: DataFrame) -> DataFrame:
    """The pieces with a checksum in place of their ids."""
    return pieces.select(
        "doc_id", "start", "length", F.crc32("ids").alias("ids_crc32"), "doc_tokens", "sequence_id", "offset"
    )
