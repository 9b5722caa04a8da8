"""Token ids in binary files of shuffled bit planes.

Documents are dealt into ranges of ``doc_id``, one file each. A file holds the ids of its documents one
after the other, cut into chunks of a fixed number of ids. A chunk is transposed into bit planes or byte
planes, whichever are smaller, each compressed by zstandard; planes of zeros are left out. Behind the chunks lie the documents'
names and lengths in blocks, stored in the same way, then the index of chunks and blocks, so any range of
ids is read without what surrounds it.

    magic | planes of chunk 0 | ... | names and lengths of block 0 | ... | index | its place and size | magic

Tasks write below the shared folder under names of their own. A file counts when the manifest, a table that
Spark commits, lists it; what a lost or repeated task left behind is never read.

Defined results: a null or empty text has the end token alone; rows that repeat a ``doc_id`` are
written each, in the order of their texts' hashes; rows without a ``doc_id`` come first; an empty table
has no files.
"""

from __future__ import annotations

import io
import json
import struct
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.fs as pafs
import zstandard
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsflow.llm.bpe import KEPT, Codec, read_spec
from newsflow.llm.common import parts_for, texts
from newsflow.session import fresh_path, written

MAGIC = b"BITPLAN1"
CHUNK_IDS = 1 << 16
PLANES = 32  # of an id, at most
BLOCK_DOCS, BLOCK_IDS = 4096, 1 << 20  # a block of documents ends at either
FILE_BYTES = 256 << 20  # text that one file is meant for
LEVEL = 3
END_ID = 2

MANIFEST = "shard long, file string, block long, n_docs long, first_id long, n_ids long, file_bytes long"


def split_planes(values: np.ndarray, bits: bool) -> list[bytes]:
    """The planes of unsigned ``values``, least significant first; ``b""`` for one of zeros only."""
    width = values.dtype.itemsize
    raw = values.astype(values.dtype.newbyteorder("<")).view(np.uint8).reshape(-1, width)
    used = int(np.bitwise_or.reduce(values)) if len(values) else 0
    if not bits:
        return [raw[:, i].tobytes() if used >> 8 * i & 255 else b"" for i in range(width)]
    out = []
    for i in range(width):
        column = np.ascontiguousarray(raw[:, i])
        out += [np.packbits((column >> b) & 1).tobytes() if used >> (8 * i + b) & 1 else b"" for b in range(8)]
    return out


def join_planes(planes: list[bytes], n: int, dtype: np.dtype, bits: bool) -> np.ndarray:
    """The inverse of ``split_planes`` for ``n`` values."""
    raw = np.zeros((n, np.dtype(dtype).itemsize), np.uint8)
    for i, plane in enumerate(planes):
        if plane and bits:
            raw[:, i // 8] |= np.unpackbits(np.frombuffer(plane, np.uint8), count=n) << (i % 8)
        elif plane:
            raw[:, i] = np.frombuffer(plane, np.uint8)
    return raw.reshape(-1).view(np.dtype(dtype).newbyteorder("<")).astype(dtype)


def open_store(path: str) -> tuple[pafs.FileSystem, str]:
    """The file system of a folder's URI and the path in it."""
    return pafs.FileSystem.from_uri(path.replace("s3a://", "s3://", 1))


class PlaneWriter:
    """Writes one file; ``add`` takes the documents in order."""

    def __init__(self, out, chunk_ids: int = CHUNK_IDS, bits: bool | None = None, level: int = LEVEL) -> None:
        self.out, self.chunk_ids, self.bits = out, chunk_ids, bits
        self.zstd = zstandard.ZstdCompressor(level=level, write_checksum=True)
        self.at = 0
        self._put(MAGIC)
        self.pending: list[np.ndarray] = []
        self.n_pending = self.n_ids = 0
        self.chunks: list[list[int]] = []
        self.docs: list[tuple[int | None, int]] = []
        self.blocks: list[dict] = []
        self.waiting: list[list[bytes]] = []

    def _put(self, data: bytes) -> None:
        self.out.write(data)
        self.at += len(data)

    def _compressed(self, values: np.ndarray, bits: bool) -> list[bytes]:
        return [self.zstd.compress(p) if p else b"" for p in split_planes(values, bits)]

    def add(self, name: int | None, ids: np.ndarray) -> None:
        self.docs.append((name, len(ids)))
        self.pending.append(ids)
        self.n_pending += len(ids)
        self.n_ids += len(ids)
        if self.n_pending >= self.chunk_ids:
            joined = np.concatenate(self.pending)
            whole = len(joined) // self.chunk_ids * self.chunk_ids
            for start in range(0, whole, self.chunk_ids):
                self._chunk(joined[start : start + self.chunk_ids])
            self.pending, self.n_pending = [joined[whole:]], len(joined) - whole
        first = self.blocks[-1]["first_id"] + self.blocks[-1]["n_ids"] if self.blocks else 0
        if len(self.docs) >= BLOCK_DOCS or self.n_ids - first >= BLOCK_IDS:
            self._block()

    def _chunk(self, ids: np.ndarray) -> None:
        tried = [(b, self._compressed(ids.astype(np.uint32), b)) for b in ((True, False) if self.bits is None else (self.bits,))]
        bits, planes = min(tried, key=lambda t: sum(map(len, t[1])))
        sizes = [*map(len, planes), *[0] * (PLANES - len(planes))]
        self.chunks.append([self.at, len(ids), int(bits), *sizes])
        self._put(b"".join(planes))

    def _block(self) -> None:
        """Documents' names and lengths are kept compressed until the chunks are out."""
        first = self.blocks[-1]["first_id"] + self.blocks[-1]["n_ids"] if self.blocks else 0
        names = np.array([0 if d is None else d for d, _ in self.docs], np.int64).view(np.uint64)
        sizes = np.array([n for _, n in self.docs], np.uint64)
        unnamed = np.array([d is None for d, _ in self.docs], np.uint8)
        parts = [self._compressed(x, False) for x in (names, sizes, unnamed)]
        self.blocks.append({"n_docs": len(self.docs), "first_id": first, "n_ids": int(sizes.sum()), "sizes": [list(map(len, p)) for p in parts]})
        self.waiting.append([x for p in parts for x in p])
        self.docs = []

    def close(self) -> None:
        if self.n_pending:
            self._chunk(np.concatenate(self.pending))
        if self.docs:
            self._block()
        for block, parts in zip(self.blocks, self.waiting, strict=True):
            block["at"] = self.at
            self._put(b"".join(parts))
        index = {"chunk_ids": self.chunk_ids, "n_ids": self.n_ids, "blocks": self.blocks}
        table = self.zstd.compress(np.array(self.chunks, np.int64).tobytes())
        head, at = self.zstd.compress(json.dumps(index).encode()), self.at
        self._put(head + table + struct.pack("<QQQ", at, len(head), len(table)) + MAGIC)


class PlaneReader:
    """Reads ids and documents of one file by its index."""

    def __init__(self, file) -> None:
        self.file = file
        self.zstd = zstandard.ZstdDecompressor()
        tail = self._get(file.size() - 32, 32)
        if tail[24:] != MAGIC:
            raise ValueError("not a file of bit planes, or one that was cut")
        at, n_head, n_table = struct.unpack("<QQQ", tail[:24])
        data = self._get(at, n_head + n_table)
        self.index = json.loads(self.zstd.decompress(data[:n_head]))
        self.chunk_ids, self.blocks = self.index["chunk_ids"], self.index["blocks"]
        self.chunks = np.frombuffer(self.zstd.decompress(data[n_head:]), np.int64).reshape(-1, 3 + PLANES)
        self._last: tuple[int, np.ndarray] | None = None

    def _get(self, at: int, n: int) -> bytes:
        self.file.seek(at)
        return self.file.read(n)

    def _planes(self, at: int, sizes: list[int]) -> list[bytes]:
        data, ends = self._get(at, int(sum(sizes))), np.cumsum([0, *sizes]).tolist()
        return [self.zstd.decompress(data[a:b]) if b > a else b"" for a, b in zip(ends, ends[1:], strict=False)]

    def chunk(self, i: int) -> np.ndarray:
        if self._last is None or self._last[0] != i:
            at, n, bits, *sizes = self.chunks[i].tolist()
            self._last = (i, join_planes(self._planes(at, sizes), n, np.uint32, bool(bits)))
        return self._last[1]

    def ids(self, start: int, stop: int) -> np.ndarray:
        """The ids from ``start`` up to ``stop`` of the file; only their chunks are read."""
        if stop <= start:
            return np.zeros(0, np.uint32)
        size, found = self.chunk_ids, []
        for i in range(start // size, (stop - 1) // size + 1):
            found.append(self.chunk(i)[max(start - i * size, 0) : stop - i * size])
        return found[0] if len(found) == 1 else np.concatenate(found)

    def documents(self, block: int) -> list[tuple[int | None, int]]:
        """Name and number of ids of each document of a block."""
        meta = self.blocks[block]
        flat = self._planes(meta["at"], [n for sizes in meta["sizes"] for n in sizes])
        n, kinds = meta["n_docs"], (np.uint64, np.uint64, np.uint8)
        columns, at = [], 0
        for sizes, kind in zip(meta["sizes"], kinds, strict=True):
            columns.append(join_planes(flat[at : at + len(sizes)], n, kind, False))
            at += len(sizes)
        names = columns[0].view(np.int64).tolist()
        return [(None if gone else name, size) for name, size, gone in zip(names, columns[1].tolist(), columns[2].tolist(), strict=True)]


def to_bytes(docs: list[tuple[int | None, np.ndarray]], chunk_ids: int = CHUNK_IDS, bits: bool | None = None) -> bytes:
    """One file of ``docs`` in memory."""
    out = io.BytesIO()
    writer = PlaneWriter(out, chunk_ids, bits)
    for name, ids in docs:
        writer.add(name, ids)
    writer.close()
    return out.getvalue()


def write(
    docs: DataFrame, tokenizer: str, folder: str | None = None, end_id: int | None = END_ID, bits: bool | None = None, chunk_ids: int = CHUNK_IDS,
) -> DataFrame:
    """Encodes each whole text and writes all ids in ascending ``doc_id`` order; returns the manifest.

    The manifest has a row per block of documents: the ``shard`` (files in order), its ``file``, and the
    block's place in it. ``folder`` is a URI that all executors reach, the shared folder by default. Texts
    move once, to their range, and are encoded there; a task holds one chunk and one text.
    """
    spark = docs.sparkSession
    spec = spark.sparkContext.broadcast(read_spec(tokenizer))
    tail = b"" if end_id is None else int(end_id).to_bytes(4, "little")
    folder = (folder or fresh_path(spark, "planes")).rstrip("/")
    rows = texts(docs).withColumn("_tie", F.xxhash64("text"))
    volume = rows.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    parts = parts_for(spark, volume, FILE_BYTES)
    ranged = rows.repartitionByRange(parts, "doc_id", "_tie").sortWithinPartitions("doc_id", "_tie").drop("_tie")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        codec, writer, out = Codec(spec.value, KEPT), None, None
        shard = TaskContext.get().partitionId()
        for batch in batches:
            names_in = batch.column(0).to_pylist()
            for name, data in zip(names_in, codec.encode(batch.column(1)), strict=True):
                if writer is None:
                    store, base = open_store(folder)
                    store.create_dir(base, recursive=True)
                    file = f"{base}/ids-{shard:06d}-{uuid.uuid4().hex}.planes"
                    out = store.open_output_stream(file)
                    writer = PlaneWriter(out, chunk_ids, bits)
                writer.add(name, np.frombuffer(data + tail, "<u4"))
        if writer is None:
            return
        writer.close()
        out.close()
        blocks = [[shard, f"{folder}/{file.rsplit('/', 1)[1]}", i, b["n_docs"], b["first_id"], b["n_ids"], writer.at] for i, b in enumerate(writer.blocks)]
        yield pa.record_batch([pa.array(list(x)) for x in zip(*blocks, strict=True)], names=[c.split()[0] for c in MANIFEST.split(", ")])

    return written(ranged.mapInArrow(run, MANIFEST), "manifest")


def read(manifest: DataFrame) -> DataFrame:
    """``doc_id, start, ids`` of every document in the listed files.

    ``start`` counts the ids of all documents before it; ``ids`` are little-endian unsigned 32-bit
    integers. Blocks are read apart from each other, by as many tasks as there are blocks to go round.
    """
    before = Window.orderBy("shard").rowsBetween(Window.unboundedPreceding, -1)
    bases = manifest.groupBy("shard").agg(F.sum("n_ids").alias("_n")).select("shard", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("base"))
    spread = parts_for(manifest.sparkSession, manifest.count(), 64)
    blocks = manifest.join(bases, "shard").select("file", "block", "first_id", "base").repartition(spread, "file", "block").sortWithinPartitions("file", "block")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        opened, reader = None, None
        for batch in batches:
            for row in batch.to_pylist():
                if opened != row["file"]:
                    folder, name = row["file"].rsplit("/", 1)
                    store, base = open_store(folder)
                    opened, reader = row["file"], PlaneReader(store.open_input_file(f"{base}/{name}"))
                at, names, starts, ids, held = row["first_id"], [], [], [], 0
                for name, size in reader.documents(row["block"]):
                    names.append(name)
                    starts.append(row["base"] + at)
                    ids.append(reader.ids(at, at + size).astype("<u4").tobytes())
                    at, held = at + size, held + size
                    if held >= BLOCK_IDS:
                        yield _found(names, starts, ids)
                        names, starts, ids, held = [], [], [], 0
                if names:
                    yield _found(names, starts, ids)

    def _found(names: list[int | None], starts: list[int], ids: list[bytes]) -> pa.RecordBatch:
        return pa.record_batch([pa.array(names, pa.int64()), pa.array(starts, pa.int64()), pa.array(ids, pa.binary())], names=["doc_id", "start", "ids"])

    return blocks.mapInArrow(run, "doc_id long, start long, ids binary")


def digests(found: DataFrame) -> DataFrame:
    """The documents with length and checksum in place of their ids."""
    size = (F.octet_length("ids") / 4).cast("long")
    return found.select("doc_id", "start", size.alias("n_tokens"), F.crc32("ids").alias("ids_crc32"))
