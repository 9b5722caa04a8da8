"""Cuckoo filters over counted keys, in shards that Spark deals out by the key.

A shard holds a filter of 16-bit fingerprints and the exact entries behind it. Adding a key asks the
filter first: a miss is surely new, a hit is verified against the stored keys of the shard. When the
filter cannot place a fingerprint, it is built again at twice the size from the stored keys. An entry
counts the documents that hold its key and keeps the best of them; one that loses its last document
leaves the entries and the filter. All of it lives in frames, so an index can be written and grown or
shrunk later by the documents that come and go.
"""

from __future__ import annotations

from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.session import written

SLOTS = 4
SALTS = 16
NO_DOC = -(1 << 63)  # stands for a null doc_id, which loses against any other

ENTRIES = "shard int, key binary, n long, first long, second long, cells binary"


class CuckooFilter:
    """Buckets of four fingerprints; each key has two buckets, either of them found from the other."""

    def __init__(self, cells: np.ndarray) -> None:
        self.cells = cells

    @classmethod
    def sized(cls, keys: int) -> CuckooFilter:
        buckets = 1 << max(4, int(np.ceil(np.log2(max(keys, 1) / (SLOTS * 0.9)))))
        return cls(np.zeros((buckets, SLOTS), np.uint16))

    def places(self, keys: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        mask = np.uint64(len(self.cells) - 1)
        prints = (keys >> np.uint64(48)).astype(np.uint16)
        prints[prints == 0] = 1
        first = keys & mask
        return prints, first.astype(np.int64), (first ^ self._hop(prints, mask)).astype(np.int64)

    @staticmethod
    def _hop(prints: np.ndarray, mask: np.uint64) -> np.ndarray:
        return (prints.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15) >> np.uint64(20)) & mask

    def contains(self, keys: np.ndarray) -> np.ndarray:
        prints, first, second = self.places(keys)
        seen = prints[:, None]
        return (self.cells[first] == seen).any(1) | (self.cells[second] == seen).any(1)

    def insert(self, keys: np.ndarray, kicks: int = 500) -> bool:
        """False if a fingerprint found no place; the filter must then be built anew."""
        prints, first, second = self.places(keys)
        left = np.arange(len(keys))
        for bucket in (first, second):
            left = left[np.argsort(bucket[left], kind="stable")]
            at = bucket[left]
            start = np.flatnonzero(np.append(True, at[1:] != at[:-1])) if len(at) else at
            turn = np.arange(len(at)) - np.repeat(start, np.diff(np.append(start, len(at))))
            free = np.cumsum(self.cells[at] == 0, axis=1)
            fits = turn < free[:, -1] if len(at) else np.zeros(0, bool)
            slot = np.argmax(free[fits] == turn[fits, None] + 1, axis=1) if fits.any() else []
            self.cells[at[fits], slot] = prints[left[fits]]
            left = left[~fits]
        mask = np.uint64(len(self.cells) - 1)
        for i in left.tolist():
            mark, bucket = prints[i : i + 1].copy(), int(second[i])
            for kick in range(kicks):
                row = self.cells[bucket]
                if (empty := np.flatnonzero(row == 0)).size:
                    row[empty[0]] = mark[0]
                    break
                slot = (bucket + kick) % SLOTS
                row[slot], mark[0] = mark[0], row[slot]
                bucket ^= int(self._hop(mark, mask)[0])
            else:
                return False
        return True

    def delete(self, keys: np.ndarray) -> None:
        """One fingerprint for each key; the keys must have been inserted."""
        prints, first, second = self.places(keys)
        for mark, *buckets in zip(prints, first.tolist(), second.tolist(), strict=True):
            for bucket in buckets:
                if (at := np.flatnonzero(self.cells[bucket] == mark)).size:
                    self.cells[bucket, at[0]] = 0
                    break


class Shard:
    """The filter and the exact entries of one shard; keys are rows of unsigned 64-bit words."""

    def __init__(self, keys: np.ndarray, n: np.ndarray, best: np.ndarray, cells: bytes | None = None) -> None:
        self.keys, self.n, self.best = keys, n, best
        if cells is None:
            self.rebuild(len(keys))
        else:
            self.filter = CuckooFilter(np.frombuffer(cells, np.uint16).reshape(-1, SLOTS).copy())
        self.sort()

    def rebuild(self, room: int) -> None:
        self.filter = CuckooFilter.sized(room)
        while not self.filter.insert(self.keys[:, 0]):
            room *= 2
            self.filter = CuckooFilter.sized(room)

    def sort(self) -> None:
        self.order = np.argsort(self.keys[:, 0], kind="stable")
        self.sorted = self.keys[self.order, 0]

    def find(self, keys: np.ndarray) -> np.ndarray:
        """The entry of each key, or -1: a filter hit counts only if the whole key is stored."""
        out = np.full(len(keys), -1)
        open_ = np.flatnonzero(self.filter.contains(keys[:, 0])) if len(self.keys) else np.empty(0, np.int64)
        at = np.searchsorted(self.sorted, keys[open_, 0])
        while len(open_):  # more than once only where first words are equal
            near = at < len(self.sorted)
            open_, at = open_[near], at[near]
            same = self.sorted[at] == keys[open_, 0]
            open_, at = open_[same], at[same]
            equal = (self.keys[self.order[at]] == keys[open_]).all(1)
            out[open_[equal]] = self.order[at[equal]]
            open_, at = open_[~equal], at[~equal] + 1
        return out

    def add(self, keys: np.ndarray, n: np.ndarray, best: np.ndarray) -> None:
        """Distinct keys with the documents that hold them."""
        at = self.find(keys)
        old, new = at >= 0, at < 0
        hit = at[old]
        self.n[hit] += n[old]
        more = (best[old, 0] > self.best[hit, 0]) | (best[old, 0] == self.best[hit, 0]) & (best[old, 1] > self.best[hit, 1])
        self.best[hit[more]] = best[old][more]
        fits = self.filter.insert(keys[new, 0])
        self.keys, self.n = np.concatenate([self.keys, keys[new]]), np.concatenate([self.n, n[new]])
        self.best = np.concatenate([self.best, best[new]])
        if not fits:
            self.rebuild(2 * SLOTS * len(self.filter.cells))
        self.sort()

    def put(self, keys: np.ndarray, n: np.ndarray, best: np.ndarray) -> None:
        """New counts of live keys; a count of 0 removes the key."""
        at = self.find(keys)
        if (at < 0).any():
            raise ValueError("a key to be changed is not in the index")
        self.n[at], self.best[at] = n, best
        self.filter.delete(keys[n == 0, 0])
        live = self.n > 0
        self.keys, self.n, self.best = self.keys[live], self.n[live], self.best[live]
        self.sort()


def _words(column: pa.ChunkedArray) -> np.ndarray:
    raw = column.to_pylist()
    return np.frombuffer(b"".join(raw), ">u8").astype(np.uint64).reshape(len(raw), -1)


def _update(table: pa.Table) -> pa.Table:
    """Applies one shard's changes, salt by salt, to its entries."""
    shard = table["shard"][0].as_py()
    turn = table["turn"].to_numpy()
    width = max((len(k) for k in table["key"].to_pylist() if k is not None), default=16) // 8
    filters = [c for c in table["cells"].to_pylist() if c is not None]

    def part(of: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        rows = table.filter(pa.array(turn == of))
        keys = _words(rows["key"]) if len(rows) else np.empty((0, width), np.uint64)
        return keys, rows["n"].to_numpy().copy(), np.stack([rows["first"].to_numpy(), rows["second"].to_numpy()], 1)

    state = Shard(*part(-1), filters[0] if filters else None)
    for of in sorted({*turn.tolist()} - {-1, -2}):
        (state.put if of == SALTS else state.add)(*part(of))
    keys = [k.tobytes() for k in state.keys.astype(">u8")]
    rows = len(keys)
    return pa.table(
        {
            "shard": pa.array([shard] * (rows + 1), pa.int32()), "key": pa.array([*keys, None], pa.binary()),
            "n": pa.array([*state.n.tolist(), None], pa.int64()), "first": pa.array([*state.best[:, 0].tolist(), None], pa.int64()),
            "second": pa.array([*state.best[:, 1].tolist(), None], pa.int64()),
            "cells": pa.array([None] * rows + [state.filter.cells.tobytes()], pa.binary()),
        }
    )


@dataclass(frozen=True)
class LiveIndex:
    """``members`` (``key, doc_id, first, second``): who holds which key, ranked by the two numbers.
    ``state``: the entries of all shards, and each shard's filter in a row without key.

    The number of shards is fixed when the index is made (``each`` keys a shard); both frames are
    written tables, so later steps and other sessions can read them.
    """

    shards: int
    members: DataFrame
    state: DataFrame | None = None

    @property
    def entries(self) -> DataFrame:
        return self.state.where("key IS NOT NULL").select("key", "n", "first", "second")

    def _apply(self, changes: DataFrame, members: DataFrame) -> LiveIndex:
        columns = "shard int, key binary, n long, first long, second long, cells binary, turn int"
        names = [c.split()[0] for c in columns.split(", ")]
        shard = F.pmod(F.hash("key"), F.lit(self.shards))
        rows = changes.withColumn("shard", shard).withColumn("cells", F.lit(None).cast("binary")).select(*names)
        if self.state is not None:
            old = self.state.withColumn("turn", F.when(F.col("key").isNull(), -2).otherwise(-1))
            rows = rows.unionByName(old.select(*names))
        return LiveIndex(self.shards, members, written(rows.groupBy("shard").applyInArrow(_update, ENTRIES), "index"))

    def insert(self, members: DataFrame) -> LiveIndex:
        """Adds a written frame of members.

        Rows of one key are added up by salt before they meet, so a key that a third of all documents
        share sends sixteen rows at most to its shard.
        """
        salt = F.pmod(F.hash("doc_id"), F.lit(SALTS)).alias("turn")
        best = F.max(F.struct("first", "second"))
        added = members.groupBy("key", salt).agg(F.count("*").alias("n"), best.alias("best"))
        added = added.select("key", "turn", "n", "best.first", "best.second")
        return self._apply(added, members if self.state is None else self.members.unionByName(members))

    def delete(self, doc_ids: DataFrame) -> LiveIndex:
        """Removes the documents of ``doc_id`` and leaves the index as if they had never come."""
        gone = doc_ids.select(F.col("doc_id").alias("_gone")).distinct()
        members = written(self.members.join(gone, F.expr("doc_id <=> _gone"), "left_anti"), "members")
        touched = self.members.join(gone, F.expr("doc_id <=> _gone"), "left_semi").select("key").distinct()
        salt = F.pmod(F.hash("doc_id"), F.lit(SALTS))
        left = members.join(touched, "key", "left_semi").groupBy("key", salt).agg(
            F.count("*").alias("n"), F.max(F.struct("first", "second")).alias("best")
        )
        left = left.groupBy("key").agg(F.sum("n").alias("n"), F.max("best").alias("best"))
        changes = touched.join(left, "key", "left").select(
            "key", F.lit(SALTS).alias("turn"), F.coalesce("n", F.lit(0)).alias("n"),
            F.coalesce("best.first", F.lit(0)).alias("first"), F.coalesce("best.second", F.lit(NO_DOC)).alias("second"),
        )
        return self._apply(changes, members)


def document(second: str, sign: int = 1):
    """The ``doc_id`` that a rank stands for."""
    return F.when(F.col(second) != NO_DOC, sign * F.col(second))
