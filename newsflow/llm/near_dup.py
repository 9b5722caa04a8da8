"""Documents whose sets of word shingles are alike: a T-occurrence search with DivideSkip.

A document's set holds the hashes of its distinct five-word shingles. Two documents link when their
sets share at least 75 of 100 of what they hold together, so ``T = ceil(0.75 n)`` at least. Of the
``n - T + c`` first shingles of either, in any order that is the same for all documents, they share
``c``; these are the short lists of the search, the others its long ones. The order puts shingles that
many documents hold last; their counts come from all documents, and at most ``frequent`` of them are
told apart.

1. Each task hashes its texts; equal sets are one node, with those first shingles.
2. Sets that share less than ``c`` of their short lists with others are done. The nodes of an inverted
   list are sorted by size. In a list of at most ``LIST`` nodes each meets those before it, and the pairs' lists
   are counted: a pair is tied if these and the longer lists of either can make ``c``. In a longer list no pairs
   are made: only nodes with ``c`` such lists take part, each tied to the smallest that can still be
   its partner. The ties' components are clusters; every link lies within one.
3. A cluster's sets come together (large clusters in pairs of blocks). Each set asks the others: its
   short lists are merged and counted, its longest lists are only probed, by binary search, for the
   candidates that can still reach the overlap. Candidates that are known to be connected are left
   out, so a group of near copies costs little more than its size.
4. The components of the links are the classes.

Hashes have 64 bits; so have the digests of whole sets that stand for nodes.

Defined results: a null or empty text has no shingles and is linked with nothing; with fewer words
than five the whole sequence is one shingle; a null ``doc_id`` is smaller than any other; rows that
repeat a ``doc_id`` are classed each by their own text, and ``keep_one`` keeps all of them if it keeps
one; an empty table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from newsflow.llm.collocations import bitmap_of, holds
from newsflow.llm.common import SPACES, most_counted, texts
from newsflow.llm.components import components
from newsflow.session import release, written

WORDS = 5
PERCENT = 75
MARGIN = 20  # one of so many shingles must be shared beyond the first, within the short lists
FREQUENT = 1 << 20  # shingles told apart by their counts; bounds what is broadcast
LIST = 16  # nodes of a list that meet in pairs
BLOCK = 4096  # sets in one block of a large cluster
SKIP_WEIGHT = 0.0085  # how much of the threshold goes to long lists, as published for DivideSkip
NO_DOC = -(1 << 63)

_LEAST = f"1 + {PERCENT} * n div {100 * MARGIN}"  # lists a set must share with its smallest possible partner
_ODD = np.uint64(0x9E3779B97F4A7C15)
_INVERSE = np.uint64(pow(int(_ODD), -1, 1 << 64))


def mix(x: np.ndarray) -> np.ndarray:
    x = (x ^ (x >> np.uint64(30))) * np.uint64(0xBF58476D1CE4E5B9)
    x = (x ^ (x >> np.uint64(27))) * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


_BYTES = mix(np.arange(1, 257, dtype=np.uint64) * _ODD)
_PLACES = mix(np.arange(1, WORDS + 1, dtype=np.uint64) * np.uint64(0xC2B2AE3D27D4EB4F)) | np.uint64(1)
_SPACE = np.isin(np.arange(256), list(SPACES.encode()))


def shingle_sets(found: list[str]) -> list[np.ndarray]:
    """The sorted hashes of each text's distinct shingles.

    Words are hashed together: a running sum of weighted bytes gives every word's sum at once.
    """
    out: list[np.ndarray] = []
    start = 0
    while start < len(found):  # about a megabyte at a time
        stop, size = start, 0
        while stop < len(found) and (stop == start or size + len(found[stop]) < 1 << 20):
            size += len(found[stop])
            stop += 1
        out += _sets([t.encode().lower() for t in found[start:stop]])
        start = stop
    return out


def _sets(data: list[bytes]) -> list[np.ndarray]:
    raw = np.frombuffer(b"\n".join(data) + b"\n", np.uint8)
    space = _SPACE[raw]
    starts = np.flatnonzero(~space & np.append(True, space[:-1]))
    ends = np.flatnonzero(~space & np.append(space[1:], True)) + 1
    power, back = np.full(len(raw), _ODD), np.full(len(raw), _INVERSE)
    power[0] = back[0] = 1
    power, back = np.multiply.accumulate(power), np.multiply.accumulate(back)
    sums = np.append(np.uint64(0), np.cumsum(_BYTES[raw] * power))
    words = mix((sums[ends] - sums[starts]) * back[starts] + (ends - starts).astype(np.uint64) * _ODD)
    runs = len(words) - WORDS + 1
    shingles = mix(sum(words[i : runs + i] * _PLACES[i] for i in range(WORDS))) if runs > 0 else words[:0]
    out, at = [], 0
    for end in np.searchsorted(starts, np.cumsum([len(d) + 1 for d in data])).tolist():
        n = end - at
        if n >= WORDS:
            out.append(np.unique(shingles[at : end - WORDS + 1]))
        else:
            whole = int((words[at:end] * _PLACES[:n]).sum(dtype=np.uint64)) + n
            out.append(mix(np.array([whole % (1 << 64)] if n else [], np.uint64)))
        at = end
    return out


def digest(shingles: np.ndarray) -> int:
    """64 bits that stand for the whole set."""
    total = int(mix(shingles ^ np.uint64(0x5851F42D4C957F2D)).sum(dtype=np.uint64)) + len(shingles) * int(_ODD)
    return int(mix(np.array([total % (1 << 64)], np.uint64))[0].astype(np.int64))


def frequent_shingles(docs: DataFrame, most: int = FREQUENT) -> tuple[np.ndarray, np.ndarray]:
    """Shingles that lie in several sets of a batch, with the sum of those counts; the ``most``
    frequent of them by a cut through the counts' histogram. They order shingles, nothing else."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = {digest(s): s for s in shingle_sets(batch.column(0).to_pylist())}
            found, counts = np.unique(np.concatenate([np.empty(0, np.uint64), *sets.values()]), return_counts=True)
            several = counts > 1
            yield pa.record_batch([pa.array(found[several].astype(np.int64)), pa.array(counts[several].astype(np.int64))], names=["shingle", "n"])

    counted = texts(docs).select("text").mapInArrow(run, "shingle long, n long").groupBy("shingle").agg(F.sum("n").alias("n"))
    top = most_counted(counted, most).toArrow()
    shingle, n = top["shingle"].to_numpy().astype(np.uint64), top["n"].to_numpy()
    order = np.argsort(shingle)
    return shingle[order], n[order]


def measured(docs: DataFrame) -> DataFrame:
    """``doc_id, n, node``: the size and the digest of every row's set."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            sets = shingle_sets(batch.column(1).to_pylist())
            columns = [pa.array([len(s) for s in sets], pa.int64()), pa.array([digest(s) if len(s) else None for s in sets], pa.int64())]
            yield pa.record_batch([batch.column(0), *columns], names=["doc_id", "n", "node"])

    return texts(docs).mapInArrow(run, "doc_id long, n long, node long")


def first_shingles(docs: DataFrame, frequent: tuple[np.ndarray, np.ndarray]) -> DataFrame:
    """``node, n, first``: the shingles of each set of which every partner shares one.

    Hashed anew rather than read: these hashes do not compress, and hashing costs less than keeping them.
    """
    shared = docs.sparkSession.sparkContext.broadcast(frequent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        common, weight = shared.value
        for batch in batches:
            sets = {digest(s): s for s in shingle_sets(batch.column(0).to_pylist()) if len(s)}
            first = []
            for s in sets.values():
                rank = np.zeros(len(s), np.int64)
                if len(common):
                    at = np.minimum(np.searchsorted(common, s), len(common) - 1)
                    rank = np.where(common[at] == s, weight[at], 0)
                first.append(s[np.argsort(rank, kind="stable")[: len(s) + (-PERCENT * len(s)) // 100 + 1 + len(s) // MARGIN]].astype(np.int64))
            columns = [pa.array(list(sets), pa.int64()), pa.array([len(s) for s in sets.values()], pa.int64()), pa.array(first, pa.list_(pa.int64()))]
            yield pa.record_batch(columns, names=["node", "n", "first"])

    return texts(docs).select("text").mapInArrow(run, "node long, n long, first array<long>")


def shared_lists(firsts: DataFrame, rounds: int = 2, most: int = LIST) -> DataFrame:
    """``node, n, shingle, long, crowded``: the short lists, without sets that have no candidate; ``long`` lists hold
    more than ``most`` nodes, and a node has ``crowded`` of them.

    A set counts its lists that hold another set of a size that could link. Where these are fewer than
    it must share with its smallest possible partner, which has three quarters of its size, it has none
    and leaves; what is left is counted again. Copies of a text are no other set.
    """
    lists = firsts.select("node", "n", F.explode("first").alias("shingle"))
    order = Window.partitionBy("shingle").orderBy("n", "node")
    lists = lists.withColumn("_last", F.lag("node").over(order)).where("_last IS NULL OR _last <> node")
    for _ in range(rounds):
        near = lists.withColumn("_before", F.lag("n").over(order)).withColumn("_after", F.lead("n").over(order))
        near = near.where(f"100 * _before >= {PERCENT} * n OR 100 * n >= {PERCENT} * _after")
        near = near.withColumn("long", F.count("*").over(order.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)) > most)
        lists = written(near.select("node", "n", "shingle", "long"), "lists")
        release(lists.sparkSession)
        enough = lists.groupBy("node", "n").agg(F.count("*").alias("_lists"), F.count_if("long").alias("crowded")).where(f"_lists >= {_LEAST}")
        lists = lists.join(enough.select("node", "crowded"), "node").select("node", "n", "shingle", "long", "crowded")
    return lists


def ties(lists: DataFrame, most: int = LIST) -> DataFrame:
    """``a, b``: pairs that can share enough lists. In long lists, among nodes that can link through these alone: each
    node and the smallest set from which sizes grow to its own without a gap that no link can cross."""
    order = Window.partitionBy("shingle").orderBy("n", "node")
    lists = lists.where(f"NOT long OR crowded >= {_LEAST}").withColumn("_before", F.lag("n").over(order))
    own = F.struct("n", "node", "crowded")
    head = F.when(F.expr(f"long AND (_before IS NULL OR 100 * _before < {PERCENT} * n)"), own)
    lists = lists.withColumn("_head", F.max(head).over(order.rowsBetween(Window.unboundedPreceding, Window.currentRow)))
    lists = lists.withColumn("_others", F.collect_list(F.when(~F.col("long"), own)).over(order.rowsBetween(1 - most, -1)))
    met = lists.withColumn("_other", F.explode(F.when(F.col("long"), F.array("_head")).otherwise(F.col("_others"))))
    met = met.where(f"_other.node <> node AND 100 * _other.n >= IF(long, 0, {PERCENT}) * n")
    met = met.select(F.col("_other.node").alias("a"), F.col("node").alias("b"), "long", F.col("_other.n").alias("n"), F.least("crowded", "_other.crowded").alias("crowded"))
    met = met.groupBy("a", "b").agg(F.count_if(~F.col("long")).alias("_lists"), F.bool_or("long").alias("tied"), F.min("n").alias("n"), F.min("crowded").alias("crowded"))
    return met.where(f"tied OR _lists + crowded >= 1 + n div {MARGIN}").select("a", "b")


class Links:
    """Finds the connected sets among some, by DivideSkip over their inverted lists."""

    def __init__(self, sets: list[np.ndarray]) -> None:
        self.sets = sets
        self.sizes = np.array([len(s) for s in sets])
        owner = np.repeat(np.arange(len(sets)), self.sizes)
        values = np.concatenate(sets)
        order = np.argsort(values, kind="stable")
        self.owner, values = owner[order], values[order]
        self.starts = np.flatnonzero(np.append(True, values[1:] != values[:-1]))
        self.stops = np.append(self.starts[1:], len(values))
        self.values = values[self.starts]
        self.parent = np.arange(len(sets))

    def root(self, i: int) -> int:
        while self.parent[i] != i:
            self.parent[i] = self.parent[self.parent[i]]
            i = self.parent[i]
        return int(i)

    def search(self, i: int) -> np.ndarray:
        """Sets linked with set ``i`` that are not connected with it yet."""
        s, n = self.sets[i], len(self.sets[i])
        at = np.searchsorted(self.values, s)
        length = self.stops[at] - self.starts[at]
        at = at[length > 1]
        if len(at) == 0:
            return at
        length = self.stops[at] - self.starts[at]
        needed = -(-PERCENT * n // 100)
        skip = min(needed - 1, int(needed / (SKIP_WEIGHT * np.log2(length.max()) + 1)), len(at))
        at = at[np.argsort(length, kind="stable")]
        short, long = at[: len(at) - skip], at[len(at) - skip :]
        if len(short):
            counts = np.bincount(np.concatenate([self.owner[self.starts[k] : self.stops[k]] for k in short.tolist()]), minlength=len(self.sets))
        else:
            counts = np.zeros(len(self.sets), np.int64)
        found = np.flatnonzero(counts >= needed - skip)
        found = found[(100 * self.sizes[found] >= PERCENT * n) & (100 * n >= PERCENT * self.sizes[found])]
        mine = self.root(i)
        found = np.array([j for j in found.tolist() if self.root(j) != mine], np.int64)
        total, left = counts[found], len(long)
        for k in long.tolist():
            if len(found) == 0:
                break
            list_ = self.owner[self.starts[k] : self.stops[k]]
            place = np.minimum(np.searchsorted(list_, found), len(list_) - 1)
            total = total + (list_[place] == found)
            left -= 1
            alive = total + left >= needed  # the others cannot reach the overlap any more
            found, total = found[alive], total[alive]
        return found[100 * total >= PERCENT * (n + self.sizes[found] - total)]

    def connect(self) -> np.ndarray:
        """The smallest set that each set is connected with."""
        for i in range(len(self.sets)):
            for j in self.search(i).tolist():
                a, b = sorted((self.root(i), self.root(j)))
                self.parent[b] = a
        return np.array([self.root(i) for i in range(len(self.sets))])


def _connect(table: pa.Table) -> pa.Table:
    nodes, first = np.unique(table["node"].to_numpy(), return_index=True)
    column = table["shingles"].combine_chunks()
    sets = [np.frombuffer(column[int(i)].as_py(), np.uint64) for i in first]
    root = Links(sets).connect()
    linked = root != np.arange(len(root))
    return pa.table({"a": pa.array(nodes[linked], pa.int64()), "b": pa.array(nodes[root[linked]], pa.int64())})


def member_sets(docs: DataFrame, members: DataFrame) -> DataFrame:
    """``node, cluster, size, shingles`` of the documents that stand for the nodes of ``members``.

    A bitmap of their ids, of a fixed size, keeps most other texts from being shuffled.
    """
    named = members.select(F.xxhash64("_doc").alias("key"))
    shared = docs.sparkSession.sparkContext.broadcast(bitmap_of(named))

    def likely(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            some = batch.filter(pa.array(holds(shared.value, batch.column(2).to_numpy().view(np.uint64))))
            yield some.select([0, 1])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            node, sets = batch.column(1).to_pylist(), shingle_sets(batch.column(0).to_pylist())
            same = [i for i, s in enumerate(sets) if len(s) and digest(s) == node[i]]  # a repeated doc_id may have other texts
            rest = [batch.column(i).take(pa.array(same, pa.int64())) for i in (1, 2, 3)]
            yield pa.record_batch([*rest, pa.array([sets[i].tobytes() for i in same], pa.binary())], names=["node", "cluster", "size", "shingles"])

    found = texts(docs).withColumn("key", F.xxhash64("doc_id")).mapInArrow(likely, "doc_id long, text string")
    rows = found.join(members, F.expr("doc_id <=> _doc")).select("text", "node", "cluster", "size")
    return rows.mapInArrow(run, "node long, cluster long, size long, shingles binary")


def links(docs: DataFrame, rows: DataFrame, frequent: tuple[np.ndarray, np.ndarray], block: int = BLOCK) -> DataFrame:
    """``a, b``: links that connect the nodes of each class."""
    nodes = rows.where("n > 0").groupBy("node").agg(F.min(F.coalesce("doc_id", F.lit(NO_DOC))).alias("doc"))
    tied = components(ties(shared_lists(first_shingles(docs, frequent))))
    clusters = written(tied.unionByName(tied.select(F.col("root").alias("node"), "root").distinct()).withColumnRenamed("root", "cluster"), "clusters")
    sizes = clusters.groupBy("cluster").agg(F.count("*").alias("size"))
    members = clusters.join(sizes, "cluster").join(nodes, "node")
    members = written(members.select("node", "cluster", "size", F.when(F.col("doc") != NO_DOC, F.col("doc")).alias("_doc")), "members")
    release(docs.sparkSession)
    sets = member_sets(docs, members)
    # a cluster of b blocks meets in b * (b + 1) / 2 tasks, each of two blocks at most
    blocks = F.ceil(F.col("size") / block)
    sets = sets.withColumn("_own", F.pmod(F.hash("node"), blocks)).withColumn("_other", F.explode(F.sequence(F.lit(0).cast("long"), blocks - 1)))
    met = sets.select("cluster", F.least("_own", "_other").alias("_i"), F.greatest("_own", "_other").alias("_j"), "node", "shingles")
    return met.groupBy("cluster", "_i", "_j").applyInArrow(_connect, "a long, b long")


def classes(docs: DataFrame, frequent: int = FREQUENT) -> DataFrame:
    """``doc_id, n_shingles, component_id``, one row per row of ``docs``."""
    rows = written(measured(docs), "shingled")
    joined = components(links(docs, rows, frequent_shingles(docs, frequent)))
    nodes = rows.where("n > 0").groupBy("node").agg(F.min(F.coalesce("doc_id", F.lit(NO_DOC))).alias("doc"))
    nodes = nodes.join(joined, "node", "left").withColumn("root", F.coalesce("root", "node"))
    least = nodes.groupBy("root").agg(F.min("doc").alias("component"))
    named = nodes.join(least, "root").select(F.col("node").alias("_node"), "component")
    out = rows.join(named, F.col("node") == F.col("_node"), "left")
    component = F.when(F.col("n") == 0, F.col("doc_id")).when(F.col("component") != NO_DOC, F.col("component"))
    return out.select("doc_id", F.col("n").alias("n_shingles"), component.alias("component_id"))


def keep_one(docs: DataFrame) -> DataFrame:
    """The rows of ``docs`` with the smallest ``doc_id`` of each class, all columns as they are."""
    kept = classes(docs).where("doc_id <=> component_id").select(F.col("doc_id").alias("_llm_doc")).distinct()
    return docs.join(kept, F.col("doc_id").cast("long").eqNullSafe(F.col("_llm_doc")), "left_semi")
