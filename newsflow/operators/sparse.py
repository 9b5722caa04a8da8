"""Search over sparse vectors by inverted slot lists with upper bounds.

A vector is one row ``(id, slots, units)`` of its non-zero slots; all weights are at least zero and a vector has length
one. Both sides are cut into blocks. A task turns a block of stored vectors into slot lists and follows, for each query,
the lists of its slots, those with the largest possible share first. Once what is left of the query cannot lift
another vector to the k best, no further list is read: the few vectors that still can get there are completed from
their own rows. Vectors never meet as pairs of dense rows, and only a block's best leave the task.
"""

from __future__ import annotations

from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

RANK_DIGITS = 10  # similarities equal to this many digits are ties, broken by the id
BLOCK_ROWS = 2048  # vectors of a block
LOOK_EVERY = 4  # lists read between two looks at the bounds
_SLACK = 1e-9  # sums in another order differ by less


def word_slots(text: Column, dim: int) -> Column:
    """The slot of every word of ``text``, as an array; words lie between spaces, tabs and line ends."""
    words = F.filter(F.split(text, "[ \t\r\n]+"), lambda w: w != "")
    return F.transform(words, lambda w: F.conv(F.substring(F.md5(w), 1, 8), 16, 10).cast("bigint") % dim)


def hashed_words(rows: DataFrame, ident: str, text: str, dim: int) -> DataFrame:
    """Bags of words as ``id, slots, units``; rows that repeat an id are one text, texts without words give no rows.

    Weights are counts scaled to length one in single precision, as a stored vector holds them. Words are counted within
    their row, so no sort or aggregate holds a row per word.
    """
    slots = F.transform(word_slots(F.col(text), dim), lambda s: s.cast("int"))
    bags = rows.select(F.col(ident).alias("id"), slots.alias("_bag")).where(F.size("_bag") > 0)
    ordered = bags.groupBy("id").agg(F.sort_array(F.flatten(F.collect_list("_bag"))).alias("_bag"))
    let = lambda value, use: F.get(F.transform(F.array(value), use), 0)  # noqa: E731  # evaluates the value once
    last = lambda bag, n: F.filter(F.sequence(F.lit(1), n), lambda i: (i == n) | (F.get(bag, i - 1) != F.get(bag, i)))
    ends = let(F.struct(F.col("_bag").alias("bag"), F.size("_bag").alias("n")), lambda x: last(x["bag"], x["n"]))  # of the runs of each slot
    runs = lambda ends: F.transform(ends, lambda e, i: (e - F.coalesce(F.get(ends, i - 1), F.lit(0))).cast("long"))
    norm = lambda c, zero: F.sqrt(F.aggregate(c, zero, lambda sofar, x: sofar + x * x))
    weights = lambda ns: let(norm(ns, F.lit(0).cast("long")), lambda length: F.transform(ns, lambda n: (n / length).cast("float").cast("double")))
    units = lambda ws: let(norm(ws, F.lit(0.0)), lambda length: F.transform(ws, lambda w: w / length))
    both = let(ends, lambda at: F.struct(F.transform(at, lambda e: F.get("_bag", e - 1)).alias("slots"), let(let(runs(at), weights), units).alias("units")))
    return ordered.select("id", F.inline(F.array(both)))


class SlotLists:
    """A block of stored vectors: by slot for the search, by vector to complete what it finds."""

    def __init__(self, rows: pd.DataFrame) -> None:
        ids, vector = np.unique(rows["id"].to_numpy(), return_inverse=True)
        slots, slot = np.unique(rows["slot"].to_numpy(), return_inverse=True)
        unit = rows["unit"].to_numpy()
        self.ids, self.place = ids, {s: i for i, s in enumerate(slots.tolist())}
        order = np.argsort(slot, kind="stable")
        self.vectors, self.units = vector[order], unit[order]
        self.ends = np.searchsorted(slot[order], np.arange(len(slots) + 1))
        self.tops = np.maximum.reduceat(self.units, self.ends[:-1])
        own = np.argsort(vector, kind="stable")
        self.own_slots, self.own_units = slot[own], unit[own]
        self.own_ends = np.searchsorted(vector[own], np.arange(len(ids) + 1))

    def search(self, slots: np.ndarray, units: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray, int]:
        """Positions in ``ids`` and similarities of the best ``k``, and how many list entries were read."""
        held = [(self.place[s], u) for s, u in zip(slots.tolist(), units.tolist(), strict=True) if s in self.place]
        known, shares = np.array([s for s, _ in held], np.int64), np.array([u for _, u in held])
        bounds = shares * self.tops[known]
        order = np.argsort(-bounds, kind="stable")
        known, shares, bounds = known[order], shares[order], bounds[order]
        starts, stops = self.ends[known].tolist(), self.ends[known + 1].tolist()
        rest = np.cumsum(bounds[::-1])[::-1]  # most that the lists from here on can add
        unread = np.cumsum((self.ends[known + 1] - self.ends[known])[::-1])[::-1]
        sims, read = np.zeros(len(self.ids)), 0
        for i, u in enumerate(shares.tolist()):
            if i and i % LOOK_EVERY == 0 and len(sims) > k:
                least = float(np.partition(sims, len(sims) - k)[len(sims) - k])
                if rest[i] < least:  # what no list has shown so far cannot reach the best any more
                    able = np.flatnonzero(sims + rest[i] >= least - _SLACK)
                    if (self.own_ends[able + 1] - self.own_ends[able]).sum() < unread[i]:
                        return *self._best(able, self._complete(able, known, shares), k), read
            at = slice(starts[i], stops[i])
            sims[self.vectors[at]] += u * self.units[at]
            read += stops[i] - starts[i]
        able = np.flatnonzero(sims)
        return *self._best(able, sims[able], k), read

    def _complete(self, able: np.ndarray, known: np.ndarray, shares: np.ndarray) -> np.ndarray:
        """The whole similarities of some vectors, from their own rows."""
        asked = np.zeros(len(self.place))
        asked[known] = shares
        sizes = self.own_ends[able + 1] - self.own_ends[able]
        at = np.repeat(self.own_ends[able] - np.cumsum(sizes) + sizes, sizes) + np.arange(sizes.sum())
        return np.add.reduceat(asked[self.own_slots[at]] * self.own_units[at], np.cumsum(sizes) - sizes)

    @staticmethod
    def _best(able: np.ndarray, sims: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
        order = np.lexsort((able, -np.round(sims, RANK_DIGITS)))[:k]
        return able[order], sims[order]


def _search_blocks(asked: pd.DataFrame, rows: pd.DataFrame, *, k: int) -> pd.DataFrame:
    out: dict[str, list] = {"q_id": [], "m_id": [], "sim": []}
    asked = asked[asked["id"].notna()]
    if len(asked) and len(rows):
        flat = {"id": np.repeat(rows["id"].to_numpy(), rows["slots"].map(len)), "slot": np.concatenate(rows["slots"].tolist()), "unit": np.concatenate(rows["units"].tolist())}
        lists = SlotLists(pd.DataFrame(flat))
        for ident, slots, units in zip(asked["id"], asked["slots"], asked["units"], strict=True):
            found, sims, _ = lists.search(np.asarray(slots), np.asarray(units), k)
            out["q_id"] += [ident] * len(found)
            out["m_id"] += lists.ids[found].tolist()
            out["sim"] += sims.tolist()
    return pd.DataFrame(out)


def top_k(queries: DataFrame, memory: DataFrame, k: int, block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The ``k`` most cosine-similar stored vectors of each query: ``q_id, m_id, sim, rank``.

    Both sides hold ``id, slots, units``, a row per id; pass written frames, both are read twice. Vectors that share no slot
    with a query are never its neighbours. Equal similarities rank by the stored id.
    """
    blocks = lambda rows: rows.agg(F.greatest(F.ceil(F.count("id") / block_rows), F.lit(1))).scalar()
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), n - 1))
    sized = lambda rows: rows.withColumn("_nq", blocks(queries)).withColumn("_nm", blocks(memory))
    of = lambda n: F.pmod(F.xxhash64("id"), F.col(n))
    left = sized(queries).select("id", "slots", "units", of("_nq").alias("_qb"), every(F.col("_nm")).alias("_mb"))
    right = sized(memory).select("id", "slots", "units", of("_nm").alias("_mb"), every(F.col("_nq")).alias("_qb"))
    out = T.StructType([T.StructField("q_id", queries.schema["id"].dataType), T.StructField("m_id", memory.schema["id"].dataType), T.StructField("sim", T.DoubleType())])
    hits = left.groupBy("_mb", "_qb").cogroup(right.groupBy("_mb", "_qb")).applyInPandas(partial(_search_blocks, k=k), out)
    best = Window.partitionBy("q_id").orderBy(F.round("sim", RANK_DIGITS).desc(), "m_id")
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)
