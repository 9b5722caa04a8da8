"""Filtered vector search as a join: exact, and approximate over k-means cells.

Both sides are cut into blocks; a task compares one block of queries with one block of memory by
a matrix product and hands on only its best ``k`` rows per query. Pairs are never written out, and
no group grows with the data: a hot partition value simply has more blocks.
"""

from __future__ import annotations

from collections.abc import Sequence
from functools import partial

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

# A bound compares a memory column with a query column, e.g. ("rsi_14", ">=", "rsi_floor").
Bound = tuple[str, str, str]
_COMPARE = {
    ">=": np.greater_equal,
    ">": np.greater,
    "<=": np.less_equal,
    "<": np.less,
    "==": np.equal,
    "!=": np.not_equal,
}
_RANK_DIGITS = 10  # similarities equal to this many digits are ties, broken by the memory id
_MATRIX_ROWS, _MATRIX_COLUMNS = 512, 4096  # of the products that are held at once, however large the blocks are
BLOCK_ROWS, BLOCK_VALUES = 1 << 16, 1 << 22  # a block of vectors ends at either
SPREAD, LEAST_ROWS = 16, 1024  # a side has so many blocks, unless they would be smaller than this or larger than allowed


def _unit_rows(vectors: pd.Series) -> np.ndarray:
    """Rows scaled to length one. Zero rows stay zero, so their similarity is 0."""
    m = np.array(vectors.tolist(), dtype=np.float64)
    norms = np.sqrt(np.einsum("ij,ij->i", m, m))[:, None]
    return m / np.where(norms > 0, norms, 1.0)


def _by_part(queries: pd.DataFrame) -> tuple[pd.DataFrame, np.ndarray, dict]:
    """Queries, their unit vectors, and their positions by partition value (an array of values asks for each of them)."""
    parts, at = queries["q_part"], np.arange(len(queries))
    if parts.dtype == object:
        parts, at = np.concatenate(parts.tolist()), np.repeat(at, parts.map(len))
    positions = pd.Series(at).groupby(np.asarray(parts)).indices
    return queries.drop(columns=["q_vec", "q_part"]), _unit_rows(queries["q_vec"]), {part: at[i] for part, i in positions.items()}


def _best(asked: tuple, memory: pd.DataFrame, k: int, bounds: Sequence[Bound]) -> pd.DataFrame | None:
    """The best ``k`` memory rows of each query within one pair of blocks, None when there are none."""
    queries, units, positions = asked
    memory = memory.sort_values("m_id", kind="stable", ignore_index=True)
    keep = [c for c in memory.columns if c not in ("m_vec", "m_part") and not c.startswith("mb_")]
    found, top = [], np.full((len(queries), k), -np.inf)  # of each query the best similarities so far
    for part, held in memory.groupby("m_part", sort=False).indices.items():
        if part not in positions:
            continue
        rows, right = memory.iloc[held], _unit_rows(memory["m_vec"].iloc[held])
        for start in range(0, len(positions[part]), _MATRIX_ROWS):
            at = positions[part][start:start + _MATRIX_ROWS]
            q, left, near = queries.iloc[at], units[at], []
            for first in range(0, len(held), _MATRIX_COLUMNS):
                m = rows.iloc[first:first + _MATRIX_COLUMNS]
                sim = left @ right[first:first + _MATRIX_COLUMNS].T
                i, j = _better(sim, q, m, bounds, top[at, -1])
                if i is None:
                    i, j = _top_cells(sim, _allowed(q, m, bounds, sim.shape), k)
                top[at] = _raised(top[at], i, sim[i, j])
                near.append((at[i], held[first + j], sim[i, j]))
            found.append(_nearest(near, k))
    if not found:
        return None
    who, hit, sim = _nearest(found, k)
    out = memory.loc[hit, keep].reset_index(drop=True)
    for i, c in enumerate(c for c in ("q_id", "q_key") if c in queries):
        out.insert(i, c, queries[c].to_numpy()[who])
    out["sim"] = sim
    return out


def _nearest(found: list[tuple[np.ndarray, np.ndarray, np.ndarray]], k: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The first ``k`` of each query among some ``(query, memory position, similarity)``; ties go to the lower position."""
    who, hit, sim = (np.concatenate(x) for x in zip(*found, strict=True))
    order = np.lexsort((hit, -np.round(sim, _RANK_DIGITS), who))
    who, hit, sim = who[order], hit[order], sim[order]
    first = np.arange(len(who)) - np.searchsorted(who, who, side="left") < k
    return who[first], hit[first], sim[first]


def _better(sim: np.ndarray, q: pd.DataFrame, m: pd.DataFrame, bounds: Sequence[Bound], least: np.ndarray) -> tuple:
    """Row and column numbers of the allowed cells that are not below their row's ``least``, or None twice when most cells
    may be such. Once ``k`` neighbours are known few are, and only these are compared with the bounds."""
    if not np.isfinite(least).all():
        return None, None
    near = sim >= (least - 2 * 10.0 ** -_RANK_DIGITS)[:, None]  # and those equal after rounding
    if np.count_nonzero(near) > 8 * _MATRIX_ROWS:
        return None, None
    i, j = np.nonzero(near)
    ok = np.ones(len(i), dtype=bool)
    for n, (_, op, _) in enumerate(bounds):
        ok &= _COMPARE[op](m[f"mb_{n}"].to_numpy()[j], q[f"qb_{n}"].to_numpy()[i])
    return i[ok], j[ok]


def _raised(top: np.ndarray, row: np.ndarray, sim: np.ndarray) -> np.ndarray:
    """The best similarities of each row, with others of the rows numbered ``row``, the greatest first."""
    if not len(row):
        return top
    order = np.lexsort((-sim, row))
    row, sim, k = row[order], sim[order], top.shape[1]
    place = np.arange(len(row)) - np.searchsorted(row, row, side="left")
    more = np.full(top.shape, -np.inf)
    more[row[place < k], place[place < k]] = sim[place < k]
    return -np.sort(-np.concatenate([top, more], axis=1), axis=1)[:, :k]


def _allowed(q: pd.DataFrame, m: pd.DataFrame, bounds: Sequence[Bound], shape) -> np.ndarray:
    ok = np.ones(shape, dtype=bool)
    for i, (_, op, _) in enumerate(bounds):
        ok &= _COMPARE[op](m[f"mb_{i}"].to_numpy()[None, :], q[f"qb_{i}"].to_numpy()[:, None])
    return ok


def _top_cells(sim: np.ndarray, ok: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Row and column numbers of the ``k`` best allowed cells of each row; ties go to the left."""
    score = np.where(ok, sim, -np.inf)
    width = score.shape[1]
    if width <= k:
        return np.nonzero(ok)
    least = np.partition(score, width - k, axis=1)[:, width - k, None]
    # a little below the k-th value, so that all cells equal to it after rounding are in
    rows, cols = np.nonzero(ok & (score >= least - 2 * 10.0 ** -_RANK_DIGITS))
    if len(rows) > 8 * k * len(score):  # a large group of copies: settle the ties in place
        score = np.round(score, _RANK_DIGITS)
        least = np.partition(score, width - k, axis=1)[:, width - k, None]
        above, tied = ok & (score > least), ok & (score == least)
        room = k - above.sum(axis=1, keepdims=True)
        return np.nonzero(above | (tied & (np.cumsum(tied, axis=1, dtype=np.int32) <= room)))
    order = np.lexsort((cols, -np.round(score[rows, cols], _RANK_DIGITS), rows))
    rows, cols = rows[order], cols[order]
    first = np.arange(len(rows)) - np.searchsorted(rows, rows, side="left") < k
    return rows[first], cols[first]


def _score_blocks(q: pd.DataFrame, m: pd.DataFrame, *, k: int, bounds, columns) -> pd.DataFrame:
    hits = None if q.empty or m.empty else _best(_by_part(q), m, k, bounds)
    return pd.DataFrame(columns=columns) if hits is None else hits[columns]


def _blocks(vec: str, block_rows: int) -> Column:
    """The number of blocks for some rows: ``SPREAD`` of them as long as their size allows, so copies grow with the rows."""
    n, values = F.count(F.lit(1)), F.coalesce(F.sum(F.size(vec)), F.lit(0))
    return F.greatest(F.ceil(n / block_rows), F.ceil(values / BLOCK_VALUES), F.least(F.lit(SPREAD), F.ceil(n / LEAST_ROWS)), F.lit(1))


def _sizes(rows: DataFrame, part: str, vec: str, blocks: str, block_rows: int) -> DataFrame:
    """The number of blocks of each partition value, as a frame."""
    return rows.groupBy(F.col(part).alias("_part")).agg(_blocks(vec, block_rows).alias(blocks))


def _block_of(ident: str, blocks: Column) -> Column:
    return F.pmod(F.xxhash64(ident), blocks)


def query_key(q_vec: str, part: str | None = None, bounds: Sequence[Bound] = ()) -> Column:
    """Tells query rows of one id apart: a hash of the vector, the partition value and the bounds."""
    return F.xxhash64(q_vec, *([part] if part else []), *[b[2] for b in bounds])


def knn_join(queries: DataFrame, memory: DataFrame, k: int, *, q_id: str, m_id: str, q_vec: str,
             m_vec: str, part: tuple[str, str] | None = None, bounds: Sequence[Bound] = (),
             carry: Sequence[str] = (), block_rows: int = BLOCK_ROWS) -> DataFrame:
    """The ``k`` most cosine-similar memory rows of each query: ``q_id, q_key, m_id, sim, rank`` + ``carry``.

    ``part`` names an equality between a query and a memory column; ``bounds`` are further
    comparisons. All of them hold before the ranking, so no valid neighbour is lost. Equal
    similarities rank by memory id. Every query row has its own neighbours: rows of one ``q_id`` that differ
    in vector, partition value or bounds have different ``q_key`` (see ``query_key``), copies are searched
    once. Nothing runs while the search is being built.
    """
    keyed = queries.withColumn("_key", query_key(q_vec, part and part[0], bounds))
    return top_k(_winners(keyed, memory, k, q_id, m_id, q_vec, m_vec, part, bounds, carry, block_rows), k)


def _winners(queries: DataFrame, memory: DataFrame, k: int, q_id: str, m_id: str, q_vec: str, m_vec: str, part: tuple[str, str] | None,
             bounds: Sequence[Bound], carry: Sequence[str], block_rows: int) -> DataFrame:
    """The best ``k`` rows of each query within each pair of blocks.

    A query's partition column may be an array of the values it asks for. Such values share blocks: a query goes once to
    each block that holds one of them, not once for each value.
    """
    q_part, m_part = part if part else (None, None)
    several = bool(part) and isinstance(queries.schema[q_part].dataType, T.ArrayType)
    q = queries.where(F.col(q_vec).isNotNull()).select(
        F.col(q_id).alias("q_id"),
        F.col("_key").alias("q_key"),
        F.col(q_vec).alias("q_vec"),
        (F.col(q_part) if several else (F.col(q_part) if q_part else F.lit(0)).cast("bigint")).alias("q_part"),
        *[F.col(b[2]).alias(f"qb_{i}") for i, b in enumerate(bounds)],
    )
    m = memory.where(F.col(m_vec).isNotNull()).select(
        F.col(m_id).alias("m_id"),
        F.col(m_vec).alias("m_vec"),
        (F.col(m_part) if m_part else F.lit(0)).cast("bigint").alias("m_part"),
        *[F.col(b[0]).alias(f"mb_{i}") for i, b in enumerate(bounds)],
        *[F.col(f"`{c}`") for c in carry],
    )
    q, m = q.dropna(subset=[c for c in q.columns if c != "q_vec"]), m.dropna(
        subset=["m_id", "m_part"] + [f"mb_{i}" for i in range(len(bounds))]
    )
    out = T.StructType(
        [T.StructField("q_id", q.schema["q_id"].dataType), T.StructField("q_key", T.LongType()), T.StructField("m_id", m.schema["m_id"].dataType)]
        + [T.StructField(c, m.schema[c].dataType) for c in carry]
        + [T.StructField("sim", T.DoubleType())]
    )
    columns = out.fieldNames()

    same = ["q_id", "q_key"] if several else ["q_id", "q_key", "q_part"]
    fields = [c for c in q.columns if c not in same]
    q = q.groupBy(*same).agg(F.min(F.struct(*fields)).alias("_q")).select(*same, "_q.*")
    number = lambda rows, vec: rows.agg(_blocks(vec, block_rows)).scalar()
    if several:  # the values are dealt into as many bundles as there are blocks of memory
        bundles = number(memory.where(F.col(m_vec).isNotNull()), m_vec)
        m = m.withColumn("_n", bundles).withColumn("_part", F.pmod("m_part", "_n")).drop("_n")
        bundled = F.explode(F.array_distinct(F.transform("q_part", lambda v: F.pmod(v, F.col("_n")))))
        q = q.withColumn("_n", bundles).withColumn("_part", bundled)
        q = q.withColumn("q_part", F.filter("q_part", lambda v: F.pmod(v, F.col("_n")) == F.col("_part"))).drop("_n")
    else:
        q, m = q.withColumn("_part", F.col("q_part")), m.withColumn("_part", F.col("m_part"))
    if part:
        blocks = _sizes(q, "_part", "q_vec", "_q_blocks", block_rows).join(_sizes(m, "_part", "m_vec", "_m_blocks", block_rows), "_part")
        sized = lambda rows: rows.join(F.broadcast(blocks) if several else blocks, "_part")
    else:  # two numbers, read as scalar subqueries
        sized = lambda rows: rows.withColumn("_q_blocks", number(q, "q_vec")).withColumn("_m_blocks", number(m, "m_vec"))
    every = lambda n: F.explode(F.sequence(F.lit(0).cast("bigint"), F.col(n) - 1))
    left = (
        sized(q).withColumnRenamed("_part", "_p")
        .withColumn("_qb", _block_of("q_id", F.col("_q_blocks"))).withColumn("_mb", every("_m_blocks")).drop("_q_blocks", "_m_blocks")
    )
    right = (
        sized(m).withColumnRenamed("_part", "_p")
        .withColumn("_mb", _block_of("m_id", F.col("_m_blocks"))).withColumn("_qb", every("_q_blocks")).drop("_q_blocks", "_m_blocks")
    )
    keys = ["_p", "_mb", "_qb"]
    return left.groupBy(*keys).cogroup(right.groupBy(*keys)).applyInPandas(
        partial(_score_blocks, k=k, bounds=tuple(bounds), columns=columns), out
    )


def top_k(hits: DataFrame, k: int) -> DataFrame:
    """Rank the local winners. Spark cuts each group to ``k`` before the shuffle."""
    best = Window.partitionBy("q_id", "q_key").orderBy(F.round("sim", _RANK_DIGITS).desc(), "m_id")
    return hits.withColumn("rank", F.row_number().over(best)).where(F.col("rank") <= k)


# ---- approximate search ---------------------------------------------------------------------

def fit_cells(memory: DataFrame, vec: str, nlist: int = 128, seed: int = 42, max_iter: int = 20) -> list[list[float]]:
    """Centres of ``nlist`` k-means cells over unit vectors (``nlist`` rows, whatever the data)."""
    from pyspark.ml.clustering import KMeans
    from pyspark.ml.functions import array_to_vector
    from pyspark.ml.feature import Normalizer

    rows = memory.where(F.col(vec).isNotNull()).select(array_to_vector(F.col(vec)).alias("raw"))
    unit = Normalizer(inputCol="raw", outputCol="features").transform(rows).select("features")
    model = KMeans(k=nlist, seed=seed, maxIter=max_iter).fit(unit)
    return [c.tolist() for c in model.clusterCenters()]


def nearest_cells(vec: Column, centres: list[list[float]], n: int) -> Column:
    """The ``n`` cells whose centres are nearest to the unit vector, as an array of cell numbers."""
    c = np.array(centres)
    half_norms = 0.5 * np.einsum("ij,ij->i", c, c)

    @F.pandas_udf(T.ArrayType(T.LongType()))
    def pick(vectors: pd.Series) -> pd.Series:
        dist = half_norms[None, :] - _unit_rows(vectors) @ c.T
        return pd.Series(list(np.argsort(dist, axis=1, kind="stable")[:, :n]))

    return pick(vec)


def knn_ivf(queries: DataFrame, memory: DataFrame, k: int, *, q_id: str, m_id: str, q_vec: str,
            m_vec: str, nlist: int = 128, nprobe: int = 10, seed: int = 42,
            centres: list[list[float]] | None = None, carry: Sequence[str] = (),
            bounds: Sequence[Bound] = (), **options) -> DataFrame:
    """Approximate ``knn_join``: each query searches the ``nprobe`` nearest of ``nlist`` cells.

    Every candidate in those cells is compared exactly; ``nprobe = nlist`` gives the exact answer.
    """
    centres = centres or fit_cells(memory, m_vec, nlist, seed)
    m = memory.where(F.col(m_vec).isNotNull()).withColumn("_cell", nearest_cells(F.col(m_vec), centres, 1)[0])
    q = queries.where(F.col(q_vec).isNotNull()).withColumn("_cells", nearest_cells(F.col(q_vec), centres, nprobe))
    return search_cells(q, m, k, q_id=q_id, m_id=m_id, q_vec=q_vec, m_vec=m_vec, carry=carry, bounds=bounds, **options)


def search_cells(queries: DataFrame, memory: DataFrame, k: int, *, q_id: str, m_id: str, q_vec: str, m_vec: str,
                 carry: Sequence[str] = (), bounds: Sequence[Bound] = (), block_rows: int = BLOCK_ROWS) -> DataFrame:
    """``knn_join`` between queries with the array ``_cells`` they probe and memory rows of a ``_cell``; the blocks'
    winners are ranked once."""
    keyed = queries.withColumn("_key", query_key(q_vec, None, bounds))
    return top_k(_winners(keyed, memory, k, q_id, m_id, q_vec, m_vec, ("_cells", "_cell"), bounds, carry, block_rows), k)
