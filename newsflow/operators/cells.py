"""Vector memory stored by cells, for approximate search that reads only the cells it probes.

Below ``root``: ``centres`` (cell, centre), ``settings`` (how many cells a search probes, and the recall
measured for it) and ``rows/batch_id=<n>/cell=<c>`` with the stored rows. Centres are fitted once, on a bounded
sample; every row is given its cell when it is appended. ``settings`` is written last and makes the table ready.
"""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pandas as pd
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.operators import knn
from newsflow.sinks.tables import read_or_empty

CENTRES = T.StructType([T.StructField("cell", T.LongType()), T.StructField("centre", T.ArrayType(T.DoubleType()))])
SETTINGS = T.StructType([T.StructField("nprobe", T.LongType()), T.StructField("recall", T.DoubleType())])
NLIST = 128
SAMPLE_ROWS = 32_768  # the centres are fitted on at most so many rows
ASKED_ROWS = 256  # and the probes are chosen by so many
TARGET = 0.95
FILE_ROWS = 1 << 20  # a cell of more rows is written by several tasks


def sample(rows: DataFrame, ident: str, n: int) -> DataFrame:
    """At most ``n`` rows, the same ones on every call: those whose hash is smallest."""
    return rows.orderBy(F.xxhash64(ident), ident).limit(n)


def centres_of(spark: SparkSession, root: str) -> np.ndarray:
    """All centres, one row per cell; their number is fixed when the table is made."""
    found = read_or_empty(spark, f"{root}/centres", CENTRES).orderBy("cell").collect()
    return np.array([r["centre"] for r in found])


def settings(spark: SparkSession, root: str) -> tuple[int, float] | None:
    """Cells to probe and the recall measured with them; None while the table is not ready."""
    row = read_or_empty(spark, f"{root}/settings", SETTINGS).first()
    return None if row is None else (row["nprobe"], row["recall"])


def create(memory: DataFrame, root: str, ident: str, vec: str, nlist: int = NLIST, seed: int = 42) -> None:
    """Fits and stores the centres."""
    spark = memory.sparkSession
    fitted = knn.fit_cells(sample(memory.where(F.col(vec).isNotNull()).select(ident, vec), ident, SAMPLE_ROWS), vec, nlist, seed)
    spark.createDataFrame(list(enumerate(fitted)), CENTRES).coalesce(1).write.mode("overwrite").parquet(f"{root}/centres")


def append(rows: DataFrame, root: str, batch_id: int, ident: str, vec: str) -> None:
    """Writes the rows of a batch into their cells; a batch that runs again replaces itself.

    Rows without a vector get the cell -1. A cell's rows are dealt over as many tasks as its size asks for, so a
    hot cell overloads none, and a small one stays one file.
    """
    centres = centres_of(rows.sparkSession, root)
    given = F.coalesce(F.col(vec), F.array_repeat(F.lit(0.0), centres.shape[1]).cast("array<float>"))  # Python sees every row
    cell = F.when(F.col(vec).isNull(), F.lit(-1).cast("bigint")).otherwise(knn.nearest_cells(given, centres, 1)[0])
    placed = rows.withColumn("cell", cell)
    parts = F.greatest(F.lit(1), F.ceil(F.lit(rows.count() / FILE_ROWS)))
    dealt = placed.repartition(F.col("cell"), F.pmod(F.xxhash64(ident), parts))
    dealt.write.mode("overwrite").partitionBy("cell").parquet(f"{root}/rows/batch_id={batch_id}")


def stored(spark: SparkSession, root: str, schema: T.StructType) -> DataFrame:
    """All stored rows with their ``cell``, which is a partition of the files."""
    return read_or_empty(spark, f"{root}/rows", T.StructType([*schema.fields, T.StructField("batch_id", T.LongType()), T.StructField("cell", T.LongType())])).drop("batch_id")


def recall_by_probes(queries: DataFrame, memory: DataFrame, centres: np.ndarray, k: int, names: dict[str, str], **options) -> np.ndarray:
    """Share of the exact ``k`` neighbours that lie in the 1, 2, ... nearest cells of their query."""
    exact = knn.knn_join(queries, memory, k, **names, carry=["cell"], **options).select("q_id", "q_key", "cell")
    order = queries.select(F.col(names["q_id"]).alias("q_id"), F.posexplode(knn.nearest_cells(F.col(names["q_vec"]), centres, len(centres))).alias("probe", "cell"))
    hits = exact.join(order, ["q_id", "cell"]).groupBy("probe").count().collect()
    found = np.zeros(len(centres))
    for r in hits:
        found[r["probe"]] = r["count"]
    return np.cumsum(found) / max(found.sum(), 1)


def calibrate(spark: SparkSession, root: str, schema: T.StructType, k: int, ident: str, vec: str, target: float = TARGET, **options) -> tuple[int, float]:
    """Chooses the fewest probes whose recall reaches ``target``, over a bounded sample of stored rows searched exactly."""
    memory = stored(spark, root, schema)
    asked = sample(memory.where(F.col(vec).isNotNull()), ident, ASKED_ROWS).drop("cell")
    curve = recall_by_probes(asked, memory, centres_of(spark, root), k, {"q_id": ident, "m_id": ident, "q_vec": vec, "m_vec": vec}, **options)
    nprobe = int(np.argmax(curve >= target)) + 1 if len(curve) and curve[-1] >= target else max(len(curve), 1)
    found = (nprobe, float(curve[nprobe - 1]) if len(curve) else 1.0)
    spark.createDataFrame([found], SETTINGS).coalesce(1).write.mode("overwrite").parquet(f"{root}/settings")
    return found


def search(queries: DataFrame, root: str, schema: T.StructType, k: int, *, q_id: str, m_id: str, q_vec: str, m_vec: str,
           nprobe: int | None = None, where: Column | None = None, carry: Sequence[str] = (), bounds: Sequence[knn.Bound] = (), **options) -> DataFrame:
    """Approximate ``knn_join`` over the stored rows (those that ``where`` selects): ``q_id, q_key, m_id, sim, rank`` + ``carry``.

    Each query meets the rows of its ``nprobe`` nearest cells, by default as many as were found to be needed. The
    probed cells, at most all there are, are broadcast and prune the scan's partitions while it runs.
    """
    spark = queries.sparkSession
    centres = centres_of(spark, root)
    if nprobe is None:
        ready = settings(spark, root)
        if ready is None:
            raise ValueError(f"no search settings below {root}")
        nprobe = ready[0]
    asked = queries.where(F.col(q_vec).isNotNull()).withColumn("_cells", knn.nearest_cells(F.col(q_vec), centres, nprobe))
    probed = asked.select(F.explode("_cells").alias("cell")).distinct().where(F.col("cell") >= 0)
    memory = stored(spark, root, schema)
    memory = memory.join(F.broadcast(probed), "cell", "left_semi")
    if where is not None:
        memory = memory.where(where)
    return knn.search_cells(asked, memory.withColumnRenamed("cell", "_cell"), k,
                            q_id=q_id, m_id=m_id, q_vec=q_vec, m_vec=m_vec, carry=carry, bounds=bounds, **options)


def recall(found: pd.DataFrame, exact: pd.DataFrame) -> float:
    """Share of the exact neighbours ``(q_id, m_id)`` that were found."""
    want = set(map(tuple, exact[["q_id", "m_id"]].to_numpy().tolist()))
    return len(want & set(map(tuple, found[["q_id", "m_id"]].to_numpy().tolist()))) / max(len(want), 1)
