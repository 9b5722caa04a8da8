"""One row per key, and the upsert, replace and purge built on it.

``min_by``/``max_by`` combine on the map side, so a key that holds a third of all rows sends one
row per map task into the shuffle.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F


def _one_per_key(rows: DataFrame, keys: list[str], order: list[str], pick) -> DataFrame:
    rest = [c for c in rows.columns if c not in keys]
    by = F.struct(*order)  # never null, so a key whose order is unknown still keeps a row
    return (
        rows.groupBy(*keys)
        .agg(pick(F.struct(*[F.col(f"`{c}`") for c in rest]), by).alias("_row"))
        .select(*keys, "_row.*")
        .select(*[f"`{c}`" for c in rows.columns])
    )


def latest_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """Last write wins. ``order`` must be unique within a key."""
    return _one_per_key(rows, keys, order, F.max_by)


def first_per_key(rows: DataFrame, keys: list[str], order: list[str]) -> DataFrame:
    """First sighting wins. ``order`` must be unique within a key."""
    return _one_per_key(rows, keys, order, F.min_by)


def last_n(rows: DataFrame, keys: list[str], ts: str, n: int) -> DataFrame:
    """The newest ``n`` rows of each key. Spark limits the groups before the shuffle."""
    newest = Window.partitionBy(*keys).orderBy(F.col(ts).desc())
    return rows.withColumn("_rn", F.row_number().over(newest)).where(F.col("_rn") <= n).drop("_rn")


def upsert(base: DataFrame, changes: DataFrame, keys: list[str], order: list[str] | None = None) -> DataFrame:
    """``base`` with whole rows replaced or added from ``changes``.

    ``order`` reduces several changes of one key to the last one first.
    """
    new = changes if order is None else latest_per_key(changes, keys, order)
    new = new.select(base.columns)
    return base.join(new.select(keys), keys, "left_anti").select(base.columns).unionByName(new)


def purge(base: DataFrame, ids: DataFrame, key: str) -> DataFrame:
    return base.join(ids.select(key).distinct(), key, "left_anti").select(base.columns)
