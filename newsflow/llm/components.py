"""Connected components of an edge list by alternating stars.

Every round points a node's larger neighbours, then its smaller ones, at the smallest node it knows.
Each round is two sums by key and their joins; its edges are written, so nothing before it runs again.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from newsflow.session import written


def components(edges: DataFrame) -> DataFrame:
    """``node, root`` for every node of ``edges`` (``a, b``, both long) but the roots themselves."""
    now = written(edges.where("a <> b").select(F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")).distinct(), "edges")
    state = _state(now)
    while True:
        both = now.unionByName(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        least = both.groupBy("a").agg(F.min("b").alias("_m")).select(F.col("a").alias("_a"), F.least("a", "_m").alias("_m"))
        large = both.where("b > a").join(least, F.col("a") == F.col("_a")).select(F.col("b").alias("a"), F.col("_m").alias("b"))
        large = written(large.where("a <> b").distinct(), "edges")
        least = large.groupBy("a").agg(F.min("b").alias("_m")).select(F.col("a").alias("_a"), "_m")
        small = large.join(least, F.col("a") == F.col("_a"))
        small = small.select(F.col("b").alias("a"), F.col("_m").alias("b")).unionByName(least.select(F.col("_a").alias("a"), F.col("_m").alias("b")))
        now = written(small.where("a <> b").distinct(), "edges")
        before, state = state, _state(now)
        if state == before:
            return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _state(edges: DataFrame) -> tuple:
    return tuple(edges.agg(F.count("*"), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first())
