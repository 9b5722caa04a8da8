"""Versions of the return model in a folder, and scoring by the newest one.

Below ``root``: ``model/v=<n>`` the fitted pipelines, ``versions`` one row per published version. The row is written
after its model, so a version that can be found can be loaded; a try that stopped before is overwritten.
"""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from newsflow.functions import scalars as S
from newsflow.operators.retrain import with_ml_vector
from newsflow.sinks.tables import read_or_empty

VERSIONS = T.StructType(
    [T.StructField("version", T.LongType()), T.StructField("width", T.LongType()), T.StructField("backup", T.StringType())]
)


def latest(spark: SparkSession, root: str) -> Row | None:
    """Row of the newest published version; None before the first."""
    return read_or_empty(spark, f"{root}/versions", VERSIONS).orderBy(F.desc("version")).first()


def publish(model: PipelineModel, root: str, version: int, backup: str | None = None) -> None:
    """Save the model, then make it the newest version. ``backup`` is where its training rows are kept."""
    model.write().overwrite().save(f"{root}/model/v={version}")
    row = [(version, model.stages[-1].numFeatures, backup)]
    SparkSession.active().createDataFrame(row, VERSIONS).coalesce(1).write.mode("append").parquet(f"{root}/versions")


class Loaded:
    """The newest model of a folder, loaded again only when a newer version is there."""

    def __init__(self, root: str) -> None:
        self.root = root
        self.held: tuple[Row, PipelineModel] | None = None

    def current(self, spark: SparkSession) -> tuple[Row, PipelineModel] | None:
        row = latest(spark, self.root)
        if row is not None and (self.held is None or self.held[0]["version"] != row["version"]):
            self.held = row, PipelineModel.load(f"{self.root}/model/v={row['version']}")
        return self.held


def predict(current: tuple[Row, PipelineModel] | None, rows: DataFrame, vector: str = "vector") -> DataFrame:
    """``rows`` with ``predicted_return`` and ``model_version``.

    Without a model both are null. A row whose score or vector is missing, holds a null or has another width than the
    model's has no prediction, but is kept.
    """
    nothing = {"predicted_return": F.lit(None).cast("double"), "model_version": F.lit(None).cast("bigint")}
    if current is None:
        return rows.withColumns(nothing)
    row, model = current
    features = S.feature_array(F.col("sentiment_score"), F.col(vector))
    usable = F.coalesce((F.size(features) == row["width"]) & ~F.exists(features, lambda x: x.isNull()), F.lit(False))
    blank = F.array_repeat(F.lit(0.0), row["width"])
    asked = rows.withColumn("_usable", usable).withColumn("features", F.when(F.col("_usable"), features).otherwise(blank))
    scored = model.transform(with_ml_vector(asked))
    return scored.select(
        *[f"`{c}`" for c in rows.columns],
        F.when(F.col("_usable"), F.col("predicted_return")).alias("predicted_return"),
        F.lit(row["version"]).cast("bigint").alias("model_version"),
    )
