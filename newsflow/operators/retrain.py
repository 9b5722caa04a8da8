"""Training set, guard, fit, backup and purge of the return model."""

from __future__ import annotations

from pyspark.ml import Pipeline, PipelineModel
from pyspark.ml.functions import array_to_vector
from pyspark.ml.regression import GBTRegressor
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from newsflow.functions import scalars as S
from newsflow.operators.settle import DAY_MS


def training_window(memory: DataFrame, now: Column, ts: str = "timestamp", from_days: int = 180,
                    to_days: int = 90) -> DataFrame:
    """Settled rows from ``from_days`` (included) to ``to_days`` (left out) before ``now``."""
    t = F.col(ts)
    return memory.where(F.col("is_settled") & (t >= now - from_days * DAY_MS) & (t < now - to_days * DAY_MS))


def enough(rows: DataFrame, n: int = 100) -> bool:
    """True when there are at least ``n`` rows; reads no more than that many."""
    return rows.limit(n).count() >= n


def guarded(rows: DataFrame, n: int = 100) -> DataFrame:
    """The rows, or none of them when there are fewer than ``n``."""
    return rows if enough(rows, n) else rows.limit(0)


def training_set(rows: DataFrame, vector: str = "vector", label: str = "return_24h") -> DataFrame:
    """``features`` (score first, then the vector) and ``label``."""
    return rows.withColumn("features", S.feature_array(F.col("sentiment_score"), F.col(vector))).withColumn(
        "label", F.col(label).cast("double")
    )


def with_ml_vector(rows: DataFrame) -> DataFrame:
    return rows.withColumn("features", array_to_vector(F.col("features")))


def fit(train: DataFrame, trees: int = 200, depth: int = 6, rate: float = 0.05, seed: int = 42) -> PipelineModel:
    """Gradient-boosted squared-error regression."""
    model = GBTRegressor(
        featuresCol="features", labelCol="label", predictionCol="predicted_return", maxIter=trees,
        maxDepth=depth, stepSize=rate, lossType="squared", seed=seed,
    )
    return Pipeline(stages=[model]).fit(with_ml_vector(train).select("features", "label"))


def predict(model: PipelineModel, rows: DataFrame, vector: str = "vector") -> DataFrame:
    featured = rows.withColumn("features", S.feature_array(F.col("sentiment_score"), F.col(vector)))
    return model.transform(with_ml_vector(featured)).drop("features")


def retrain(memory: DataFrame, now_ms: int, model_path: str, backup_dir: str, *, key: str = "id",
            ts: str = "timestamp", label: str = "return_24h", min_rows: int = 100, **fit_options) -> DataFrame | None:
    """Backup, train, save; then the memory without the trained rows (None when too few rows).

    The caller publishes the returned frame, so nothing is removed before the model is saved.
    """
    from newsflow.sinks.tables import backup

    now = F.lit(now_ms).cast("bigint")
    window = training_window(memory, now, ts)
    if not enough(window, min_rows):
        return None
    path = backup(window, backup_dir, now_ms - 180 * DAY_MS, now_ms - 90 * DAY_MS)
    saved = memory.sparkSession.read.parquet(path)
    fit(training_set(saved, label=label), **fit_options).write().overwrite().save(model_path)
    return memory.join(saved.select(key), key, "left_anti").select(memory.columns)
