"""K-means over reduced vectors, the fallback for noisy large data."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.ml.clustering import KMeans
from pyspark.ml.functions import array_to_vector
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.settings import Settings


def kmeans_labels(points: DataFrame, k: int, settings: Settings) -> DataFrame:
    """row_id, topic_id: the best of ``kmeans_restarts`` seeded runs by total cost."""
    rows = points.select("row_id", array_to_vector("vec").alias("features"))
    rows = rows.persist(StorageLevel.MEMORY_AND_DISK)
    models = [
        KMeans(k=k, seed=settings.seed + i, featuresCol="features", predictionCol="topic_id").fit(rows)
        for i in range(settings.kmeans_restarts)
    ]
    best = min(models, key=lambda model: model.summary.trainingCost)
    labels = best.transform(rows).select("row_id", F.col("topic_id").cast("int").alias("topic_id"))
    return labels
