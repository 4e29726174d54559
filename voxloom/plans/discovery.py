"""Topic discovery: parameters by size, reduction, density clustering, fallback, keywords, names."""

from __future__ import annotations

import time
from dataclasses import dataclass

from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.functions.params import fallback_k, needs_fallback, size_params
from voxloom.operators.density import density_cluster
from voxloom.operators.keywords import ctfidf, topic_table
from voxloom.operators.kmeans import kmeans_labels
from voxloom.operators.layout import layout
from voxloom.operators.lookup import labelled_texts, settled
from voxloom.operators.reduction import reduced
from voxloom.session import cut_lineage
from voxloom.settings import Settings


@dataclass(frozen=True)
class TopicResult:
    """labels: row_id, topic_id. keywords: topic_id, rank, term, score. topics: one row per topic.
    params: one row."""

    labels: DataFrame
    keywords: DataFrame
    topics: DataFrame
    params: DataFrame
    engine: str
    model: str
    runtime_sec: float


def run_params(labels: DataFrame, settings: Settings) -> DataFrame:
    """One row: parameters for this many comments, whether their noise asks for the fallback, its k."""
    figures = labels.agg(
        F.count("*").alias("n"), F.avg((F.col("topic_id") == -1).cast("double")).alias("noise_rate")
    )
    return figures.select(
        size_params(F.col("n"), settings).alias("p"),
        needs_fallback(F.col("n"), F.col("noise_rate"), settings).alias("kmeans_fallback"),
        fallback_k(F.col("n")).alias("fallback_k"),
        "noise_rate",
    ).select("p.*", "kmeans_fallback", "fallback_k", "noise_rate")


def reduced_by(vectors: DataFrame, n: int, neighbours: int, settings: Settings) -> DataFrame:
    """row_id, vec: few dimensions, by the reducer that the settings name. vec may be given as an ml vector."""
    if settings.reducer == "umap":
        if isinstance(vectors.schema["vec"].dataType, VectorUDT):
            vectors = vectors.withColumn("vec", vector_to_array("vec", "float32"))
        return layout(vectors, neighbours, settings)
    if settings.reducer == "pca":
        return reduced(vectors, n, settings)
    raise ValueError(f"no reducer is named {settings.reducer!r}")


def discover(comments: DataFrame, vectors: DataFrame, settings: Settings, model: str) -> TopicResult:
    """comments: row_id, cleaned_text. vectors: row_id, vec (an array, or an ml vector)."""
    started = time.time()
    n = vectors.count()
    sized = comments.sparkSession.range(1).select(size_params(F.lit(n), settings).alias("p")).first()["p"]
    points = cut_lineage(reduced_by(vectors, n, sized["neighbors"], settings))
    labels = cut_lineage(
        density_cluster(points, sized["min_cluster_size"], sized["min_samples"], settings)
    )
    row = run_params(labels, settings).first()
    if row["kmeans_fallback"]:
        labels = cut_lineage(kmeans_labels(points, row["fallback_k"], settings))
    params = (
        run_params(labels, settings)
        .drop("kmeans_fallback", "fallback_k")
        .select(
            F.lit(settings.reducer).alias("reducer"),
            F.lit("kmeans" if row["kmeans_fallback"] else "density").alias("clusterer"),
            F.lit(row["kmeans_fallback"]).alias("kmeans_fallback"),
            "*",
        )
        .withColumn("noise_pct", F.round("noise_rate", 4))
        .drop("noise_rate")
    )
    labelled = labelled_texts(comments, labels)
    keywords = settled(ctfidf(labelled, settings))
    topics = settled(topic_table(labelled, settings, keywords))
    topics.count()
    return TopicResult(labels, keywords, topics, params, "spark", model, time.time() - started)
