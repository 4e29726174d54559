"""Vectors as ARRAY columns."""

from __future__ import annotations

from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def dot(a: Column, b: Column) -> Column:
    products = F.zip_with(a, b, lambda x, y: x.cast("double") * y.cast("double"))
    return F.aggregate(products, F.lit(0.0), lambda acc, x: acc + x)


def norm(a: Column) -> Column:
    return F.sqrt(dot(a, a))


def cosine(a: Column, b: Column, eps: float = 1e-9) -> Column:
    return dot(a, b) / (norm(a) * norm(b) + F.lit(eps))


def unit(df: DataFrame, vec: str = "vec") -> DataFrame:
    """Scale every vector to length one; zero vectors stay."""
    length = F.explode(F.array(norm(F.col(vec))))
    scaled = F.transform(vec, lambda x: F.when(F.col("_norm") > 0, x / F.col("_norm")).otherwise(x))
    return df.withColumn("_norm", length).withColumn(vec, scaled).drop("_norm")


def centroids(members: DataFrame) -> DataFrame:
    """topic_id, n, centroid: mean vector of every real topic, summed up in the JVM map-side first."""
    as_vector = array_to_vector(F.col("vec").cast("array<double>"))
    return (
        members.filter("topic_id <> -1")
        .groupBy("topic_id")
        .agg(F.count("*").alias("n"), Summarizer.mean(as_vector).alias("mean"))
        .select("topic_id", "n", vector_to_array("mean").alias("centroid"))
    )
