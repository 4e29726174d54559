"""Per-topic quality table with warning flags, made before any model analysis."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.operators.arrays import centroids
from voxloom.operators.lookup import settled
from voxloom.operators.nearest import best_match
from voxloom.operators.representatives import candidates, packed_samples, picks, with_originals
from voxloom.settings import Settings

# The texts of the warning flags.
FLAG_TINY = "توبيك صغير"
FLAG_NO_WORDS = "بدون كلمات واضحة"
FLAG_SIMILAR = "يشبه التوبيك "


def nearest_topic(centers: DataFrame, settings: Settings) -> DataFrame:
    """topic_id, most_similar_topic, similarity: the closest other centroid, lowest id on ties."""
    matched = best_match(
        centers.select(F.col("topic_id").alias("id"), F.col("topic_id").alias("skip"), F.col("centroid").alias("vec")),
        centers.select(F.col("topic_id").alias("id"), F.col("centroid").alias("vec")),
        settings,
    )
    return matched.select(
        F.col("id").cast("int").alias("topic_id"),
        F.col("match_id").cast("int").alias("most_similar_topic"),
        F.col("score").alias("similarity"),
    )


def quality_check(
    topics: DataFrame,
    members: DataFrame,
    settings: Settings,
    found: DataFrame | None = None,
) -> DataFrame:
    """Nine columns per topic, largest topic first. ``found`` reuses candidates made before."""
    topics = settled(topics)
    centers = settled(centroids(members))
    n = topics.agg(F.greatest(F.sum("topic_size"), F.lit(1))).scalar()
    noise = topics.agg(F.coalesce(F.sum(F.when(F.col("topic_id") == -1, F.col("topic_size"))), F.lit(0))).scalar()
    if found is None:
        found = candidates(members, settings, 3, centers=centers)
    samples = packed_samples(with_originals(picks(found, 3), members, settings))
    tiny = F.greatest(
        F.lit(settings.tiny_floor).cast("long"), F.floor(F.lit(settings.tiny_share) * n).cast("long")
    )
    flags = F.array(
        F.when(F.col("topic_size") < tiny, F.lit(FLAG_TINY)),
        F.when(F.size("keywords") == 0, F.lit(FLAG_NO_WORDS)),
        F.when(
            F.col("similarity") > settings.similar_threshold,
            F.concat(F.lit(FLAG_SIMILAR), F.col("most_similar_topic")),
        ),
    )
    return (
        topics.filter("topic_id <> -1")
        .join(nearest_topic(centers, settings), "topic_id", "left")
        .join(samples, "topic_id", "left")
        .select(
            "topic_id",
            "topic_size",
            F.round(100 * F.col("topic_size") / n, 2).alias("topic_percentage"),
            F.round(100 * noise / n, 2).alias("noise_percentage"),
            F.array_join(F.slice("keywords", 1, settings.top_keywords), ", ").alias("top_keywords"),
            F.coalesce(F.array_join("samples", " || "), F.lit("")).alias("representative_comments"),
            "most_similar_topic",
            F.round("similarity", 3).alias("similarity"),
            F.array_join(flags, "; ").alias("flags"),
        )
        .orderBy(F.desc("topic_size"), F.asc("topic_id"))
    )
