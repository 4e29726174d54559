"""Clustering parameters that follow the number of comments."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from voxloom.settings import Settings

# Tier names and the small-sample warning.
TIER_SMALL = "smoke_test (<500)"
TIER_MEDIUM = "medium (500-3000)"
TIER_LARGE = "large (>=3000)"
SMALL_WARNING = "Small dataset smoke test only. Do not judge final topic quality from this sample."


def size_params(n: Column, settings: Settings) -> Column:
    """STRUCT of n, neighbors, min_cluster_size, min_samples, is_smoke_test, warning, tier."""
    if not settings.auto_params:
        return F.struct(
            n.cast("long").alias("n"),
            F.lit(settings.neighbors).alias("neighbors"),
            F.lit(settings.min_topic_size).alias("min_cluster_size"),
            F.lit(settings.min_samples).cast("int").alias("min_samples"),
            (n < 500).alias("is_smoke_test"),
            F.lit("").alias("warning"),
            F.lit("manual").alias("tier"),
        )

    def by_tier(small, medium, large):
        as_col = [v if isinstance(v, Column) else F.lit(v) for v in (small, medium, large)]
        return F.when(n < 500, as_col[0]).when(n < 3000, as_col[1]).otherwise(as_col[2])

    share = lambda s: F.floor(n * F.lit(s)).cast("int")
    return F.struct(
        n.cast("long").alias("n"),
        by_tier(F.when(n >= 150, 15).otherwise(10), 20, 40).alias("neighbors"),
        by_tier(
            5,
            F.greatest(F.lit(10), share(0.01)),
            F.least(F.lit(100), F.greatest(F.lit(30), share(0.005))),
        ).alias("min_cluster_size"),
        by_tier(2, 4, 8).alias("min_samples"),
        (n < 500).alias("is_smoke_test"),
        by_tier(SMALL_WARNING, "", "").alias("warning"),
        by_tier(TIER_SMALL, TIER_MEDIUM, TIER_LARGE).alias("tier"),
    )


def needs_fallback(n: Column, noise_rate: Column, settings: Settings) -> Column:
    return (n >= settings.kmeans_min_n) & (noise_rate > settings.kmeans_noise)


def fallback_k(n: Column) -> Column:
    return F.least(F.lit(50), F.greatest(F.lit(10), F.floor(n / 250).cast("int")))
