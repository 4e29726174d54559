"""Typical comments of a topic: closest to the centroid, each text once, both languages if there are two."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.functions import text as T
from voxloom.operators.arrays import centroids, cosine
from voxloom.operators.lookup import attach, measured_bytes, settled
from voxloom.settings import Settings


def similarity(members: DataFrame, settings: Settings, centers: DataFrame | None = None) -> DataFrame:
    """members (row_id, topic_id, vec, ...) plus topic_n and sim, the cosine to the own centroid."""
    centers = centroids(members) if centers is None else centers
    small = centers.select("topic_id", F.col("n").alias("topic_n"), "centroid")
    joined = attach(
        members.filter("topic_id <> -1"), small, "topic_id", spread_by="row_id", settings=settings, how="inner"
    )
    return joined.withColumn("sim", cosine(F.col("vec"), F.col("centroid"))).drop("centroid")


def keyed(comments: DataFrame) -> DataFrame:
    """comments plus what ``candidates`` asks of a text, so that joins behind it move a digest in its place."""
    return comments.withColumns(
        {
            "text_key": F.sha2(T.dedup_key(F.col("cleaned_text")), 256),
            "has_arabic": T.has_arabic(F.col("cleaned_text")),
        }
    )


def candidates(
    members: DataFrame,
    settings: Settings,
    k_max: int,
    flag: Column | None = None,
    centers: DataFrame | None = None,
) -> DataFrame:
    """topic_id, topic_n, row_id, sim, flag, flag_rank: all rows any choice of up to ``k_max`` can need.

    Copies of a text go first, in a map-side combined aggregation over digests that keeps the closest
    row. Then the best ``k_max`` of either language remain; Spark cuts to that many per map task before
    it moves rows, so a topic with most of the comments costs no more than a small one.
    """
    members = members if "text_key" in members.columns else keyed(members)
    language = F.col("has_arabic") if flag is None else flag
    scored = similarity(members, settings, centers)
    closest = F.max(F.struct("sim", (-F.col("row_id")).alias("minus_id"), language.alias("flag")))
    unique = (
        scored.groupBy("topic_id", "text_key")
        .agg(closest.alias("c"), F.max("topic_n").alias("topic_n"))
        .select(
            "topic_id", "topic_n", (-F.col("c.minus_id")).alias("row_id"), F.col("c.sim").alias("sim"),
            F.col("c.flag").alias("flag"),
        )
    )
    per_language = Window.partitionBy("topic_id", "flag").orderBy(F.desc("sim"), F.asc("row_id"))
    return unique.withColumn("flag_rank", F.row_number().over(per_language)).filter(
        F.col("flag_rank") <= k_max
    )


def picks(found: DataFrame, k: int | Column) -> DataFrame:
    """topic_id, rank, row_id, sim, flag: the closest ``k``, the last one swapped for the other language.

    A row outside the first k that leads its language can only exist when all k share the other one.
    """
    by_topic = Window.partitionBy("topic_id")
    ranked = (
        found.withColumn("k", F.lit(k) if isinstance(k, int) else k)
        .withColumn("rank", F.row_number().over(by_topic.orderBy(F.desc("sim"), F.asc("row_id"))))
        .withColumn("guest", (F.col("rank") > F.col("k")) & (F.col("flag_rank") == 1))
        .withColumn("has_guest", F.max("guest").over(by_topic))
    )
    last = (F.col("rank") == F.col("k")) & F.col("has_guest")
    chosen = ranked.filter(F.col("guest") | ((F.col("rank") <= F.col("k")) & ~last))
    return chosen.select(
        "topic_id",
        F.when(F.col("guest"), F.col("k")).otherwise(F.col("rank")).cast("int").alias("rank"),
        "row_id",
        "sim",
        "flag",
    )


def rep_count(size: Column, settings: Settings) -> Column:
    top = F.lit(settings.rep_comments_max)
    return F.least(top, F.greatest(F.lit(settings.rep_comments_min), F.least(size, top))).cast("int")


def with_originals(
    chosen: DataFrame, comments: DataFrame, settings: Settings, narrowed: Callable[[DataFrame], DataFrame] | None = None
) -> DataFrame:
    """chosen plus original_comment. The chosen rows are few per topic; comments stay where they are
    as long as the chosen ones fit a broadcast. ``narrowed`` then makes the comments anew for the row_ids of
    a small table, so that a join behind them moves no other texts."""
    chosen = settled(chosen)
    if measured_bytes(chosen) <= settings.broadcast_bytes:
        comments = comments if narrowed is None else narrowed(F.broadcast(chosen.select("row_id")))
        return comments.select("row_id", "original_comment").join(F.broadcast(chosen), "row_id")
    return comments.select("row_id", "original_comment").join(chosen, "row_id")


def packed_samples(with_text: DataFrame) -> DataFrame:
    """topic_id, samples ARRAY<STRING> in rank order; at most ``rep_comments_max`` per topic."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "original_comment")))
    return with_text.groupBy("topic_id").agg(
        F.transform(ordered, lambda s: s["original_comment"]).alias("samples")
    )


def representatives(
    members: DataFrame, settings: Settings, k: int | None = None, flag: Column | None = None,
    narrowed: Callable[[DataFrame], DataFrame] | None = None,
) -> DataFrame:
    """topic_id, rank, row_id, sim, flag, original_comment; ``k`` None adapts it to the topic size."""
    k_max = settings.rep_comments_max if k is None else k
    found = candidates(members, settings, k_max, flag)
    chosen = picks(found, rep_count(F.col("topic_n"), settings) if k is None else k)
    return with_originals(chosen, members, settings, narrowed)


def first_rows(comments: DataFrame, k: int) -> DataFrame:
    """The first ``k`` comments of every real topic in input order (used when there are no vectors)."""
    in_order = Window.partitionBy("topic_id").orderBy("row_id")
    return (
        comments.filter("topic_id <> -1")
        .select("topic_id", "row_id", F.row_number().over(in_order).alias("rank"), "original_comment")
        .filter(F.col("rank") <= k)
    )
