"""Density clustering with noise: mutual reachability, its minimum spanning tree, excess of mass.

Comments with equal vectors are counted into one weighted point, so a text with a third of all copies is
one point. Points, tree and hierarchy stay in Spark: see ``spanning`` and ``hierarchy``. There is no
bound on the number of different vectors and no grid.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.operators.hierarchy import cluster_of_points
from voxloom.operators.spanning import core_distances, dealt, numbered, spanning_tree
from voxloom.session import cut_lineage
from voxloom.settings import Settings


def weighted_points(points: DataFrame) -> DataFrame:
    """id (0, 1, ...), vec, weight, first: every different vector with its number of comments and first row_id."""
    counted = points.groupBy("vec").agg(F.count("*").alias("weight"), F.min("row_id").alias("first"))
    return numbered(counted)


def density_cluster(
    points: DataFrame, min_cluster_size: int, min_samples: int | None, settings: Settings
) -> DataFrame:
    """row_id, topic_id: clusters numbered by their first comment, -1 is noise.

    points: row_id, vec ARRAY<DOUBLE> (a few dimensions, no nulls). A single different vector is noise,
    as nothing stands out from it; an empty table gives no row.
    """
    size = max(2, min_cluster_size)
    reach = size if min_samples is None else max(1, min_samples)
    points = points.select("row_id", F.col("vec").cast("array<double>").alias("vec"))
    single = weighted_points(points)
    if single.limit(2).count() < 2:
        return points.select("row_id", F.lit(-1).alias("topic_id"))
    placed, cells, _ = dealt(single, settings.seed)
    tree = cut_lineage(spanning_tree(core_distances(placed, reach), cells))
    found = cluster_of_points(tree, single.select("id", F.col("weight").alias("size")), size)
    named = cut_lineage(single.select("id", "vec", "first").join(found, "id"))
    topics = named.where("cluster is not null").groupBy("cluster").agg(F.min("first").alias("first"))
    # A row per topic: at least min_cluster_size comments stand behind each.
    topics = topics.select("cluster", (F.row_number().over(Window.orderBy("first")) - 1).alias("topic_id"))
    labelled = named.join(topics, "cluster", "left").select("vec", F.coalesce("topic_id", F.lit(-1)).alias("topic_id"))
    return points.join(labelled, "vec").select("row_id", "topic_id")
