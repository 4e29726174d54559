"""Result tables of a run."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.functions import text as T
from voxloom.functions.analysis_texts import LIST_COMMA
from voxloom.operators.keywords import display_name
from voxloom.operators.lookup import attach, settled
from voxloom.settings import EMBEDDING_MODELS, Settings

ATTRIBUTES = "business_name description root_cause sentiment severity recommended_actions".split()


def described_topics(topics: DataFrame, attributes: DataFrame | None = None) -> DataFrame:
    """topics (topic_id, topic_size, keywords, auto_name) plus topic_name, has_meta and attributes."""
    if attributes is None:
        rows = topics.select(
            "*", *[F.lit(None).cast("string").alias(a) for a in ATTRIBUTES], F.lit(False).alias("has_meta")
        )
    else:
        known = attributes.select("topic_id", *ATTRIBUTES, F.lit(True).alias("known"))
        rows = topics.join(known, "topic_id", "left").withColumn(
            "has_meta", F.coalesce("known", F.lit(False))
        ).drop("known")
    name = display_name(F.col("business_name"), F.col("topic_id"), F.col("auto_name"))
    return rows.withColumn("topic_name", name)


def feedback_with_topics(comments: DataFrame, described: DataFrame, settings: Settings) -> DataFrame:
    """Every comment with the attributes of its topic, eight columns."""
    slim = described.select(
        "topic_id",
        "topic_name",
        F.array_join("keywords", ", ").alias("keywords"),
        F.coalesce("sentiment", F.lit("")).alias("sentiment"),
        F.coalesce("severity", F.lit("")).alias("severity"),
    )
    joined = attach(comments, slim, "topic_id", spread_by="row_id", settings=settings)
    return joined.select(
        F.col("row_id").alias("original_row_index"),
        "original_comment",
        "cleaned_text",
        "topic_id",
        "topic_name",
        "keywords",
        "sentiment",
        "severity",
    )


def topic_summary(described: DataFrame, samples: DataFrame) -> DataFrame:
    """Fourteen columns per topic, largest first; shares are of the assigned comments."""
    real = described.filter("topic_id <> -1")
    assigned = real.agg(F.greatest(F.coalesce(F.sum("topic_size"), F.lit(0)), F.lit(1))).scalar()

    def attribute(name):
        return F.when(F.col("has_meta"), F.coalesce(name, F.lit(""))).otherwise("").alias(name)

    return (
        real.join(samples, "topic_id", "left")
        .select(
            "topic_id",
            "topic_name",
            F.col("topic_size").alias("count"),
            F.round(100.0 * F.col("topic_size") / assigned, 2).alias("percentage"),
            F.array_join("keywords", ", ").alias("keywords"),
            F.when(F.col("has_meta"), F.coalesce("business_name", F.lit("")))
            .otherwise(F.col("topic_name"))
            .alias("business_name"),
            *[attribute(a) for a in ATTRIBUTES[1:]],
            *[
                F.coalesce(F.get("samples", F.lit(i)), F.lit("")).alias(f"top_sample_{i + 1}")
                for i in range(3)
            ],
        )
        .orderBy(F.desc("count"), F.asc("topic_id"))
    )


def topic_samples(described: DataFrame, chosen: DataFrame, settings: Settings) -> DataFrame:
    """One row per representative comment (chosen: topic_id, rank, original_comment)."""
    names = described.select("topic_id", "topic_name")
    return (
        attach(chosen, names, "topic_id", spread_by="rank", settings=settings, how="inner")
        .orderBy("topic_id", "rank")
        .select("topic_id", "topic_name", F.col("original_comment").alias("sample_comment"))
    )


def noise_comments(comments: DataFrame) -> DataFrame:
    return comments.filter("topic_id = -1").select(
        F.col("row_id").alias("original_row_index"), "original_comment", "cleaned_text", "frequency"
    )


def largest_topics(described: DataFrame, n: int = 5) -> DataFrame:
    """One row: the n largest topics as text."""
    top = (
        described.filter("topic_id <> -1")
        .orderBy(F.desc("topic_size"), F.asc("topic_id"))
        .limit(n)
        .withColumn(
            "label", F.concat("topic_name", F.lit(" ("), F.col("topic_size").cast("string"), F.lit(")"))
        )
    )
    ordered = F.array_sort(F.collect_list(F.struct(-F.col("topic_size"), "topic_id", "label")))
    return top.agg(
        F.array_join(F.transform(ordered, lambda x: x["label"]), LIST_COMMA).alias("largest_topics")
    )


def _pairs(row: DataFrame, pairs: list[tuple[str, object]], key: str) -> DataFrame:
    """One wide row as (key, value) rows of text."""
    text = [F.struct(F.lit(k).alias(key), F.coalesce(v.cast("string"), F.lit("")).alias("value")) for k, v in pairs]
    return row.select(F.inline(F.array(*text)))


def _yes_no(c):
    return F.when(c, "YES").otherwise("NO")


def overview(described: DataFrame, metrics: DataFrame, stats: DataFrame, params: DataFrame) -> DataFrame:
    """(metric, value): eleven figures of the data set. All inputs but ``described`` have one row."""
    row = _one_row(stats, metrics, params, largest_topics(described))
    percent = F.concat(F.round(F.col("noise_rate") * 100, 2).cast("string"), F.lit("%"))
    return _pairs(
        row,
        [
            ("total_rows", F.col("n_original")),
            ("clean_rows", F.col("n_after")),
            ("duplicate_count", F.col("duplicate_count")),
            ("number_of_topics", F.col("n_topics")),
            ("noise_count", F.col("n_noise")),
            ("noise_percentage", percent),
            ("largest_topics", F.col("largest_topics")),
            ("kmeans_fallback_triggered", _yes_no(F.col("kmeans_fallback"))),
            ("dataset_tier", F.col("tier")),
            ("smoke_test", _yes_no(F.col("is_smoke_test"))),
            ("warning", F.col("warning")),
        ],
        "metric",
    )


def settings_table(metrics: DataFrame, stats: DataFrame, params: DataFrame, settings: Settings) -> DataFrame:
    """(setting, value): twenty-one settings and figures of the run."""
    row = _one_row(stats, metrics, params)
    models = F.create_map(*[F.lit(x) for pair in EMBEDDING_MODELS.items() for x in pair])
    model = F.coalesce(models[F.col("model")], F.col("model"))
    analysis_model = settings.analysis_model if settings.analysis_enabled else "disabled"
    plain = {
        "dim_reducer": "reducer",
        "umap_n_neighbors": "neighbors",
        "hdbscan_min_cluster_size": "min_cluster_size",
        "hdbscan_min_samples": "min_samples",
        "clusterer_used": "clusterer",
        "kmeans_fallback": "kmeans_fallback",
        "dataset_tier": "tier",
        "n_original_rows": "n_original",
        "n_rows_after_cleaning": "n_after",
        "removed_null": "removed_null",
        "removed_short": "removed_short",
        "duplicate_count": "duplicate_count",
        "total_topics": "n_topics",
        "noise_comments": "n_noise",
        "noise_rate": "noise_rate",
        "silhouette": "silhouette",
        "npmi_coherence": "npmi_coherence",
        "runtime_sec": "runtime_sec",
    }
    return _pairs(
        row,
        [
            ("embedding_model", model),
            ("engine", F.col("engine")),
            ("llm_model", F.lit(analysis_model)),
            *[(name, F.col(column)) for name, column in plain.items()],
        ],
        "setting",
    )


def _one_row(first: DataFrame, *others: DataFrame) -> DataFrame:
    """One-row tables side by side."""
    row = first.withColumn("_one", F.lit(1))
    for other in others:
        row = row.join(other.withColumn("_one", F.lit(1)), "_one")
    return row


def validation_preview(comments: DataFrame, described: DataFrame, settings: Settings) -> DataFrame:
    """The first comments of the largest topics, shortened for reading."""
    top = (
        described.filter("topic_id <> -1")
        .orderBy(F.desc("topic_size"), F.asc("topic_id"))
        .limit(settings.validation_topics)
        .select("topic_id", "topic_name", "topic_size")
    )
    in_order = Window.partitionBy("topic_id").orderBy("row_id")
    first = (
        comments.join(F.broadcast(top), "topic_id")  # at most validation_topics rows
        .select(
            "topic_id", "topic_name", "topic_size", F.row_number().over(in_order).alias("rank"), "original_comment"
        )
        .filter(F.col("rank") <= settings.validation_samples)
    )
    return first.select(
        "topic_id", "topic_name", "topic_size", "rank", T.preview(F.col("original_comment")).alias("comment")
    )


def chart_top10(described: DataFrame) -> DataFrame:
    return (
        described.filter("topic_id <> -1")
        .orderBy(F.desc("topic_size"), F.asc("topic_id"))
        .limit(10)
        .select(F.concat(F.lit("T"), F.col("topic_id")).alias("label"), F.col("topic_size").alias("count"))
    )


def chart_share(described: DataFrame) -> DataFrame:
    real = described.filter("topic_id <> -1")
    total = real.agg(F.greatest(F.sum("topic_size"), F.lit(1))).scalar()
    return real.select(
        F.concat(F.lit("T"), F.col("topic_id")).alias("label"),
        (100.0 * F.col("topic_size") / total).alias("percentage"),
    )


def chart_noise(described: DataFrame) -> DataFrame:
    """Assigned against noise, with the whole-number share the bars are labelled with."""
    is_noise = F.col("topic_id") == -1
    sums = described.agg(
        F.coalesce(F.sum(F.when(~is_noise, F.col("topic_size"))), F.lit(0)).alias("assigned"),
        F.coalesce(F.sum(F.when(is_noise, F.col("topic_size"))), F.lit(0)).alias("noise"),
    )
    rows = sums.select(
        F.greatest(F.col("assigned") + F.col("noise"), F.lit(1)).alias("total"),
        F.inline(
            F.array(
                F.struct(F.lit("Assigned").alias("label"), F.col("assigned").alias("comments")),
                F.struct(F.lit("Noise").alias("label"), F.col("noise").alias("comments")),
            )
        ),
    )
    return rows.select("label", "comments", (100.0 * F.col("comments") / F.col("total")).alias("percentage"))
