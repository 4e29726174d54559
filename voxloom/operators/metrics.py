"""Objective measures of a topic result, each computed in linear time over the comments."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from voxloom.functions import tokens as K
from voxloom.operators.arrays import centroids, unit
from voxloom.operators.lookup import attach, settled
from voxloom.operators.nearest import best_match
from voxloom.settings import Settings


def topic_sizes(comments: DataFrame) -> DataFrame:
    return comments.groupBy("topic_id").agg(F.count("*").alias("topic_size"))


def share_figures(sizes: DataFrame) -> DataFrame:
    """One row: n, n_topics, n_noise, noise_rate, coverage."""
    real = F.col("topic_id") != -1
    totals = sizes.agg(
        F.coalesce(F.sum("topic_size"), F.lit(0)).alias("n"),
        F.count(F.when(real, 1)).alias("n_topics"),
        F.coalesce(F.sum(F.when(~real, F.col("topic_size"))), F.lit(0)).alias("n_noise"),
    )
    rate = F.when(F.col("n") > 0, F.col("n_noise") / F.col("n")).otherwise(F.lit(0.0))
    return totals.withColumn("noise_rate", rate).withColumn("coverage", 1 - F.col("noise_rate"))


def topic_balance(sizes: DataFrame) -> DataFrame:
    """One row: 1 - Gini of the sizes of the real topics, 0 without topics.

    Equal sizes are counted first: n comments allow at most sqrt(2n) different sizes, so the ordered
    pass over them stays small whatever the number of topics.
    """
    tied = (
        sizes.filter("topic_id <> -1")
        .groupBy(F.col("topic_size").cast("double").alias("x"))
        .agg(F.count("*").cast("double").alias("m"))
    )
    before = F.coalesce(
        F.sum("m").over(Window.orderBy("x").rowsBetween(Window.unboundedPreceding, -1)), F.lit(0.0)
    )
    ranked = tied.withColumn("rank_sum", F.col("m") * before + F.col("m") * (F.col("m") + 1) / 2)
    sums = ranked.agg(
        F.sum("m").alias("n"),
        F.sum(F.col("x") * F.col("m")).alias("total"),
        F.sum(F.col("x") * F.col("rank_sum")).alias("ranked_total"),
    )
    gini = 2 * F.col("ranked_total") / (F.col("n") * F.col("total")) - (F.col("n") + 1) / F.col("n")
    return sums.select(F.coalesce(1 - gini, F.lit(0.0)).alias("topic_balance"))


def keyword_sets(comments: DataFrame, keywords: DataFrame, settings: Settings) -> DataFrame:
    """topic_id, ranks (rising keyword ranks), docs: comments that hold exactly these keywords.

    Tokens keep their stop words here. A comment adds one row per topic it shares a keyword with, never
    a pair; all co-occurrences follow from the sets of ranks found in each topic.
    """
    held = comments.select("row_id", F.explode(F.array(K.tokens(F.col("cleaned_text")))).alias("t"))
    grams = held.select(
        "row_id", F.explode(F.array_distinct(K.with_ngrams(F.col("t"), settings.ngram_max))).alias("term")
    )
    # a term may be a keyword of several topics: collect them, so that the lookup key is unique
    wanted = keywords.groupBy("term").agg(
        F.collect_list(F.struct("topic_id", "rank")).alias("uses")
    )
    hits = attach(grams, wanted, "term", spread_by="row_id", settings=settings, how="inner")
    return (
        hits.select("row_id", F.inline("uses"))
        .groupBy("row_id", "topic_id")
        .agg(F.array_sort(F.collect_set("rank")).alias("ranks"))  # no more than a topic has keywords
        .groupBy("topic_id", "ranks")
        .agg(F.count("*").alias("docs"))
    )


def document_frequency(sets: DataFrame, settings: Settings) -> DataFrame:
    """topic_id, rank, doc_freq for keywords found in at least one comment."""
    return (
        sets.select("topic_id", "docs", F.explode("ranks").alias("rank"))
        .groupBy("topic_id", "rank")
        .agg(F.sum("docs").alias("doc_freq"))
    )


def npmi_pairs(
    comments: DataFrame, keywords: DataFrame, settings: Settings, texts: DataFrame | None = None
) -> DataFrame:
    """topic_id, rank_i, rank_j, together, npmi for all keyword pairs of a topic (45 for ten keywords).

    ``texts`` (row_id, cleaned_text) are those of the same comments, given where a join made ``comments``: which topic
    a comment has is not asked, so its text need not go through that join.
    """
    sets = settled(keyword_sets(comments if texts is None else texts, keywords, settings))
    freq = document_frequency(sets, settings)
    left = freq.select("topic_id", F.col("rank").alias("rank_i"), F.col("doc_freq").alias("df_i"))
    right = freq.select("topic_id", F.col("rank").alias("rank_j"), F.col("doc_freq").alias("df_j"))
    pairs = left.join(right, "topic_id").filter("rank_i < rank_j")
    both = F.array_contains("ranks", F.col("rank_i")) & F.array_contains("ranks", F.col("rank_j"))
    together = (
        pairs.join(sets, "topic_id")
        .groupBy("topic_id", "rank_i", "rank_j", "df_i", "df_j")
        .agg(F.coalesce(F.sum(F.when(both, F.col("docs"))), F.lit(0)).alias("together"))
    )
    n = comments.agg(F.count("*").cast("double")).scalar()
    p_ij = F.col("together") / n
    score = F.ln(p_ij / ((F.col("df_i") / n) * (F.col("df_j") / n))) / -F.ln(p_ij)
    npmi = (
        F.when(F.col("together") == 0, F.lit(-1.0))
        .when(F.col("together") == n, F.lit(1.0))  # the limit; the formula is 0 / 0 there
        .otherwise(score)
    )
    return together.select("topic_id", "rank_i", "rank_j", "together", npmi.alias("npmi"))


def npmi_coherence(
    comments: DataFrame, keywords: DataFrame, settings: Settings, texts: DataFrame | None = None
) -> DataFrame:
    """One row: mean over topics of the mean NPMI of their keyword pairs; 0 when there is no pair."""
    per_topic = npmi_pairs(comments, keywords, settings, texts).groupBy("topic_id").agg(F.avg("npmi").alias("npmi"))
    return per_topic.agg(F.coalesce(F.avg("npmi"), F.lit(0.0)).alias("npmi_coherence"))


def silhouette_rows(members: DataFrame, settings: Settings) -> DataFrame:
    """row_id, topic_id, silhouette (cosine) of every comment in a real topic.

    With unit vectors the mean distance to a topic is one minus the product with its mean vector, so a
    comment meets every topic once and never another comment.
    """
    real = unit(members.filter("topic_id <> -1").select("row_id", "topic_id", "vec"))
    centers = settled(centroids(real))
    matched = best_match(
        real.select(F.col("row_id").alias("id"), F.col("topic_id").alias("skip"), "vec"),
        centers.select(F.col("topic_id").alias("id"), F.col("centroid").alias("vec")),
        settings,
        cosine=False,
    )
    sized = attach(
        matched,
        centers.select(F.col("topic_id").cast("long").alias("skip"), "n"),
        "skip",
        spread_by="id",
        settings=settings,
        how="inner",
    )
    own = 1 - (F.col("n") * F.col("own_score") - F.col("squared")) / (F.col("n") - 1)
    other = 1 - F.col("score")
    spread = F.greatest(own, other)
    value = (
        F.when(F.col("n") == 1, F.lit(0.0))
        .when(spread == 0, F.lit(0.0))
        .otherwise((other - own) / spread)
    )
    return sized.select(
        F.col("id").alias("row_id"), F.col("skip").cast("int").alias("topic_id"), value.alias("silhouette")
    )


def silhouette(members: DataFrame, settings: Settings) -> DataFrame:
    """One row: the mean, null below three comments or two topics or when every topic is a single."""
    scored = silhouette_rows(members, settings)
    figures = scored.agg(
        F.count("*").alias("n"),
        F.count_distinct("topic_id").alias("topics"),
        F.avg("silhouette").alias("mean"),
    )
    defined = (F.col("n") > 2) & (F.col("topics") >= 2) & (F.col("topics") < F.col("n"))
    return figures.select(F.when(defined, F.col("mean")).alias("silhouette"))


def metrics_row(
    comments: DataFrame,
    members: DataFrame,
    keywords: DataFrame,
    settings: Settings,
    *,
    engine: str,
    model: str,
    runtime_sec: float | None,
    texts: DataFrame | None = None,
) -> DataFrame:
    """The ten figures of one run in one row; ``texts`` as in ``npmi_pairs``."""
    sizes = settled(topic_sizes(comments))
    return share_figures(sizes).select(
        F.lit(engine).alias("engine"),
        F.lit(model).alias("model"),
        "n_topics",
        "n_noise",
        F.round("noise_rate", 4).alias("noise_rate"),
        F.round("coverage", 4).alias("coverage"),
        F.round(silhouette(members, settings).scalar(), 4).alias("silhouette"),
        F.round(npmi_coherence(comments, keywords, settings, texts).scalar(), 4).alias("npmi_coherence"),
        F.round(topic_balance(sizes).scalar(), 4).alias("topic_balance"),
        F.round(F.lit(runtime_sec).cast("double"), 2).alias("runtime_sec"),
    )
