"""Characteristic terms per topic: class-based TF-IDF over tokens and bigrams."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from voxloom.functions import tokens as K
from voxloom.functions.stopwords import stop_words
from voxloom.operators.lookup import DEAL, settled
from voxloom.settings import Settings


def gram_rows(comments: DataFrame, settings: Settings, stops: list[str] | None = None) -> DataFrame:
    """comments plus ``grams ARRAY<STRING>``: n-grams are formed after the stop words are gone."""
    words = stop_words(settings.normalize_stopwords) if stops is None else stops
    kept = K.tokens(F.col("cleaned_text"))
    if words:
        kept = K.without(kept, words)
    held = comments.withColumn("_tokens", F.explode(F.array(kept)))
    return held.withColumn("grams", K.with_ngrams(F.col("_tokens"), settings.ngram_max)).drop("_tokens")


def topic_term_counts(comments: DataFrame, settings: Settings) -> DataFrame:
    """topic_id, term, cnt, docs: occurrences and comments per topic and term, noise included.

    A comment's sorted grams stand next to their predecessors, so a gram that differs from the one
    before it is the first of its kind in the comment. Both counts come out of the row itself; the only
    shuffle is that of the combined (topic, term) counts. Those of dealt comments (``labelled_texts``) are
    combined within the deal and move by term, so what is asked per term afterwards moves them no more.
    """
    dealt = [c for c in (DEAL,) if c in comments.columns]
    in_order = gram_rows(comments, settings).select(*dealt, "topic_id", F.sort_array("grams").alias("term"))
    before = F.concat(F.array(F.lit("")), F.col("term")).alias("before")
    pairs = in_order.select(*dealt, "topic_id", "term", before).select(
        *dealt, "topic_id", F.explode(F.arrays_zip("term", "before")).alias("g")
    )
    pairs = pairs.select(*dealt, "topic_id", "g.term", "g.before").filter("term is not null")
    counts = pairs.groupBy(*dealt, "topic_id", "term").agg(
        F.count("*").alias("cnt"), F.count(F.when(F.col("term") != F.col("before"), 1)).alias("docs")
    )
    if not dealt:
        return counts
    parts = comments.schema[DEAL].metadata["parts"]
    return counts.drop(DEAL).repartition(parts, "term").groupBy("topic_id", "term").agg(
        F.sum("cnt").alias("cnt"), F.sum("docs").alias("docs")
    )


def term_totals(counts: DataFrame) -> DataFrame:
    """term, term_total, doc_freq over all comments, noise included."""
    return counts.groupBy("term").agg(
        F.sum("cnt").alias("term_total"), F.sum("docs").alias("doc_freq")
    )


def vocabulary(counts: DataFrame, settings: Settings) -> DataFrame:
    """counts with their term totals, only terms found in at least ``min_df`` comments.

    A window over the term needs no second pass and no self-join; it sees at most one row per topic.
    """
    per_term = Window.partitionBy("term")
    return (
        counts.withColumn("term_total", F.sum("cnt").over(per_term))
        .withColumn("doc_freq", F.sum("docs").over(per_term))
        .filter(F.col("doc_freq") >= settings.min_df)
    )


def mean_class_tokens(vocab: DataFrame) -> DataFrame:
    """One row: tokens of all comments over the number of topics (noise is none)."""
    topics = F.count_distinct(F.when(F.col("topic_id") != -1, F.col("topic_id")))
    return vocab.agg(
        F.sum("cnt").alias("all_tokens"), F.greatest(topics, F.lit(1)).alias("n_topics")
    ).withColumn("mean_tokens", F.col("all_tokens").cast("double") / F.col("n_topics"))


def ctfidf(comments: DataFrame, settings: Settings) -> DataFrame:
    """topic_id, rank, term, score: the ``top_keywords`` best terms of every topic.

    Within a topic the order does not depend on the topic's own total, so terms are cut to the best
    few first (per map task already, by Spark's group limit) and only those are divided by the total.
    """
    # read four times below: kept on the executors, it is far smaller than the texts it comes from
    vocab = settled(vocabulary(topic_term_counts(comments, settings), settings))
    topics = comments.filter("topic_id <> -1").agg(F.count_distinct("topic_id").alias("n"))
    mean_tokens = vocab.agg(F.sum("cnt").cast("double")).scalar() / F.greatest(topics.scalar(), F.lit(1))
    weighted = vocab.filter("topic_id <> -1").withColumn(
        "weight", F.col("cnt") * F.log1p(mean_tokens / F.col("term_total"))
    )
    best_first = Window.partitionBy("topic_id").orderBy(F.desc("weight"), F.asc("term"))
    best = weighted.withColumn("rank", F.row_number().over(best_first)).filter(
        F.col("rank") <= settings.top_keywords
    )
    totals = vocab.filter("topic_id <> -1").groupBy("topic_id").agg(F.sum("cnt").alias("topic_total"))
    return (
        best.join(totals, "topic_id")
        .withColumn("score", F.col("weight") / F.col("topic_total"))
        .filter("score > 0")
        .select("topic_id", "rank", "term", "score")
    )


def packed(keywords: DataFrame) -> DataFrame:
    """topic_id, keywords ARRAY<STRING> in rank order (at most ``top_keywords`` each)."""
    ordered = F.array_sort(F.collect_list(F.struct("rank", "term")))
    return keywords.groupBy("topic_id").agg(F.transform(ordered, lambda k: k["term"]).alias("keywords"))


def auto_name(keywords: Column, n: int = 3) -> Column:
    first = F.transform(F.slice(keywords, 1, n), lambda k: F.translate(k, " ", "_"))
    return F.when(F.size(keywords) > 0, F.array_join(F.array_distinct(first), "_")).otherwise(
        F.lit("topic_unknown")
    )


def display_name(business_name: Column, topic_id: Column, auto: Column) -> Column:
    return F.coalesce(
        F.nullif(business_name, F.lit("")),
        F.when(topic_id == -1, F.lit("noise")),
        auto,
        F.concat(F.lit("topic_"), topic_id),
    )


def topic_table(comments: DataFrame, settings: Settings, keywords: DataFrame | None = None) -> DataFrame:
    """topic_id, topic_size, keywords, auto_name; one row per topic, noise included.

    Noise has neither keywords nor a name of its own.
    """
    sizes = comments.groupBy("topic_id").agg(F.count("*").alias("topic_size"))
    words = packed(ctfidf(comments, settings) if keywords is None else keywords)
    none = F.array().cast("array<string>")
    return sizes.join(words, "topic_id", "left").select(
        "topic_id",
        "topic_size",
        F.coalesce("keywords", none).alias("keywords"),
        F.when(F.col("topic_id") != -1, auto_name(F.coalesce("keywords", none))).alias("auto_name"),
    )
