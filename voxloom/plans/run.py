"""A whole run: load, clean, vectors, topics, quality, first save, analysis per topic, final save."""

from __future__ import annotations

from collections.abc import Callable
from dataclasses import dataclass

import numpy as np
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.operators import cleaning, embedding, metrics, quality
from voxloom.operators import representatives as reps
from voxloom.operators.lookup import settled
from voxloom.plans import analysis, reports
from voxloom.plans.discovery import discover
from voxloom.settings import Settings, uses_query_prefix
from voxloom.sources import sinks, state
from voxloom.sources.comments import load_comments, pick_comment_column, spread


# The settings that decide topics, keywords and measures; others do not make saved topics stale.
DECIDING = (
    "auto_params", "reducer", "layout_components", "layout_min_dist", "pca_components", "neighbors",
    "min_topic_size", "min_samples", "kmeans_min_n", "kmeans_noise", "seed", "kmeans_restarts", "min_df", "ngram_max",
    "top_keywords", "normalize_stopwords",
)


@dataclass(frozen=True)
class Prepared:
    """Everything up to and including the topics; what both entry points share."""

    comments: DataFrame  # row_id, original_comment, cleaned_text, frequency, topic_id
    members: DataFrame  # comments with vec
    keywords: DataFrame
    topics: DataFrame
    params: DataFrame
    metrics: DataFrame
    stats: DataFrame
    signature: str


def prepare(
    source: DataFrame,
    folder: str,
    settings: Settings,
    *,
    row_col: str,
    encode: Callable[[list[str]], np.ndarray] | None = None,
    vectors: DataFrame | None = None,
) -> Prepared:
    """Clean, attach vectors and find topics; cleaned texts, vectors and topics of unchanged data are read back.

    vectors: row_id, vec made elsewhere; comments without one are left out.
    """
    spark = source.sparkSession
    column = pick_comment_column(source, settings.comment_column)
    stats = settled(cleaning.cleaning_stats(source, column, row_col, settings.min_words))
    cleaning.require_rows(stats)
    made = cleaning.clean_comments(source, column, row_col, settings.min_words)
    made = made.withColumnRenamed("original_row_index", "row_id")
    # A folder of its own for each content: a later run never changes what an earlier one still reads.
    source_sig = state.signature(source, row_col, column, context=str(settings.min_words))
    clean = state.kept(made, f"{folder}/clean/sig={source_sig}")
    if vectors is not None:
        model, decides = "supplied", state.signature(vectors.select("row_id", F.col("vec").cast("string").alias("v")), "row_id", "v")
        clean = clean.join(vectors.select("row_id"), "row_id", "left_semi")
    elif encode is not None:
        model = settings.embedding
        decides = f"{uses_query_prefix(settings)} {encode.__module__}.{getattr(encode, '__qualname__', type(encode).__qualname__)}"
    else:
        model, decides = "hashed", str(settings.hash_dims)

    def make(comments: DataFrame) -> DataFrame:
        if vectors is not None:
            return embedding.supplied_vectors(comments, vectors)
        if encode is None:
            return embedding.hashed_tfidf(comments, settings)
        return embedding.encoded(comments, encode, settings)

    text_sig = state.signature(clean, "row_id", "cleaned_text", context=decides)
    vectors = state.cached_vectors(clean, make, folder, model, text_sig)
    chosen = {name: getattr(settings, name) for name in DECIDING}
    sig = state.signature(clean, "row_id", "cleaned_text", context=f"{model} {decides} {chosen}")
    saved = state.load_result(spark, folder, sig)
    if saved is None:
        found = discover(clean.select("row_id", "cleaned_text"), vectors, settings, model)
        labelled = clean.join(found.labels, "row_id")
        figures = metrics.metrics_row(
            labelled,
            labelled.join(vectors, "row_id"),
            found.keywords,
            settings,
            engine=found.engine,
            model=model,
            runtime_sec=found.runtime_sec,
        )
        tables = {
            "labels": found.labels,
            "keywords": found.keywords,
            "topics": found.topics,
            "params": found.params,
            "metrics": figures,
            "stats": stats,
        }
        state.save_result(tables, folder, sig)
        saved = state.load_result(spark, folder, sig)
    comments = clean.join(saved["labels"], "row_id")
    return Prepared(
        comments,
        comments.join(vectors, "row_id"),
        saved["keywords"],
        saved["topics"],
        saved["params"],
        saved["metrics"],
        saved["stats"],
        sig,
    )


def report_tables(
    run: Prepared, settings: Settings, candidates: DataFrame, attributes: DataFrame | None = None
) -> dict[str, DataFrame]:
    """All result tables of a run; ``attributes`` are the analysed topics, if any."""
    described = settled(reports.described_topics(run.topics, attributes))
    adaptive = reps.picks(candidates, reps.rep_count(F.col("topic_n"), settings))
    chosen = settled(reps.with_originals(adaptive, run.comments, settings))
    return {
        "feedback_with_topics": reports.feedback_with_topics(run.comments, described, settings),
        "topic_summary": reports.topic_summary(described, reps.packed_samples(chosen)),
        "topic_samples": reports.topic_samples(described, chosen, settings),
        "noise_comments": reports.noise_comments(run.comments),
        "quality_check": quality.quality_check(run.topics, run.members, settings, candidates),
        "overview": reports.overview(described, run.metrics, run.stats, run.params),
        "settings": reports.settings_table(run.metrics, run.stats, run.params, settings),
        "validation_preview": reports.validation_preview(run.comments, described, settings),
        "chart_top10": reports.chart_top10(described),
        "chart_share": reports.chart_share(described),
        "chart_noise": reports.chart_noise(described),
    }


def ranked_candidates(run: Prepared, settings: Settings) -> DataFrame:
    """One ranking serves every report: any choice of up to this many comments is a slice of it."""
    k_max = max(settings.rep_comments_max, settings.samples_per_topic, 3)
    return settled(reps.candidates(run.members, settings, k_max))


def model_inputs(run: Prepared, settings: Settings, candidates: DataFrame) -> DataFrame:
    chosen = reps.with_originals(
        reps.picks(candidates, settings.samples_per_topic), run.comments, settings
    )
    return settled(analysis.topic_payloads(run.topics, run.comments, reps.packed_samples(chosen), settings))


def analyse_run(
    run: Prepared, folder: str, settings: Settings, answer: analysis.Answerer, candidates: DataFrame
) -> DataFrame:
    """Outputs of all topics; those an interrupted run finished for the same topics are kept."""
    spark = run.comments.sparkSession
    payloads = model_inputs(run, settings, candidates)
    done = state.finished_outputs(spark, folder, run.signature)

    def keep(rows: DataFrame) -> None:
        state.append_outputs(rows, folder, run.signature)

    analysis.analysed_in_batches(payloads, None if done is None else settled(done), answer, settings, keep)
    return state.finished_outputs(spark, folder, run.signature)


def run_all(
    source: DataFrame | str,
    folder: str,
    settings: Settings = Settings(),
    *,
    spark: SparkSession | None = None,
    row_col: str | None = None,
    encode: Callable[[list[str]], np.ndarray] | None = None,
    vectors: DataFrame | None = None,
    multi_line: bool = True,
    answer: analysis.Answerer | None = None,
    chat: Callable[[list[str]], list[str]] | None = None,
    file_format: str = "parquet",
) -> Prepared:
    """source: a table with ``row_col``, or a CSV path whose rows get their position as id.

    ``encode`` makes vectors, ``vectors`` (row_id, vec) are taken as they are; else they are hashed
    TF-IDF. ``multi_line`` off lets Spark split large CSV files that have no quoted line breaks.

    All results up to the topics are on disk before the first model call. Without ``answer`` and
    ``chat`` topics keep their automatic names.
    """
    if isinstance(source, str):
        row_col = "_row"
        session = spark or SparkSession.getActiveSession()
        source = spread(load_comments(session, source, row_col=row_col, multi_line=multi_line, settings=settings))
    elif row_col is None:
        raise ValueError("A table needs row_col, the name of its unique id column.")
    session = source.sparkSession
    run = prepare(source, folder, settings, row_col=row_col, encode=encode, vectors=vectors)
    candidates = ranked_candidates(run, settings)
    sinks.write_tables(report_tables(run, settings, candidates), f"{folder}/reports", file_format)
    sinks.write_json(model_inputs(run, settings, candidates), f"{folder}/reports/model_inputs")
    if answer is None and chat is not None:
        answer = analysis.answers_from_model(chat)
    if settings.analysis_enabled and answer is not None:
        outputs = analyse_run(run, folder, settings, answer, candidates)
        attributes = settled(analysis.topic_attributes(outputs))
        sinks.write_tables(report_tables(run, settings, candidates, attributes), f"{folder}/reports", file_format)
        sinks.write_json(outputs, f"{folder}/reports/model_outputs")
        if chat is not None:
            named = reports.described_topics(run.topics, attributes)
            sinks.write_text(session, analysis.executive_report(named, chat), f"{folder}/reports/executive_summary")
    return run
