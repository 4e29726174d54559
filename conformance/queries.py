"""Registered queries over the driver's tables.

Given topics: a document's topic is the label of the vector with its id; label 9 and documents without
a vector are noise. Two derived comment tables exercise rules the documents do not trigger: the same
texts written in Arabic script with marks, tatweel and pictographs, and web pages full of URLs.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from voxloom.functions import answers as A
from voxloom.functions import params as P
from voxloom.functions import text as T
from voxloom.functions import tokens as K
from voxloom.functions.stopwords import stop_words
from voxloom.operators import cleaning as C
from voxloom.operators import keywords as KW
from voxloom.operators import metrics as M
from voxloom.operators import quality as Q
from voxloom.operators import representatives as R
from voxloom.operators.arrays import centroids, norm, unit
from voxloom.operators.embedding import hashed_tfidf, supplied_vectors
from voxloom.operators.kmeans import kmeans_labels
from voxloom.operators.layout import layout
from voxloom.operators.lookup import labelled_texts, settled
from voxloom.operators.neighbours import neighbour_graph
from voxloom.operators.reduction import reduced
from voxloom.plans import analysis as AN
from voxloom.plans import reports as RP
from voxloom.plans.discovery import discover
from voxloom.session import scratch_path, stored
from voxloom.settings import Settings
from voxloom.sources import sinks, state
from voxloom.sources.comments import load_comments, spread, with_position

SETTINGS = Settings()
LATIN = "abcdefghijklmnopqrstuvwxyz.,0123"
ARABIC_SCRIPT = "ابةدإفغهيجكلمنأَقرستآىوـّز؛،😀→☀🇸"


# ---- given data -------------------------------------------------------------------------------------
def table(spark: SparkSession, sf: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf}/{name}.parquet")


def documents(spark, sf):
    return spread(table(spark, sf, "documents"))


def arabic_script(spark, sf):
    return documents(spark, sf).select(
        "doc_id", F.translate(F.lower("text"), LATIN, ARABIC_SCRIPT).alias("text")
    )


def pages_text(spark, sf):
    return spread(table(spark, sf, "pages")).select("page_id", F.concat_ws(" ", "url", "html").alias("text"))


def labels(spark, sf):
    vectors = table(spark, sf, "embeddings").select(F.col("vec_id").alias("doc_id"), "label")
    given = F.when(F.col("label").isNull() | (F.col("label") == 9), -1).otherwise(F.col("label"))
    joined = spread(table(spark, sf, "documents")).select("doc_id", "lang").join(vectors, "doc_id", "left")
    return joined.select(F.col("doc_id").alias("row_id"), "lang", given.alias("topic_id"))


def kept(spark, sf):
    """row_id, original_comment, cleaned_text, for a query that reads the texts once: no column it leaves out is moved or held."""
    rows = C.kept_rows(documents(spark, sf), "text", "doc_id")
    return rows.withColumnRenamed("original_row_index", "row_id")


def kept_once(spark, sf):
    """The same rows cleaned once and written, for a query that reads them several times, each time only the columns it needs."""
    return stored(kept(spark, sf), "kept")


def kept_texts(spark, sf):
    """row_id, cleaned_text of the kept rows, written for what counts words and never shows an original."""
    return stored(kept(spark, sf).select("row_id", "cleaned_text"), "texts")


def own_texts(rows):
    """row_id, cleaned_text of the ``topic_texts``, for what does not ask the topic: every kept row with an id has a label,
    so the join, which would move the texts, is left out."""
    return rows.filter("row_id is not null").select("row_id", "cleaned_text")


def kept_ids(spark, sf):
    """Only row_id, for what goes over the kept rows several times and reads no text."""
    return settled(kept(spark, sf).select("row_id"))


def cleaned(spark, sf, rows=None):
    rows = kept_once(spark, sf) if rows is None else rows
    counted = C.with_frequency(rows.withColumnRenamed("row_id", "original_row_index"))
    return counted.withColumnRenamed("original_row_index", "row_id")


def comments(spark, sf, rows=None):
    """row_id, original_comment, cleaned_text, frequency, lang, topic_id."""
    return cleaned(spark, sf, rows).join(labels(spark, sf), "row_id")


def topic_texts(spark, sf, rows=None):
    """The comments without their frequency, for what does not need it."""
    return (kept(spark, sf) if rows is None else rows).join(labels(spark, sf), "row_id")


def members(spark, sf, rows=None):
    vectors = table(spark, sf, "embeddings").select(F.col("vec_id").alias("row_id"), F.col("embedding").alias("vec"))
    return topic_texts(spark, sf, rows).join(vectors, "row_id")


def narrowed_members(spark, sf, rows):
    """The members of few row_ids: the other texts are left out before the joins, which would move them."""
    return lambda ids: members(spark, sf, rows.join(ids, "row_id", "left_semi"))


def supplied_members(spark, sf):
    vectors = table(spark, sf, "embeddings").select(
        F.col("vec_id").alias("row_id"), F.transform("embedding", lambda x: x.cast("double") * 3).alias("vec")
    )
    rows = supplied_vectors(topic_texts(spark, sf), vectors)
    return rows.select("row_id", F.posexplode("vec").alias("place", "value")).withColumn("value", F.round("value", 6))


def counted_texts(spark, sf, rows=None):
    """The comments with their topics, dealt for counting their words."""
    rows = kept_texts(spark, sf) if rows is None else rows
    return labelled_texts(rows, labels(spark, sf))


def counts(spark, sf):
    return KW.topic_term_counts(counted_texts(spark, sf), SETTINGS)


def keywords(spark, sf, rows=None):
    return KW.ctfidf(counted_texts(spark, sf, rows), SETTINGS)


def topics(spark, sf, words=None, rows=None):
    rows = kept_texts(spark, sf) if rows is None else rows
    texts = counted_texts(spark, sf, rows) if words is None else topic_texts(spark, sf, rows)
    return settled(KW.topic_table(texts, SETTINGS, words))


def described(spark, sf, words=None, rows=None):
    return RP.described_topics(topics(spark, sf, words, rows))


# ---- sources and text rules ---------------------------------------------------------------------------
def text_rule(source, key, rule):
    return lambda spark, sf: source(spark, sf).select(key, rule(F.col("text")).alias("result"))


def clean_table(source, key):
    return lambda spark, sf: source(spark, sf).select(key, T.clean_text(F.col("text")).alias("cleaned_text"))


def clean_conversations(spark, sf):
    return table(spark, sf, "conversations").select(
        "conv_id", "turn", "role", T.clean_text(F.col("text")).alias("cleaned_text")
    )


def word_counts(spark, sf):
    rows = C.prepared(documents(spark, sf), "text", "doc_id")
    return rows.select(
        F.col("original_row_index").alias("doc_id"),
        T.word_count(F.col("cleaned_text")).cast("long").alias("n_words"),
    )


def language_flags(spark, sf):
    script = arabic_script(spark, sf).select("doc_id", F.lit("arabic").alias("script"), "text")
    latin = documents(spark, sf).select("doc_id", F.lit("latin").alias("script"), "text")
    return script.unionByName(latin).select("doc_id", "script", T.has_arabic(F.col("text")).alias("has_arabic"))


def dedup_keys(spark, sf):
    rows = C.kept_rows(documents(spark, sf), "text", "doc_id")
    return rows.groupBy(F.sha2(T.dedup_key(F.col("cleaned_text")), 256).alias("text_key")).agg(
        F.count("*").alias("n"), F.min("original_row_index").alias("first_row")
    )


def encoder_inputs(spark, sf):
    rows = C.kept_rows(documents(spark, sf), "text", "doc_id")
    return rows.select(
        F.col("original_row_index").alias("doc_id"),
        T.encoder_input(F.col("cleaned_text"), True).alias("encoder_input"),
    )


def previews(spark, sf):
    return documents(spark, sf).select("doc_id", T.preview(F.col("text")).alias("preview"))


def clean_stats(source, key):
    return lambda spark, sf: C.cleaning_stats(source(spark, sf), "text", key)


def clean_frequency(spark, sf):
    return C.clean_comments(documents(spark, sf), "text", "doc_id").select(
        F.col("original_row_index").alias("row_id"), "cleaned_text", "frequency"
    )


def clean_comments_arabic(spark, sf):
    return C.clean_comments(arabic_script(spark, sf), "text", "doc_id")


# ---- tokens and keywords --------------------------------------------------------------------------------
def token_counts(spark, sf):
    rows = C.kept_rows(documents(spark, sf), "text", "doc_id")
    return (
        rows.select(F.explode(K.tokens(F.col("cleaned_text"))).alias("token"))
        .groupBy("token")
        .agg(F.count("*").alias("n"))
    )


def stop_word_hits(spark, sf):
    return token_counts(spark, sf).select("token", "n", F.col("token").isin(stop_words()).alias("is_stop_word"))


def gram_counts(spark, sf):
    rows = C.kept_rows(documents(spark, sf), "text", "doc_id")
    return (
        KW.gram_rows(rows, SETTINGS)
        .select(F.explode("grams").alias("gram"))
        .groupBy("gram")
        .agg(F.count("*").alias("n"))
    )


def doc_term_counts(spark, sf):
    return counts(spark, sf)


def term_totals(spark, sf):
    return KW.term_totals(counts(spark, sf))


def frequent_terms(spark, sf):
    return KW.vocabulary(counts(spark, sf), SETTINGS)


def mean_class_tokens(spark, sf):
    row = KW.mean_class_tokens(KW.vocabulary(counts(spark, sf), SETTINGS))
    return row.select("all_tokens", "n_topics", F.round("mean_tokens", 6).alias("mean_tokens"))


def ctfidf_top10(spark, sf):
    return keywords(spark, sf).select("topic_id", "rank", "term", F.round("score", 9).alias("score"))


def candidate_vocabulary(spark, sf):
    return keywords(spark, sf).select("term").distinct()


def auto_names(spark, sf):
    return topics(spark, sf).filter("topic_id <> -1").select("topic_id", "auto_name")


def display_names(spark, sf):
    return described(spark, sf).select(
        "topic_id", "topic_name", "topic_size", F.array_join("keywords", ", ").alias("keywords")
    )


# ---- vectors ----------------------------------------------------------------------------------------------
def unit_vectors(spark, sf):
    doubled = table(spark, sf, "embeddings").select(
        "vec_id", F.transform("embedding", lambda x: x.cast("double") * 3).alias("vec")
    )
    return unit(doubled).select(
        "vec_id",
        F.round(norm(F.col("vec")), 6).alias("length"),
        F.round(F.col("vec")[0], 6).alias("first_value"),
    )


def topic_centroids(spark, sf):
    return centroids(members(spark, sf)).select(
        "topic_id", "n", F.posexplode("centroid").alias("position", "value")
    ).withColumn("value", F.round("value", 6))


def centroid_similarity(spark, sf):
    return R.similarity(members(spark, sf, kept_ids(spark, sf)), SETTINGS).select("row_id", "topic_id", F.round("sim", 6).alias("sim"))


def nearest_topic(spark, sf):
    found = Q.nearest_topic(settled(centroids(members(spark, sf))), SETTINGS)
    return found.withColumn("similarity", F.round("similarity", 6))


def representatives(k, flag=None):
    def query(spark, sf):
        mark = None if flag is None else F.expr(flag)
        rows = kept_once(spark, sf)
        chosen = R.representatives(members(spark, sf, R.keyed(rows)), SETTINGS, k, mark, narrowed_members(spark, sf, rows))
        return chosen.select("topic_id", "rank", "row_id", F.round("sim", 6).alias("sim"), "original_comment")

    return query


def first_rows(spark, sf):
    return R.first_rows(topic_texts(spark, sf), SETTINGS.rep_comments_min)


# ---- measures -------------------------------------------------------------------------------------------------
def topic_sizes(spark, sf):
    return M.topic_sizes(topic_texts(spark, sf))


def noise_share(spark, sf):
    row = M.share_figures(topic_sizes(spark, sf))
    return row.select(
        "n", "n_topics", "n_noise", F.round("noise_rate", 4).alias("noise_rate"), F.round("coverage", 4).alias("coverage")
    )


def topic_balance(spark, sf):
    return M.topic_balance(topic_sizes(spark, sf)).select(F.round("topic_balance", 6).alias("topic_balance"))


def keyword_document_frequency(spark, sf):
    rows = kept_texts(spark, sf)
    chosen = settled(keywords(spark, sf, rows))
    freq = M.document_frequency(M.keyword_sets(own_texts(rows), chosen, SETTINGS), SETTINGS)
    return chosen.join(freq, ["topic_id", "rank"]).select("topic_id", "rank", "term", "doc_freq")


def npmi_pairs(spark, sf):
    rows = kept_texts(spark, sf)
    words = settled(keywords(spark, sf, rows))
    pairs = M.npmi_pairs(topic_texts(spark, sf, rows), words, SETTINGS, own_texts(rows))
    return pairs.withColumn("npmi", F.round("npmi", 6))


def npmi(spark, sf):
    rows = kept_texts(spark, sf)
    words = settled(keywords(spark, sf, rows))
    value = M.npmi_coherence(topic_texts(spark, sf, rows), words, SETTINGS, own_texts(rows))
    return value.select(F.round("npmi_coherence", 6).alias("npmi_coherence"))


def silhouette_rows(spark, sf):
    return M.silhouette_rows(members(spark, sf, kept_ids(spark, sf)), SETTINGS).withColumn("silhouette", F.round("silhouette", 6))


def silhouette_cosine(spark, sf):
    return M.silhouette(members(spark, sf, kept_ids(spark, sf)), SETTINGS).select(F.round("silhouette", 6).alias("silhouette"))


def run_metrics(spark, sf, words=None, rows=None):
    rows = kept_texts(spark, sf) if rows is None else rows
    return M.metrics_row(
        topic_texts(spark, sf, rows),
        members(spark, sf, rows),
        settled(keywords(spark, sf, rows) if words is None else words),
        SETTINGS,
        engine="given",
        model="minilm",
        runtime_sec=0.0,
        texts=own_texts(rows),
    )


def size_parameters(spark, sf):
    """The parameters each group of rows would get: documents, orders and line items at several grains."""
    groups = [
        documents(spark, sf).groupBy(F.concat(F.lit("documents "), "lang").alias("grp")),
        documents(spark, sf).groupBy(F.lit("documents").alias("grp")),
        table(spark, sf, "pages").groupBy(F.lit("pages").alias("grp")),
        table(spark, sf, "orders").groupBy(F.concat(F.lit("orders "), "o_orderstatus").alias("grp")),
        table(spark, sf, "lineitem").groupBy(
            F.concat(F.lit("lineitem "), "l_returnflag", "l_linestatus").alias("grp")
        ),
        table(spark, sf, "lineitem").groupBy(F.lit("lineitem").alias("grp")),
    ]
    sized = groups[0].agg(F.count("*").alias("n"))
    for group in groups[1:]:
        sized = sized.unionByName(group.agg(F.count("*").alias("n")))
    n = F.col("n")
    return sized.select(
        "grp",
        P.size_params(n, SETTINGS).alias("p"),
        P.needs_fallback(n, F.lit(0.31), SETTINGS).alias("needs_fallback"),
        P.fallback_k(n).alias("fallback_k"),
        R.rep_count(n, SETTINGS).alias("rep_count"),
    ).select("grp", "p.*", "needs_fallback", "fallback_k", "rep_count")


def given_params(spark, sf, rows=None):
    """The one-row run parameters the key/value reports read, for the given topics."""
    figures = M.share_figures(M.topic_sizes(topic_texts(spark, sf, rows)))
    return figures.select(P.size_params(F.col("n"), SETTINGS).alias("p")).select(
        F.lit("pca").alias("reducer"),
        F.lit("given").alias("clusterer"),
        F.lit(False).alias("kmeans_fallback"),
        *[F.col(f"p.{c}") for c in "neighbors min_cluster_size min_samples is_smoke_test warning tier".split()],
    )


# ---- report tables --------------------------------------------------------------------------------------------
def feedback_with_topics(spark, sf):
    rows = kept_once(spark, sf)
    return RP.feedback_with_topics(comments(spark, sf, rows), described(spark, sf, rows=rows), SETTINGS)


def adaptive_samples(spark, sf, rows):
    return settled(R.representatives(members(spark, sf, R.keyed(rows)), SETTINGS, narrowed=narrowed_members(spark, sf, rows)))


def topic_summary(spark, sf):
    rows = kept_once(spark, sf)
    return RP.topic_summary(described(spark, sf, rows=rows), R.packed_samples(adaptive_samples(spark, sf, rows)))


def topic_samples(spark, sf):
    rows = kept_once(spark, sf)
    return RP.topic_samples(described(spark, sf, rows=rows), adaptive_samples(spark, sf, rows), SETTINGS)


def noise_comments(spark, sf):
    return RP.noise_comments(comments(spark, sf))


def quality_check(spark, sf):
    rows = kept_once(spark, sf)
    return Q.quality_check(topics(spark, sf, rows=rows), members(spark, sf, rows), SETTINGS)


def largest_topics(spark, sf):
    return RP.largest_topics(described(spark, sf))


def overview(spark, sf):
    rows = kept_texts(spark, sf)
    words = settled(keywords(spark, sf, rows))
    return RP.overview(
        described(spark, sf, words, rows),
        run_metrics(spark, sf, words, rows),
        C.cleaning_stats(documents(spark, sf), "text", "doc_id"),
        given_params(spark, sf, rows),
    )


def settings_table(spark, sf):
    rows = kept_texts(spark, sf)
    return RP.settings_table(
        run_metrics(spark, sf, rows=rows),
        C.cleaning_stats(documents(spark, sf), "text", "doc_id"),
        given_params(spark, sf, rows),
        SETTINGS,
    )


def validation_preview(spark, sf):
    rows = kept_once(spark, sf)
    return RP.validation_preview(topic_texts(spark, sf, rows), described(spark, sf, rows=rows), SETTINGS)


def chart(make):
    def query(spark, sf):
        drawn = make(described(spark, sf))
        if "percentage" in drawn.columns:
            drawn = drawn.withColumn("percentage", F.round("percentage", 6))
        return drawn

    return query


# ---- analysis per topic ---------------------------------------------------------------------------------------
def payloads(spark, sf, given=None, rows=None):
    rows = kept_once(spark, sf) if rows is None else rows
    narrowed = narrowed_members(spark, sf, rows)
    samples = R.packed_samples(R.representatives(members(spark, sf, R.keyed(rows)), SETTINGS, SETTINGS.samples_per_topic, narrowed=narrowed))
    found = topics(spark, sf, rows=rows) if given is None else given
    return settled(AN.topic_payloads(found, comments(spark, sf, rows), samples, SETTINGS))


def topic_payload(spark, sf):
    return payloads(spark, sf).select(
        "topic_id",
        "auto_name",
        "topic_size",
        "topic_percentage",
        F.array_join("keywords", "|").alias("keywords"),
        F.array_join("samples", "|").alias("samples"),
        "duplicate_note",
    )


def topic_prompts(spark, sf):
    return payloads(spark, sf).select("topic_id", "prompt")


def duplicated_members(spark, sf):
    return AN.duplicated_members(comments(spark, sf))


# Model answers made from the documents themselves: well formed ones and every kind of defect.
DOCUMENT_ANSWER = """
CASE CAST(doc_id % 11 AS INT)
  WHEN 0 THEN '{"business_name":"theme of ' || lang || '","description":"d","root_cause":"r","severity":"عالية","sentiment":"سلبي","recommended_actions":["a","b","c"]}'
  WHEN 1 THEN '<think>{' || source || '}</think>{"business_name":" slow ' || lang || ' ","description":"d","root_cause":"r","severity":" منخفضة ","sentiment":"محايد","recommended_actions":["a"," ","b","c"]}'
  WHEN 2 THEN 'Sure: {"business_name":"late ' || source || '","description":"d","root_cause":"r","severity":"متوسطة","sentiment":"مختلط","recommended_actions":["a","b","c"]} done'
  WHEN 3 THEN 'no answer for ' || lang
  WHEN 4 THEN '{"business_name":"broken ' || lang
  WHEN 5 THEN '{"business_name":"two actions","description":"d","root_cause":"r","severity":"عالية","sentiment":"إيجابي","recommended_actions":["a","b"]}'
  WHEN 6 THEN '{"business_name":"one action","description":"d","root_cause":"r","severity":"عالية","sentiment":"إيجابي","recommended_actions":"call ' || lang || '"}'
  WHEN 7 THEN '{"business_name":"خدمة العملاء","description":"d","root_cause":"r","severity":"high","sentiment":"سلبي","recommended_actions":["a","b","c"]}'
  WHEN 8 THEN '{"business_name":"' || lang || '","severity":"عالية","sentiment":"good","recommended_actions":["a","b","c"]}'
  WHEN 9 THEN '{"business_name":"one two three four five","description":"d","root_cause":"r","severity":null,"sentiment":"سلبي","recommended_actions":[]}'
  ELSE text
END"""


def document_answers(spark, sf):
    answers = documents(spark, sf).select("doc_id", F.expr(DOCUMENT_ANSWER).alias("answer"))
    return AN.checked(answers)


def parse_answers(spark, sf):
    rows = document_answers(spark, sf)
    return rows.select(
        "doc_id",
        F.col("fields").isNotNull().alias("is_json"),
        *[A.field(F.col("fields"), key).alias(key) for key in A.ANSWER_FIELDS],
        F.array_join("actions", " | ").alias("recommended_actions"),
    )


def validate_answers(spark, sf):
    rows = document_answers(spark, sf)
    return rows.select(
        "doc_id", (F.size("errors") == 0).alias("is_valid"), F.array_join("errors", "; ").alias("errors")
    )


def retry_prompts(spark, sf):
    refused = document_answers(spark, sf).filter(F.size("errors") > 0)
    return refused.select(
        "doc_id", AN.retry_prompt(F.concat(F.lit("prompt "), "doc_id"), F.col("errors")).alias("prompt")
    )


def fallback_names(spark, sf):
    """Fallback names from every document's own first words in place of keywords."""
    rows = C.kept_rows(documents(spark, sf), "text", "doc_id").select(
        F.col("original_row_index").alias("doc_id"), K.tokens(F.col("cleaned_text")).alias("t")
    )
    return rows.select("doc_id", A.fallback_name(F.col("t")).alias("business_name"))


# Answers for the given topics: right at once, right on the retry, never right, missing.
TOPIC_ANSWER = """
CASE
  WHEN CAST(topic_id % 4 AS INT) = 0 OR (CAST(topic_id % 4 AS INT) = 1 AND attempt = 1)
  THEN '{"business_name":"theme ' || auto_name || '","description":"about ' || auto_name || '","root_cause":"r' || attempt || '","severity":"متوسطة","sentiment":"سلبي","recommended_actions":["a","b","c"]}'
  WHEN CAST(topic_id % 4 AS INT) = 3 THEN NULL
  ELSE '{"business_name":"theme"}'
END"""


def topic_answers(rows):
    tries = rows.select("topic_id", "auto_name", F.explode(F.array(F.lit(0), F.lit(1))).alias("attempt"))
    return tries.select("topic_id", "attempt", F.expr(TOPIC_ANSWER).alias("answer"))


def flat_output(outputs):
    return outputs.withColumn("recommended_actions", F.array_join("recommended_actions", " | "))


def staged_outputs(spark, sf, given=None, rows=None):
    asked = payloads(spark, sf, given, rows)
    return AN.analysed(asked, AN.answers_from_table(topic_answers(asked)), SETTINGS)


def naming_staged(spark, sf):
    return flat_output(staged_outputs(spark, sf))


def naming_resume(spark, sf):
    """Topics with an even id were finished by an earlier run and keep what it stored."""
    asked = payloads(spark, sf)
    earlier = AN.fallback_output(asked.filter("topic_id % 2 = 0")).withColumn("source", F.lit("stored"))
    answer = AN.answers_from_table(topic_answers(asked))
    return flat_output(AN.resumed(asked, earlier, answer, SETTINGS))


def named_topics(spark, sf, rows=None):
    rows = kept_once(spark, sf) if rows is None else rows
    given = topics(spark, sf, rows=rows)
    attributes = AN.topic_attributes(staged_outputs(spark, sf, given, rows))
    return RP.described_topics(given, attributes)


def exec_prompt(spark, sf):
    return AN.executive_prompt(named_topics(spark, sf))


def topic_summary_named(spark, sf):
    rows = kept_once(spark, sf)
    return RP.topic_summary(named_topics(spark, sf, rows), R.packed_samples(adaptive_samples(spark, sf, rows)))


def feedback_named(spark, sf):
    rows = kept_once(spark, sf)
    return RP.feedback_with_topics(comments(spark, sf, rows), named_topics(spark, sf, rows), SETTINGS)


# ---- sources, state and topic discovery -----------------------------------------------------------------
def csv_roundtrip(spark, sf):
    """All documents through CSV files: quotes and line breaks inside the texts have to survive."""
    path = scratch_path(spark, "documents")
    rows = documents(spark, sf).select("doc_id", "text", "lang")
    rows.write.options(**sinks.CSV_OPTIONS).csv(path)
    return load_comments(spark, path, schema="doc_id bigint, text string, lang string")


def csv_legacy_encoding(spark, sf):
    """The Arabic-script texts through files in Windows Arabic, recognised by their bytes."""
    path = scratch_path(spark, "arabic")
    spark.conf.set("spark.sql.legacy.javaCharsets", "true")
    rows = arabic_script(spark, sf).select("doc_id", only_legacy_letters(F.col("text")).alias("text"))
    rows.write.options(**sinks.CSV_OPTIONS, encoding="windows-1256").csv(path)
    return load_comments(spark, path, schema="doc_id bigint, text string")


def only_legacy_letters(c):
    return F.regexp_replace(c, r"[^\x20-\x7e\x{0621}-\x{063A}\x{0641}-\x{064A}]", "")


def row_positions(spark, sf):
    """The position of every document in its file."""
    rows = table(spark, sf, "documents").select("doc_id", F.col("_metadata").alias("_file"))
    return with_position(rows, "row_position", SETTINGS).select("doc_id", "row_position")


def dataset_signature(spark, sf):
    return state.signature_row(documents(spark, sf), "doc_id", "text")


def vector_cache(spark, sf):
    """The given vectors made once, then read back from the cache by a second call."""
    folder = scratch_path(spark, "cache")
    given = table(spark, sf, "embeddings").select(F.col("vec_id").alias("row_id"), F.col("embedding").alias("vec"))

    def unexpected(rows):
        raise RuntimeError("the cached vectors were not found")

    ids = given.select("row_id")
    state.cached_vectors(ids, lambda rows: rows.join(given, "row_id"), folder, "given", "s1")
    again = state.cached_vectors(ids, unexpected, folder, "given", "s1")
    return again.select("row_id", F.size("vec").alias("width"), F.round(F.col("vec")[0].cast("double"), 6).alias("first_value"))


def checkpoint_roundtrip(spark, sf):
    """Topics saved and loaded by signature; another signature finds nothing."""
    folder = scratch_path(spark, "state")
    stats = C.cleaning_stats(documents(spark, sf), "text", "doc_id")
    rows = kept_texts(spark, sf)
    words = settled(keywords(spark, sf, rows))
    tables = {
        "labels": topic_texts(spark, sf, rows).select("row_id", "topic_id"),
        "keywords": words,
        "topics": topics(spark, sf, words, rows),
        "params": given_params(spark, sf, rows),
        "metrics": M.share_figures(M.topic_sizes(topic_texts(spark, sf, rows))),
        "stats": stats,
    }
    state.save_result(tables, folder, "now")
    if state.load_result(spark, folder, "other") is not None:
        raise RuntimeError("a result of other data was served")
    loaded = state.load_result(spark, folder, "now")
    return loaded["labels"].join(loaded["topics"].select("topic_id", "topic_size"), "topic_id")


def sink_roundtrip(spark, sf):
    """The noise table through the Parquet sink and the topic sizes through the JSON sink."""
    folder = scratch_path(spark, "sinks")
    sinks.write_tables({"noise_comments": noise_comments(spark, sf)}, folder)
    sinks.write_json(topic_sizes(spark, sf), f"{folder}/sizes")
    sizes = spark.read.schema("topic_id int, topic_size bigint").json(f"{folder}/sizes")
    noise = spark.read.parquet(f"{folder}/noise_comments")
    return noise.withColumn("topic_id", F.lit(-1)).join(sizes, "topic_id").select(
        "original_row_index", "original_comment", "cleaned_text", "frequency", "topic_size"
    )


def hashed_vectors(spark, sf):
    rows = hashed_tfidf(kept(spark, sf), SETTINGS)
    return rows.select("row_id", F.size("vec").alias("width"), F.round(norm(F.col("vec")), 4).alias("length"))


def reduced_vectors(spark, sf):
    """Five principal components of the given vectors."""
    given = table(spark, sf, "embeddings").select(F.col("vec_id").alias("row_id"), F.col("embedding").alias("vec"))
    rows = reduced(given, given.count(), SETTINGS)
    return rows.select("row_id", F.posexplode("vec").alias("component", "value"))


def unit_embeddings(spark, sf):
    given = table(spark, sf, "embeddings").select(F.col("vec_id").alias("id"), F.col("embedding").cast("array<double>").alias("vec"))
    return unit(given)


def neighbour_rows(spark, sf):
    """Fifteen neighbours of every given vector. Exact up to one chunk of vectors, which the SQL twin needs."""
    points = unit_embeddings(spark, sf)
    near = neighbour_graph(points, points.count(), 15, SETTINGS.seed)
    rows = near.select("id", F.posexplode("near").alias("place", "e"))
    return rows.select("id", (F.col("place") + 1).alias("place"), "e.other", F.round("e.d", 6).alias("distance"))


def layout_vectors(spark, sf):
    """Positions of the given vectors in five dimensions, all components."""
    points = unit_embeddings(spark, sf).withColumnRenamed("id", "row_id")
    rows = layout(points, 20, SETTINGS)
    return rows.select("row_id", F.posexplode("vec").alias("component", "value"))


def kmeans_topics(spark, sf):
    given = table(spark, sf, "embeddings").select(F.col("vec_id").alias("row_id"), F.col("embedding").alias("vec"))
    n = given.count()
    k = spark.range(1).select(P.fallback_k(F.lit(n)).alias("k")).first()["k"]
    return kmeans_labels(settled(reduced(given, n, SETTINGS)), k, SETTINGS)


def discovery(spark, sf):
    rows = kept_texts(spark, sf)
    return discover(rows, hashed_tfidf(rows, SETTINGS, sparse=True), SETTINGS, "hashed")


def discovered_labels(spark, sf):
    """A topic or noise for every cleaned document, from its own text."""
    return discovery(spark, sf).labels


def discovered_topics(spark, sf):
    topics_found = discovery(spark, sf).topics
    return topics_found.select("topic_id", "topic_size", "auto_name", F.array_join("keywords", ", ").alias("keywords"))


QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "drop_urls": text_rule(pages_text, "page_id", T.drop_urls),
    "drop_emoji": text_rule(arabic_script, "doc_id", T.drop_emoji),
    "collapse_punctuation": text_rule(documents, "doc_id", T.collapse_punctuation),
    "unify_arabic": text_rule(arabic_script, "doc_id", T.unify_arabic),
    "shorten_elongation": text_rule(documents, "doc_id", T.shorten_elongation),
    "normalize_spaces": text_rule(documents, "doc_id", T.normalize_spaces),
    "clean_documents": clean_table(documents, "doc_id"),
    "clean_pages": clean_table(pages_text, "page_id"),
    "clean_arabic_script": clean_table(arabic_script, "doc_id"),
    "clean_conversations": clean_conversations,
    "word_counts": word_counts,
    "language_flags": language_flags,
    "dedup_keys": dedup_keys,
    "encoder_inputs": encoder_inputs,
    "previews": previews,
    "clean_stats": clean_stats(documents, "doc_id"),
    "clean_stats_pages": clean_stats(pages_text, "page_id"),
    "clean_frequency": clean_frequency,
    "clean_comments_arabic": clean_comments_arabic,
    "token_counts": token_counts,
    "stop_word_hits": stop_word_hits,
    "gram_counts": gram_counts,
    "doc_term_counts": doc_term_counts,
    "term_totals": term_totals,
    "frequent_terms": frequent_terms,
    "mean_class_tokens": mean_class_tokens,
    "ctfidf_top10": ctfidf_top10,
    "candidate_vocabulary": candidate_vocabulary,
    "auto_names": auto_names,
    "display_names": display_names,
    "unit_vectors": unit_vectors,
    "supplied_members": supplied_members,
    "topic_centroids": topic_centroids,
    "centroid_similarity": centroid_similarity,
    "nearest_topic": nearest_topic,
    "representatives_k3": representatives(3),
    "representatives_mix": representatives(3, "lang <> 'en'"),
    "representatives_adaptive_k": representatives(None),
    "first_rows": first_rows,
    "topic_sizes": topic_sizes,
    "noise_share": noise_share,
    "topic_balance": topic_balance,
    "keyword_document_frequency": keyword_document_frequency,
    "npmi_pairs": npmi_pairs,
    "npmi": npmi,
    "silhouette_rows": silhouette_rows,
    "silhouette_cosine": silhouette_cosine,
    "metrics_row": run_metrics,
    "size_parameters": size_parameters,
    "feedback_with_topics": feedback_with_topics,
    "topic_summary": topic_summary,
    "topic_samples": topic_samples,
    "noise_comments": noise_comments,
    "quality_check": quality_check,
    "largest_topics": largest_topics,
    "overview": overview,
    "settings": settings_table,
    "validation_preview": validation_preview,
    "chart_top10": chart(RP.chart_top10),
    "chart_share": chart(RP.chart_share),
    "chart_noise": chart(RP.chart_noise),
    "topic_payload": topic_payload,
    "topic_prompts": topic_prompts,
    "duplicated_members": duplicated_members,
    "parse_answers": parse_answers,
    "validate_answers": validate_answers,
    "retry_prompts": retry_prompts,
    "fallback_names": fallback_names,
    "naming_staged": naming_staged,
    "naming_resume": naming_resume,
    "exec_prompt": exec_prompt,
    "topic_summary_named": topic_summary_named,
    "feedback_named": feedback_named,
    "csv_roundtrip": csv_roundtrip,
    "csv_legacy_encoding": csv_legacy_encoding,
    "row_positions": row_positions,
    "dataset_signature": dataset_signature,
    "vector_cache": vector_cache,
    "checkpoint_roundtrip": checkpoint_roundtrip,
    "sink_roundtrip": sink_roundtrip,
    "hashed_vectors": hashed_vectors,
    "reduced_vectors": reduced_vectors,
    "neighbour_graph": neighbour_rows,
    "layout_vectors": layout_vectors,
    "kmeans_topics": kmeans_topics,
    "discovered_labels": discovered_labels,
    "discovered_topics": discovered_topics,
}
