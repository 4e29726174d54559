"""Clean a comment table, count what was removed and how often each text occurs."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from voxloom.functions import text as T

# At most this many texts get the broadcast path of ``with_frequency``. They are the most frequent
# ones, so any other text holds less than one part in HOT_KEYS of all rows.
HOT_KEYS = 10_000
HOT_MIN_ROWS = 1_000


def _once(expression):
    """Evaluate an expensive expression once per row.

    A filter on a projected column is pushed below the projection and the expression runs twice;
    it is not pushed below a generator.
    """
    return F.explode(F.array(expression))


def prepared(df: DataFrame, comment_col: str, row_col: str) -> DataFrame:
    """One row per input row; ``cleaned_text`` is '' for null and blank comments."""
    original = F.col(comment_col).cast("string")
    usable = original.isNotNull() & ~T.is_blank(original)
    return df.select(
        F.col(row_col).cast("long").alias("original_row_index"),
        original.alias("original_comment"),
        _once(F.when(usable, T.clean_text(original)).otherwise("")).alias("cleaned_text"),
    )


def kept_rows(df: DataFrame, comment_col: str, row_col: str, min_words: int = 3) -> DataFrame:
    rows = prepared(df, comment_col, row_col)
    return rows.filter((F.col("cleaned_text") != "") & (T.word_count(F.col("cleaned_text")) >= min_words))


def with_frequency(rows: DataFrame) -> DataFrame:
    """Add how many rows share the cleaned text; duplicates stay.

    The count is a partial aggregation over fixed-width digests. Bringing it back must not send all
    copies of one text to one task, so the most frequent texts come from a small broadcast table
    (at most HOT_KEYS rows of digest and count) and only the others are joined by digest.
    """
    # a key that cannot be null keeps both uses of ``counts`` alike, so Spark runs them once
    keyed = rows.withColumn("text_key", F.coalesce(F.sha2("cleaned_text", 256), F.lit("")))
    counts = keyed.groupBy("text_key").agg(F.count("*").alias("n")).filter(F.col("n") > 1)
    hot = (
        counts.filter(F.col("n") >= HOT_MIN_ROWS)
        .orderBy(F.desc("n"), "text_key")
        .limit(HOT_KEYS)
        .select("text_key", F.col("n").alias("hot_n"))
    )
    marked = keyed.join(F.broadcast(hot), "text_key", "left").withColumn(
        "join_key",
        # rows already served get a key of their own: it matches nothing and spreads evenly
        F.when(F.col("hot_n").isNull(), F.col("text_key")).otherwise(
            F.concat(F.lit("served-"), F.col("original_row_index"))
        ),
    )
    cold = counts.select(F.col("text_key").alias("join_key"), F.col("n").alias("cold_n"))
    return (
        marked.join(cold, "join_key", "left")
        .withColumn("frequency", F.coalesce("hot_n", "cold_n", F.lit(1)).cast("long"))
        .drop("join_key", "text_key", "hot_n", "cold_n")
    )


def clean_comments(df: DataFrame, comment_col: str, row_col: str, min_words: int = 3) -> DataFrame:
    """original_row_index, original_comment, cleaned_text, frequency."""
    return with_frequency(kept_rows(df, comment_col, row_col, min_words))


def cleaning_stats(df: DataFrame, comment_col: str, row_col: str, min_words: int = 3) -> DataFrame:
    """One row: n_original, removed_null, removed_short, duplicate_count, n_after."""
    rows = prepared(df, comment_col, row_col).withColumn(
        "fate",
        F.when(F.col("cleaned_text") == "", "null")
        .when(T.word_count(F.col("cleaned_text")) < min_words, "short")
        .otherwise("kept"),
    )
    digest = F.when(F.col("fate") == "kept", F.sha2("cleaned_text", 256))
    # one row per text first (map-side combined), so that a text with many copies costs no more
    per_text = rows.groupBy("fate", digest.alias("digest")).agg(F.count("*").alias("n"))

    def total(fate):
        return F.coalesce(F.sum(F.when(F.col("fate") == fate, F.col("n"))), F.lit(0))

    return per_text.agg(
        F.coalesce(F.sum("n"), F.lit(0)).alias("n_original"),
        total("null").alias("removed_null"),
        total("short").alias("removed_short"),
        (total("kept") - F.count("digest")).alias("duplicate_count"),
        total("kept").alias("n_after"),
    )


def require_rows(stats: DataFrame) -> int:
    """Rows after cleaning; raises when nothing is left."""
    n_after = stats.first()["n_after"]
    if n_after == 0:
        raise ValueError("Nothing left after cleaning: check the comment column and min_words.")
    return n_after
